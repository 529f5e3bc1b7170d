"""Token ids, packing and token files against the plain tokenizer."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from flowtables.llm import packing, queries, token_codes, tokens

PATH = queries.tokenizer()
PLAIN = Tokenizer.from_file(PATH)
ODD = ["", " ", "a", "Don't stop. It's 'SO' 42nd!", "ÉÉ ß straße Ǆ İstanbul ΣΑΣ", "é ́x a b c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y", "a.b,c;d 1.5% (x) \"q\"", "日本語 テスト 한국어", "\x00\x01", "naïve\tcafé\r\ncrème", "😀😀 ok", "x" * 3000, "ſ K Å", "l'été d'or 's 't"]


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def wide(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", b"") for i, t in rows], "doc_id long, text string, part int, base int, at string, ids binary")


@given(st.lists(st.text(alphabet=st.sampled_from(list("abEÉßñ'.,!?<|>0 \n\t²½éé́ΣİǅK  \x1c*-_/")) | st.characters(codec="utf-8"), max_size=60), max_size=5))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_tokenizer(texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.loaded(PATH).encode(texts)]
    assert got == [ids(t) for t in texts]


def test_long_texts_and_small_caches(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE", 50)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    encoder = tokens.WordTokenizer(PATH)
    texts = [*ODD, "word " * 100, "one two three four five six seven eight nine ten " * 9]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [ids(t) for t in texts]


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate([*ODD, None, "many words here " * 900, "a"])] + [(3, "again"), (None, "no id"), (3, "again")]


def test_packing_is_whole_and_gapless(spark, rows):
    got = packing.pack(wide(spark, rows).repartition(3), PATH, 64, 1).collect()
    by_sequence = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 64 and r.boundary == (r.length < r.doc_tokens)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for n, pieces in by_sequence.items():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends == 64 or n == len(by_sequence) - 1
    stream, want = {}, sorted(np.array([*ids(t), 1], "<u4").tobytes() for _, t in rows)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        if r.start == 0:
            stream[len(stream)] = b""
        stream[len(stream) - 1] += r.ids
    assert sorted(stream.values()) == want


def test_packing_empty(spark):
    assert packing.pack(wide(spark, []), PATH).count() == 0
    assert packing.pack(wide(spark, [(1, None)]), PATH, end_id=None).count() == 0


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 700) | st.integers(0, 200), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_codes_round_trip_and_random_access(values):
    codes = token_codes.Codes(token_codes.encode(np.array(values, np.uint64)))
    assert codes.n == len(values) and codes.slice(0, len(values)).tolist() == values
    for i in range(0, len(values), 37):
        assert codes[i] == values[i]
        assert codes.slice(i, min(len(values), i + 50)).tolist() == values[i : i + 50]
    with pytest.raises(IndexError):
        codes[len(values)]


def test_token_files(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(token_codes, "SEGMENT", 200)
    path = f"{tmp_path}/codes"
    token_codes.write_codes(wide(spark, rows).repartition(3), path, PATH, 2)
    got = sorted(token_codes.read_codes(spark, path).collect(), key=lambda r: r.start)
    at, stream = 0, []
    for r, (i, t) in zip(got, sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
        want = [*ids(t), 2]
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (i, at, len(want), np.array(want, "<u4").tobytes())
        at += len(want)
        stream += want
    assert len(got) == len(rows)
    for position in (0, 7, 150, len(stream) - 1):
        assert token_codes.token_at(spark, path, position) == stream[position]
    token_codes.write_codes(wide(spark, []), f"{path}2", PATH)
    assert token_codes.read_codes(spark, f"{path}2").count() == 0


def test_queries_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    start = 0
    got = {r.doc_id: r for r in queries.op10_token_codes(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i in sorted(docs):
        data = np.array([*ids(docs[i]), 2], "<u4").tobytes()
        assert tuple(got[i]) == (i, start, len(data) // 4, zlib.crc32(data))
        start += len(data) // 4
    n = 0
    for r in queries.op6_packing(spark, sf).collect():
        data = np.array([*ids(docs[r.doc_id]), 1], "<u4")
        assert r.doc_tokens == len(data) and r.ids_crc32 == zlib.crc32(data[r.start : r.start + r.length].tobytes())
        n += r.length
    assert n == start
