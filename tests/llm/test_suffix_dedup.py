"""Suffix runs, the merge, and removal of repeated byte strings."""

import random

import numpy as np
import pytest

from flowtables.llm import blocks, suffix_dedup as sd


def brute(docs, length):
    """Rows (id, bytes, spans, kept); ids of None count as the largest."""
    rank = lambda i: (i is None, i or 0)
    least = {}
    for i, t in docs:
        t = (t or "").encode()
        for p in range(len(t) - length + 1):
            s = t[p : p + length]
            least[s] = min(least.get(s, (True, 2**63)), rank(i))
    out = []
    for i, t in docs:
        t = (t or "").encode()
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if least[t[p : p + length]] < rank(i):
                gone[p : p + length] = [True] * length
        spans, p = [], 0
        while p < len(t):
            q = p
            while q < len(t) and gone[q]:
                q += 1
            if q > p:
                spans.append((p, q))
            p = max(q, p + 1)
        out.append((i, len(t), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "p", b"k") for i, t in docs], "doc_id long, text string, block int, part string, kept binary").repartition(4)


def check(spark, docs, length):
    got = [(r.doc_id, r.n_bytes, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in sd.repeats(frame(spark, docs), length).collect()]
    assert sorted(got, key=str) == brute(docs, length)


def corpus(seed, n, alphabet, longest):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 90))) for _ in range(12)]
    docs = []
    for i in range(n):
        t = "".join(rng.choice([rng.choice(pieces), "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30)))]) for _ in range(rng.randrange(0, longest)))
        docs.append((i, t))
    return docs


@pytest.mark.parametrize("length", [50, 7, 2])
def test_matches_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 1500)
    docs = [*corpus(length, 80, "ab\0é ", 12), (200, None), (201, ""), (None, "ab" * 40), (None, "ab" * 40), (5, "b" * 300), (202, "b" * 120), (5, "b" * 120), (203, "b" * 49)]
    check(spark, docs, length)


def test_copies_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(50_000))
    check(spark, [(9, long), (2, long[20_000:45_000]), (3, "x" + long[100:151] + "y"), *((i, "same words in every copy of this text, again and again") for i in range(100, 160))], 50)


def test_empty(spark):
    check(spark, [], 50)
    check(spark, [(1, None), (2, "")], 50)


def test_front_coding_and_merge():
    rng = np.random.default_rng(1)
    for n_runs in (1, 2, 3, 7):
        runs = []
        for _ in range(n_runs):
            rows = np.unique(rng.integers(0, 3, (int(rng.integers(1, 60)), 9)).astype(np.uint8), axis=0)
            runs.append((rows, rng.integers(0, 99, len(rows))))
        decoded = [sd.front_decode(sd.front_code(*r), 9) for r in runs]
        for (rows, docs), (got, prefixes, got_docs) in zip(runs, decoded):
            assert (rows == got).all() and (docs == got_docs).all() and (prefixes == sd.common_prefixes(rows)).all()
        order, common = sd.merge_runs([(r.tobytes(), p.tolist()) for r, p, _ in decoded], 9)
        every = np.concatenate([r for r, _ in runs])
        merged = [every[i].tobytes() for i in order]
        assert merged == sorted(r.tobytes() for r in every) and sorted(order) == list(range(len(every)))
        assert common == sd.common_prefixes(every[order]).tolist()
    assert sd.merge_runs([], 9) == ([], [])


def test_gram_hashes():
    data = np.frombuffer(b"abcabcabcXabcabc", np.uint8)
    for k in (1, 2, 3, 5, 7, 8):
        h = sd.gram_hashes(data, k)
        assert len(h) == len(data) - k + 1
        for i in range(len(h)):
            for j in range(len(h)):
                assert (h[i] == h[j]) == (bytes(data[i : i + k]) == bytes(data[j : j + k]))
