"""Recompression: consistent names, spellings, and removal of repeated windows."""

import random
import re

import numpy as np
import pytest

from flowtables.llm import blocks, substring_dedup as sub


def brute(docs, length):
    rank = lambda i: (i is None, i or 0)
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in split:
        for p in range(len(w) - length + 1):
            s = tuple(w[p : p + length])
            least[s] = min(least.get(s, (True, 2**63)), rank(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if least[tuple(w[p : p + length])] < rank(i):
                gone[p : p + length] = [True] * length
        spans, p = [], 0
        while p < len(w):
            q = p
            while q < len(w) and gone[q]:
                q += 1
            if q > p:
                spans.append((p, q))
            p = max(q, p + 1)
        out.append((i, len(w), spans, " ".join(x for x, g in zip(w, gone) if not g).encode()))
    return sorted(out, key=str)


def check(spark, docs, length):
    df = spark.createDataFrame([(i, t, 1, "p", 2) for i, t in docs], "doc_id long, text string, block int, part string, kind int").repartition(4)
    got = [(r.doc_id, r.n_words, [(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in sub.repeated_windows(df, length).collect()]
    assert sorted(got, key=str) == brute(docs, length)


def corpus(seed, n, vocabulary, longest):
    rng = random.Random(seed)
    pieces = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))] for _ in range(12)]
    docs = []
    for i in range(n):
        w = [x for _ in range(rng.randrange(0, longest)) for x in rng.choice([rng.choice(pieces), [rng.choice(vocabulary) for _ in range(rng.randrange(0, 30))]])]
        docs.append((i, "".join(x + rng.choice([" ", "\n", "\t ", "\x0b"]) for x in w)))
    return docs


@pytest.mark.parametrize("length", [50, 12, 1])
def test_matches_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2500)
    docs = [*corpus(length, 70, ["a", "b", "é x", "c\x1cd", "日本"], 9), (200, None), (201, " \n"), (None, "a " * 80), (None, "a " * 80), (5, "b " * 300), (202, "b " * 120), (5, "b " * 120), (203, "b " * 49), (204, "x" * 5000 + " y" * 60), (205, "z" + " y" * 60)]
    check(spark, docs, length)


def test_copies_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 6000)
    rng = random.Random(3)
    long = [str(rng.randrange(5000)) for _ in range(20_000)]
    docs = [(9, " ".join(long)), (2, " ".join(long[9_000:15_000])), (3, " ".join(["u", *long[100:150], "v"])), *((i, " ".join(long[500:570])) for i in range(100, 160))]
    check(spark, docs, 50)


def thue_morse(n, swap=False):
    """``n`` letters such that it and its swapped form collide in every polynomial hash modulo a power of two."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


@pytest.mark.parametrize("size", [9, 15, 16, 1024, 8192])
def test_windows_that_differ_in_one_long_word_stay(spark, size):
    rest = " ".join(f"w{i}" for i in range(49))
    check(spark, [(1, f"{thue_morse(size)} {rest}"), (2, f"{thue_morse(size, True)} {rest}"), (3, f"{rest} {thue_morse(size)}"), (4, f"{rest} {thue_morse(size, True)}")], 50)


def test_long_windows_over_two_words(spark):
    """Windows of 1,024 words that follow the same pattern with their two words swapped."""
    docs = [(i, " ".join(thue_morse(1024, i % 2)) + (" a" * (i // 2))) for i in range(1, 5)]
    check(spark, docs, 1024)


def test_names_of_different_words_differ():
    rng = random.Random(9)
    words = {thue_morse(n, s) for n in (1, 8, 15, 16, 17, 1024) for s in (False, True)} | {rng.randbytes(rng.randrange(1, 24)).hex() for _ in range(5000)} | {"a" * n for n in range(1, 40)}
    data = " ".join(sorted(words)).encode()
    names, seconds, starts, _ = sub.words_of(blocks.Block([1], np.array([0]), np.array([len(data)]), np.frombuffer(data, np.uint8)))
    assert len(set(zip(names.tolist(), seconds.tolist()))) == len(words) == len(starts)
    assert len(set(names.tolist())) == len(set(seconds.tolist())) == len(words)


@pytest.mark.parametrize("half", [0, 1])
def test_colliding_half_names_remove_nothing(spark, monkeypatch, half):
    """Either half of a name may be worthless: the other one tells windows apart."""
    true = sub.words_of

    def poor(block):
        found = list(true(block))
        found[half] = found[half] & np.uint64(3)
        return tuple(found)

    monkeypatch.setattr(sub, "words_of", poor)
    rng = random.Random(11)
    words = [rng.choice("abcdefgh") for _ in range(60)]
    texts = [words, [*words[:30], "x", *words[31:]], [*words[:30], "y", *words[31:]], words[:55] + ["z"]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    blocks_ = sub.stage_blocks(df).toArrow()
    windows = sub.Windows(blocks.open_block(blocks_), 20)
    spelled = list(zip(*(x.tolist() for x in windows.spellings(np.arange(len(windows.begin))))))
    split = [t for d in blocks_["doc_ids"][0].as_py() for t in [texts[d]]]
    seen = {}
    for p, s in zip(windows.begin, spelled):
        d = windows.docs[p]
        w = tuple(split[d][p - windows.first_word[d] :][:20])
        assert seen.setdefault(s, w) == w


def test_empty(spark):
    check(spark, [], 50)
    check(spark, [(1, None), (2, "")], 50)


def test_equal_windows_have_equal_keys_and_spellings():
    rng = random.Random(5)
    for vocabulary in (["a", "b"], [str(i) for i in range(400)]):
        passage = [rng.choice(vocabulary) for _ in range(80)]
        texts = [" ".join([*(rng.choice(vocabulary) for _ in range(rng.randrange(40))), *passage, *(rng.choice(vocabulary) for _ in range(rng.randrange(40)))]).encode() for _ in range(30)]
        sizes = np.array([len(t) for t in texts])
        block = blocks.Block(list(range(30)), np.cumsum(sizes) - sizes, np.cumsum(sizes), np.frombuffer(b"".join(texts), np.uint8))
        windows = sub.Windows(block, 50)
        split = [t.decode().split() for t in texts]
        spelled = list(zip(*(x.tolist() for x in windows.spellings(np.arange(len(windows.begin))))))
        by_words, by_spelling = {}, {}
        for i, (p, s) in enumerate(zip(windows.begin, spelled)):
            d = windows.docs[p]
            w = tuple(split[d][p - windows.first_word[d] :][:50])
            key = windows.keys[windows.where[windows.group[i]]]
            assert by_words.setdefault(w, (s, key)) == (s, key)
            assert by_spelling.setdefault(s, w) == w
        assert max(np.diff(windows.levels[-1].starts)) <= sub.CAP
        assert len(windows.levels[-1].names) < 0.5 * len(windows.levels[0].names)
