"""Positional index, phrase and proximity search, decontamination."""

import random
import re

from flowtables.llm import decontamination as dc


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        d, hit, found = words(t), set(), set()
        for item, q in items:
            q = words(q)
            n = min(window, len(q))
            for k in range(len(q) - n + 1 if n else 0):
                for at in range(len(d) - n + 1):
                    if d[at : at + n] == q[k : k + n]:
                        hit |= set(range(at, at + n))
                        found.add(item)
        out.append((i, len(d), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "q", 2) for i, t in docs], "doc_id long, text string, segment int, query string, item_id int").repartition(3)
    return d, spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id long, text string, doc_id int, block string")


def check(spark, docs, items, window=10):
    got = dc.decontaminate(*frames(spark, docs, items), window)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, window)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c", "é", "日本", "1x", "the", "the", "the"]
    text = lambda k: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(k))
    return [(i, text(rng.randrange(0, 60))) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    docs = [*corpus(1, 60), (None, "a b c"), (3, "same id, the the"), (3, None), (61, ""), (62, "the " * 3000)]
    items = [*corpus(2, 25), (100, None), (101, ""), (102, "the"), (103, "B c, É"), (None, "a b"), (102, "c c c"), (104, "-- !!")]
    for window in (1, 3, 10):
        check(spark, docs, items, window)
    monkeypatch.setattr(dc, "SEGMENT_WORDS", 40)
    monkeypatch.setattr(dc, "BLOCK_WORDS", 10)
    check(spark, docs, items, 4)
    monkeypatch.setattr(dc, "BROADCAST_BYTES", 0)
    check(spark, docs, items, 4)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a"), (2, None)], [])


def test_proximity(spark):
    docs = [(1, "a x b x c"), (2, "c b a"), (3, "a b"), (4, "a x x x x b c"), (5, "b"), (6, "c")]
    index = dc.build_index(frames(spark, docs, [])[0])
    for query, within, want in (("a b c", 5, {1, 2}), ("C a", 3, {2}), ("a b c", 7, {1, 2, 4}), ("zzz a", 9, set()), ("", 9, set()), ("b", 1, {1, 2, 3, 4, 5})):
        found = dc.proximity_matches(index, frames(spark, [], [(1, query)])[1], within)
        rows = found.join(index, "segment").collect()
        assert {r.doc_ids[r.ordinal] for r in rows} == want
        for r in rows:
            d = words(dict(docs)[r.doc_ids[r.ordinal]])
            assert all(set(words(query)) <= set(d[a : b + 1]) and b - a < within for a, b in zip(r.starts, r.ends))
