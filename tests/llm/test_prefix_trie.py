"""Balanced parentheses, and the trie against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from flowtables.llm import prefix_trie as pt


def test_findclose_and_leaves():
    rng = random.Random(2)
    for n in (1, 2, 7, 300, 2000):
        for bias in (0.5, 0.9):
            bits, open_ = [1], 1
            while len(bits) + open_ < 2 * n:
                bit = 1 if open_ == 1 or rng.random() < bias else 0
                bits.append(bit)
                open_ += 1 if bit else -1
            bits += [0] * open_
            stack, close, leaves = [], {}, {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    close[stack.pop()] = i
            shape = pt.Parentheses(np.array(bits), block=4)
            opens = np.array(sorted(close))
            ends = shape.findclose(opens)
            assert ends.tolist() == [close[i] for i in opens.tolist()]
            sums = np.concatenate([[0], shape.leaves])
            leaves = [sum(bits[k] and not bits[k + 1] for k in range(i, close[i])) for i in opens.tolist()]
            assert (sums[ends + 1] - sums[opens]).tolist() == leaves


def plain(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn, role or "", text or ""))
    name = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, name(t), len(t[2])))
    built = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = [(r, t) for _, r, t in own.get(base, [])[:h] + turns[h:]]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), set()).add(c)
    out = []
    for path, ids in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in under if len(p) == len(path) + 1]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under) for p in under)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(path))
        out.append((min(ids), len(path), min(nodes[path[:-1]]) if path else None, len(ids), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    turns = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "conv_id long, turn long, role string, text string, names string, depth int, data binary").repartition(3)
    return sorted((tuple(r) for r in pt.prefix_trie(pt.with_shared_heads(pt.sequences(turns))).collect()), key=str)


def odd_rows():
    rng = random.Random(4)
    texts = [None, "", "a", "b", "a b", "long " * 30_000, "é"]
    rows = []
    for c in [-250, -200, -7, 0, 3, *range(100, 140), *range(199, 210), 1000]:
        if c == 199:
            continue
        for t in range(rng.randrange(7)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(texts)))
    return rows + [(None, 0, "user", "of no conversation")] + rows[:4]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_trie_equals_plain_python(spark, parts):
    """Also with many shards, whose spines are most of the trie."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = odd_rows()
        assert got(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_over_many_shards(spark):
    """One conversation in very many copies: its node and those above it lie in every shard."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 30_000, 100) for t in range(3)]
    rows += [(c, t, "user", "x") for c in range(5) for t in range(2)]
    assert got(spark, rows) == plain(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    assert got(spark, [(c, 0, "user", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
