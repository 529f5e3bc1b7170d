"""Removal of word sequences that an earlier document has too, by recompression.

**Rounds of names.** The words of all documents are named, and then rounds replace runs of
one symbol and pairs of neighbouring symbols by new symbols. Half of all symbols, by a bit of
their name and the round, open pairs and half close them; an opener and the closer behind it
become one symbol. Whether two neighbours join depends on these two alone, so equal
stretches of text get equal symbols in their interior wherever they stand. A symbol's name is
a 64-bit function of the names it is made from, hence the same in every task, and a round
needs no exchange. Symbols never grow beyond ``CAP`` words.

**What a window is sure of.** At its rims a window can't know how a round joins its outermost
symbols with what is outside, so each round sets these aside. What remains is its middle.

**Spellings.** Symbols only bring windows together. Whether two windows have the same words is
decided by spellings of 128 bits. They begin with names that different words never share
(short words are their own names, long ones have a cryptographic digest), and the two
halves go through separate, non-linear functions up to the window.

**Shared symbols.** Every window is filed under one symbol of its middle, the one with the
smallest hash; a window without a middle is filed under its own spelling. Only windows under
symbols that two documents share can repeat. Their spellings (128 bits) are gathered by part,
each block sending a spelling once with its smallest document, and the parts answer with one
bit: whether a smaller document has it.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowtables.llm.blocks import Block, distinct_keys, live_keys, open_block, part_slices, shared_keys, stage_blocks
from flowtables.llm.common import mix64, pack, partitions_for, ranges, staged, unpack
from flowtables.llm.suffix_dedup import covered_bytes

#: Rounds, each of runs and then pairs.
ROUNDS = 4
#: Most words of a symbol.
CAP = 16
_RUN, _PAIR, _SIDE, _PICK = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_HALVES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Marks the name of a word that doesn't fit one.
_LONG = 255


def words_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, second half of the name, begin, document) of every word: runs of bytes other than the six ASCII blanks.

    The two halves are 128 bits that differ for different words: words of up to 15 bytes are
    their own names, with their length, and a longer word has the BLAKE2b digest of its bytes.
    Both halves are mixed reversibly, so that each alone serves as a random number.
    """
    data = block.data
    inside = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    some = block.ends > block.starts
    firsts, lasts = block.starts[some], block.ends[some] - 1
    opens[firsts] |= inside[1:-1][firsts]
    closes[lasts] |= inside[1:-1][lasts]
    starts, sizes = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sizes -= starts
    room = np.concatenate([data, np.zeros(16, np.uint8)])
    eights = np.ndarray((len(data) + 9,), "<u8", room, strides=(1,))  # the eight bytes from every place on
    low = eights[starts] & _BYTES[np.minimum(sizes, 8)]
    high = eights[starts + 8] & _BYTES[np.clip(sizes - 8, 0, 8)] | np.minimum(sizes, _LONG).astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(sizes > 15)
    if len(long):
        raw = data.tobytes()
        digests = b"".join(hashlib.blake2b(raw[a : a + n], digest_size=16).digest() for a, n in zip(starts[long].tolist(), sizes[long].tolist()))
        pairs = np.frombuffer(digests, "<u8").reshape(-1, 2)
        low[long] = pairs[:, 0]
        high[long] = pairs[:, 1] | np.uint64(_LONG) << np.uint64(56)
    with np.errstate(over="ignore"):
        for k in range(4):
            low, high = high, low ^ mix64(high + _HALVES[0] * np.uint64(k + 1))
    return low, high, starts, np.searchsorted(block.ends, starts, "right")


def _joined(a: np.ndarray, b: np.ndarray, half: int, size: int) -> np.ndarray:
    """One half of the name of two stretches of ``size`` words, from the same half of theirs."""
    with np.errstate(over="ignore"):
        return mix64(mix64(a + _HALVES[half] * np.uint64(size)) + b)


@dataclass
class Level:
    """Symbols after some rounds, and what the next round sets aside at a window's rims.

    ``starts`` are the first words of the symbols and, at the end, the number of words.
    ``ahead[w]`` and ``back[w]``, for a word w at a symbol's edge, are where the part that a
    window beginning or ending there is sure of begins or ends after the next round.
    """

    names: np.ndarray
    starts: np.ndarray
    ahead: np.ndarray | None = None
    back: np.ndarray | None = None


def _step_runs(level: Level, docs: np.ndarray) -> Level:
    names, starts = level.names, level.starts
    own = docs[starts[:-1]]
    new = np.concatenate([[True], (names[1:] != names[:-1]) | (own[1:] != own[:-1])])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(names)))
    run = np.cumsum(new) - 1
    joined = (counts > 1) & (counts * np.diff(starts)[heads] <= CAP)
    edges = np.append(starts[heads], starts[-1])
    level.ahead[starts[:-1]] = edges[run + 1]
    level.back[starts[1:]] = edges[run]
    named = names.copy()
    with np.errstate(over="ignore"):
        named[heads[joined]] = mix64(names[heads[joined]] * _RUN + counts[joined].astype(np.uint64))
    keep = new | ~joined[run]
    return Level(named[keep], np.append(starts[:-1][keep], starts[-1]))


def _step_pairs(level: Level, docs: np.ndarray, number: int) -> Level:
    names, starts = level.names, level.starts
    with np.errstate(over="ignore"):
        opener = (mix64(names + np.uint64(number + 1) * _SIDE) & np.uint64(1)).astype(bool)
    own, sizes = docs[starts[:-1]], np.diff(starts)
    joined = np.zeros(len(names), bool)
    joined[:-1] = opener[:-1] & ~opener[1:] & (own[1:] == own[:-1]) & (sizes[:-1] + sizes[1:] <= CAP)
    level.ahead[starts[:-1]] = np.where(opener, starts[:-1], starts[1:])
    level.back[starts[1:]] = np.where(opener, starts[:-1], starts[1:])
    named = names.copy()
    first = np.flatnonzero(joined)
    with np.errstate(over="ignore"):
        named[first] = mix64(names[first] * _PAIR + (names[first + 1] ^ (names[first + 1] << np.uint64(21))) + np.uint64(number))
    keep = np.ones(len(names), bool)
    keep[first + 1] = False
    return Level(named[keep], np.append(starts[:-1][keep], starts[-1]))


def recompress(names: np.ndarray, docs: np.ndarray) -> list[Level]:
    """All levels, from the words up."""
    n = len(names)
    levels = [Level(names, np.arange(n + 1))]
    for number in range(2 * ROUNDS):
        level = levels[-1]
        level.ahead, level.back = np.arange(n + 1), np.arange(n + 1)
        if n:
            levels.append(_step_pairs(level, docs, number) if number % 2 else _step_runs(level, docs))
        else:
            levels.append(Level(names, level.starts))
    return levels


class Windows:
    """All windows of a block: where they begin, and the symbols they are filed under."""

    def __init__(self, block: Block, length: int):
        self.length = length
        names, seconds, _, self.docs = words_of(block)
        self.names = names, seconds
        self.levels = recompress(names, self.docs)
        n = len(names)
        self.n_words = np.bincount(self.docs, minlength=len(block.ids))
        self.first_word = np.cumsum(self.n_words) - self.n_words
        fits = np.maximum(self.n_words - length + 1, 0)
        self.begin = ranges(self.first_word, fits)
        a, b = self.begin, self.begin + length
        for level in self.levels[:-1]:
            a, b = level.ahead[a], level.back[b]
        top = self.levels[-1]
        index = np.zeros(n + 1, np.int64)
        index[top.starts] = np.arange(len(top.starts))
        keys = np.zeros(len(a), np.uint64)
        middle = a < b
        keys[middle] = self._picked(top.names, index[a[middle]], index[b[middle]])
        rest = np.flatnonzero(~middle)
        keys[rest] = self.spellings(rest)[0]
        # Windows side by side mostly share their symbol; one key for each such group.
        doc = self.docs[self.begin]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])) if len(keys) else np.zeros(0, np.int64)
        self.group = np.zeros(len(keys), np.int64)
        self.group[new[1:]] = 1
        self.group = np.cumsum(self.group)
        self.keys, self.several, self.where = distinct_keys(keys[new], doc[new])

    @staticmethod
    def _picked(names: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Name of the symbol with the smallest hash (the first of equals) of each range."""
        bits = np.uint64(max(1, len(names).bit_length()))
        table = (mix64(names ^ _PICK) >> bits << bits) | np.arange(len(names), dtype=np.uint64)
        spans = stop - first
        out = np.zeros(len(first), np.uint64)
        size = 1
        while True:
            now = np.flatnonzero((spans >= size) & (spans < 2 * size))
            out[now] = np.minimum(table[first[now]], table[stop[now] - size])
            if not (spans >= 2 * size).any():
                return mix64(names[(out & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)])
            table = np.minimum(table[: len(table) - size], table[size:])
            size *= 2

    def spellings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The names of these windows: two independent halves, each from one half of the names of its words.

        Stretches of 1, 2, 4 and more words get names from those of their halves; a window is
        the two longest such stretches in it, which overlap.
        """
        if not len(which):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        out, begin = [], self.begin[which]
        for half, names in enumerate(self.names):
            size = 1
            while 2 * size <= self.length:
                names = _joined(names[:-size], names[size:], half, size)
                size *= 2
            out.append(_joined(names[begin], names[begin + self.length - size], half, self.length))
        return out[0], out[1]


def _shared(block: Block, replies: pa.Table, parts: int, length: int):
    """Windows under shared symbols: (windows, which, their place among the block's spellings, spellings, smallest ids)."""
    windows = Windows(block, length)
    live = live_keys(windows.keys, replies, parts)
    which = np.flatnonzero(live[windows.where][windows.group]) if len(windows.begin) else np.zeros(0, np.int64)
    high, low = windows.spellings(which)
    ids = block.order[windows.docs[windows.begin[which]]]
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])) if len(h) else np.zeros(0, np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    least = np.minimum.reduceat(ids[order], first) if len(first) else np.zeros(0, np.int64)
    return windows, which, place, (h[first], w[first]), least, ids


def repeated_windows(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of each document within a ``length``-word window of a document with a smaller id.

    Returns one row per document row: doc_id, n_words, spans (array of removed runs as
    ``start`` and ``stop`` in words, maximal and ascending) and kept (the other words, joined
    by one space, as UTF-8).

    Words are runs of characters other than space, tab and the line breaks from \\x0A to \\x0D;
    they are compared unchanged. Windows never cross documents and are judged on the input.
    Null and empty texts have no words, and texts of fewer than ``length`` words lose none. A
    null id counts as the largest; rows with equal ids don't remove each other's words. An
    empty table gives no rows. A document of any length is one block, which a task holds some
    thirty times over; other columns are not read, whatever their names.
    """
    blocks = stage_blocks(docs, id_col, text_col)
    parts = partitions_for(blocks)

    def keys_of(block: Block):
        windows = Windows(block, length)
        return windows.keys, windows.several

    def gather(block_table: pa.Table, replies: pa.Table) -> pa.Table:
        _, _, _, (high, low), least, _ = _shared(open_block(block_table), replies, parts, length)
        rows = [(part, b - a, pack(high[a:b].astype("<u8").tobytes() + low[a:b].astype("<u8").tobytes() + least[a:b].astype("<i8").tobytes())) for part, a, b in part_slices(high, parts)]
        columns = zip(*rows) if rows else ([], [], [])
        part, n, data = (pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary())))
        return pa.table({"block": pa.array([block_table["block"][0].as_py()] * len(rows), pa.int64()), "part": part, "n": n, "data": data})

    def answer(table: pa.Table) -> pa.Table:
        counts = table["n"].to_numpy()
        raw = [unpack(d, "<u8") for d in table["data"].to_pylist()]
        high, low, least = (np.concatenate([r[k * n : (k + 1) * n] for r, n in zip(raw, counts)]) for k in range(3))
        least = least.view(np.int64)
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
        smallest = np.repeat(np.minimum.reduceat(least[order], first), np.diff(np.append(first, len(order))))
        earlier = np.empty(len(order), bool)
        earlier[order] = least[order] > smallest
        ends = np.cumsum(counts)
        return pa.table({"block": table["block"], "part": table["part"], "live": pa.array([np.packbits(earlier[e - n : e]).tobytes() for e, n in zip(ends, counts)], pa.binary()), "kind": pa.array([1] * len(counts), pa.int32())})

    def remove(block_table: pa.Table, answers: pa.Table) -> pa.Table:
        block = open_block(block_table)
        kinds = answers["kind"].to_numpy()
        shared, earlier = (answers.filter(pa.array(kinds == k)) for k in (0, 1))
        windows, which, place, (high, _), least, ids = _shared(block, shared, parts, length)
        gone = (ids > least[place]) | live_keys(high, earlier, parts)[place]
        begun = np.zeros(len(windows.docs), bool)
        begun[windows.begin[which[gone]]] = True
        removed = covered_bytes(begun, length)
        counts, spans, kept = windows.n_words, [], []
        for i in range(len(block.ids)):
            words = block.data[block.starts[i] : block.ends[i]].tobytes().split()
            out = removed[windows.first_word[i] : windows.first_word[i] + counts[i]]
            if out.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))).tolist()
                spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])])
                words = [w for a, b in zip([0, *edges[1::2]], [*edges[::2], len(words)]) for w in words[a:b]]
            else:
                spans.append([])
            kept.append(b" ".join(words))
        return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPANS), "kept": pa.array(kept, pa.binary())})

    replies = staged(shared_keys(blocks, keys_of), "shared-symbols")
    gathered = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(gather, "block long, part int, n int, data binary")
    verdicts = gathered.groupBy("part").applyInArrow(answer, "block long, part int, live binary, kind int")
    both = verdicts.unionByName(replies.selectExpr("block", "part", "live", "0 AS kind"))
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(remove, "doc_id long, n_words long, spans array<struct<start:long,stop:long>>, kept binary")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
