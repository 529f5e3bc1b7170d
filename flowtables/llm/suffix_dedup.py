"""Removal of byte strings that an earlier document has too, over sorted suffixes.

**Which suffixes are sorted.** Every window of ``length`` bytes picks one position inside it,
its anchor: the first smallest hash of the K-byte strings in the window. Equal windows pick
the same place, so windows are compared at their anchors: the suffix that begins there and
the bytes that lead up to it. For windows of 50 bytes about one position in thirteen is an anchor. Anchors whose first
K bytes occur in one document only can't belong to a repeat and are left out beforehand (an
exact screen: it lets some through too many, and never one too few).

**Distributed merge sort.** Each block of documents sorts its anchor suffixes, keeps equal
ones once with their smallest document, and writes the sorted run front-coded: the length of
the common prefix with the suffix before, and the rest. Runs go to the part of their first K
bytes. A part combines its runs with a loser tree that carries the known common prefixes:
players whose prefixes with the last winner differ in length are ordered by that alone, and
where they agree the comparison begins behind the known prefix. The merged order comes with
the common prefix of all neighbours, and from that follow the classes of equal windows at
every distance from the anchor, and the smallest document of each class. A 32-bit mask per
suffix, one bit for each distance, goes back to the block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowtables.llm.blocks import Block, distinct_keys, live_keys, open_block, part_of, shared_keys, stage_blocks
from flowtables.llm.common import mix64, pack, partitions_for, ranges, staged, unpack

#: Most distances between a window's begin and its anchor; they have one bit each in a mask.
DISTANCES = 31
_CHUNK = 1 << 15
_BASE = 0x9E3779B97F4A7C15 | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each position on, put together from hashes of 1, 2, 4 ... bytes."""
    step = data.astype(np.uint64) + np.uint64(1)
    out, done, size = None, 0, 1
    while True:
        if k & size:
            # The part of ``size`` bytes begins ``done`` bytes into the string.
            out = step if out is None else out[: len(out) - size] * _power(size) + step[done : done + len(out) - size]
            done += size
        size *= 2
        if size > k:
            return out
        half = size // 2
        step = step[:-half] * _power(half) + step[half:]


def anchors(block: Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, nearest, farthest, key) of the anchors of all windows of a block, ascending.

    ``nearest`` and ``farthest`` are the distances back to the last and the first window that
    picked the anchor; all windows between did too. ``key`` mixes its first K bytes.
    """
    distances = min(DISTANCES, (length + 1) // 2)
    k = length + 1 - distances
    data, n = block.data, len(block.data)
    valid = np.ones(n, bool)
    tails = np.minimum(block.ends - block.starts, length - 1)
    valid[ranges(block.ends - tails, tails)] = False
    found = []
    for at in range(0, n, _CHUNK):
        ok = np.flatnonzero(valid[at : at + _CHUNK])
        if not len(ok):
            continue
        grams = gram_hashes(data[at : at + _CHUNK + length - 1], k)
        hashes = grams ^ (grams >> np.uint64(29))
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        # The position in the low bits gives the first of equal hashes, and the place of the smallest.
        low = (hashes & np.uint64(0xFFFFFFFFFFFE0000)) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while 2 * span <= distances:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < distances:
            low = np.minimum(low[: len(low) - (distances - span)], low[distances - span :])
        place = (low[ok] & np.uint64(0x1FFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        ends = np.append(new[1:] - 1, len(ok) - 1)
        found.append((at + place[new], at + ok[new], at + ok[ends], grams[place[new]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first, last, grams = (np.concatenate(x) for x in zip(*found))
    new = np.flatnonzero(np.diff(place, prepend=-1))  # an anchor goes on in the next chunk
    ends = np.append(new[1:] - 1, len(place) - 1)
    return place[new], place[new] - last[ends], place[new] - first[new], mix64(grams[new])


def _block_keys(block: Block, length: int):
    place, near, far, keys = anchors(block, length)
    docs = np.searchsorted(block.ends, place, "right")
    distinct, several, where = distinct_keys(keys, docs)
    return place, near, far, docs, distinct, several, where


def records(block: Block, place: np.ndarray, near: np.ndarray, far: np.ndarray, length: int) -> np.ndarray:
    """One row of bytes per anchor: what follows, what leads up to it backwards, and both distances.

    Bytes that belong to none of the anchor's windows are zero, so they never tell rows apart.
    """
    back = min(DISTANCES, (length + 1) // 2) - 1
    padded = np.pad(block.data, (back, length))
    out = np.empty((len(place), length + back + 2), np.uint8)
    for k in range(length):  # a column at a time, so that no index is larger than the result
        out[:, k] = padded[place + (back + k)]
        out[k >= length - near, k] = 0
    for k in range(back):
        out[:, length + k] = padded[place + (back - 1 - k)]
        out[k >= far, length + k] = 0
    out[:, -2], out[:, -1] = near, far
    return out


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Bytes each row has in common with the row before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differs = rows[1:] != rows[:-1]
        out[1:] = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return out


def front_code(rows: np.ndarray, docs: np.ndarray) -> bytes:
    """A sorted run: common prefixes, smallest documents, and the bytes behind the prefixes."""
    prefixes = common_prefixes(rows)
    tails = rows[np.arange(rows.shape[1]) >= prefixes[:, None]]
    return pack(len(rows).to_bytes(8, "little") + prefixes.astype(np.uint8).tobytes() + docs.astype("<i8").tobytes() + tails.tobytes())


def front_decode(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, prefixes, docs) of a run: every byte comes from the last row that spells it out."""
    raw = unpack(data, np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    prefixes = raw[8 : 8 + n].astype(np.int64)
    docs = raw[8 + n : 8 + 9 * n].view("<i8") if (8 + n) % 8 == 0 else np.frombuffer(raw[8 + n : 8 + 9 * n].tobytes(), "<i8")
    spelled = np.arange(width) >= prefixes[:, None]
    rows = np.zeros((n, width), np.uint8)
    rows[spelled] = raw[8 + 9 * n :]
    number = np.arange(n, dtype=np.int32)
    for k in range(width):
        rows[:, k] = rows[np.maximum.accumulate(np.where(spelled[:, k], number, 0)), k]
    return rows, prefixes, docs


def merge_runs(runs: list[tuple[bytes, list[int]]], width: int) -> tuple[list[int], list[int]]:
    """Combine sorted runs with a loser tree over common prefixes.

    A run is its rows, joined, and the prefix of each with the row before. Returns for each
    row in merged order its number (runs count on from each other) and its prefix with the
    row before it in that order. Bytes within a known prefix are never looked at again.
    """
    data = b"".join(rows for rows, _ in runs)
    prefixes = [p for _, own in runs for p in own]
    heads, at = [], 0
    for _, own in runs:
        heads.append(at)
        at += len(own)
    stops = [*heads[1:], at]
    size = 1 << max(0, (len(runs) - 1).bit_length())
    heads += [0] * (size - len(runs))
    stops += [0] * (size - len(runs))
    done = -1  # prefix of a run that has ended: it loses against every other
    number = int.from_bytes

    # Nodes hold the loser and its common prefix with the winner that passed by.
    losers, known = [0] * size, [0] * size
    level = [(r, 0 if heads[r] < stops[r] else done) for r in range(size)]
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            (a, pa_), (b, pb) = level[i], level[i + 1]
            slot = node + i // 2
            if pa_ != pb:
                winner, loser = ((a, pa_), (b, pb)) if pa_ > pb else ((b, pb), (a, pa_))
            elif pa_ == done:
                winner, loser = (a, pa_), (b, pb)
            else:
                x, y = heads[a] * width, heads[b] * width
                s, t = number(data[x : x + width]), number(data[y : y + width])
                same = width - ((s ^ t).bit_length() + 7) // 8
                winner, loser = ((a, 0), (b, same)) if s <= t else ((b, 0), (a, same))
            losers[slot], known[slot] = loser
            up.append(winner)
        level = up
    run, prefix = level[0]

    order, common = [], []
    while prefix != done:
        row = heads[run]
        order.append(row)
        common.append(prefix)
        row += 1
        heads[run] = row
        prefix = prefixes[row] if row < stops[run] else done
        node = (size + run) >> 1
        while node:
            other = known[node]
            if other > prefix:
                losers[node], run = run, losers[node]
                known[node], prefix = prefix, other
            elif other == prefix and prefix != done:
                rival = losers[node]
                x, y, end = heads[run] * width, heads[rival] * width, width
                s, t = number(data[x + prefix : x + end]), number(data[y + prefix : y + end])
                same = width - ((s ^ t).bit_length() + 7) // 8
                if t < s:
                    losers[node], run = run, rival
                known[node] = same
            node >>= 1
    return order, common


def window_masks(rows: np.ndarray, prefixes: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For rows in sorted order: bit d is set if a smaller document has the window d bytes before the anchor.

    Two rows have equal windows at distance d if they agree on ``length - d`` bytes from the
    anchor on and on d bytes before it; the classes of either follow from common prefixes.
    """
    back = min(DISTANCES, (length + 1) // 2) - 1
    n = len(rows)
    masks = np.zeros(n, np.uint32)
    near, far = rows[:, -2], rows[:, -1]
    before = np.ascontiguousarray(rows[:, length : length + back])
    order = np.argsort(before.view(f"S{back}").ravel(), kind="stable") if back else np.arange(n)
    before_prefixes = common_prefixes(before[order]) if back else np.zeros(n, np.int64)
    behind = np.empty(n, np.int64)
    for d in range(back + 1):
        use = np.flatnonzero((near <= d) & (d <= far))
        if len(use) < 2:
            continue
        after = np.cumsum(prefixes < length - d)
        behind[order] = np.cumsum(before_prefixes < d)
        key = after[use] * (n + 1) + behind[use]
        by = np.argsort(key, kind="stable")
        key, own = key[by], docs[use[by]]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.repeat(np.minimum.reduceat(own, first), np.diff(np.append(first, len(key))))
        masks[use[by]] |= (own > least).astype(np.uint32) << np.uint32(d)
    return masks


def _sorted_suffixes(block: Block, replies: pa.Table, parts: int, length: int):
    """Anchors under shared keys with their ids and distinct rows, and the distinct rows by part.

    Returns (position, nearest, farthest, id, number of its row) of each anchor, the smallest
    id of each row, the rows in order, and (part, begin, end) of the parts' runs.
    """
    place, near, far, docs, distinct, _, where = _block_keys(block, length)
    use = np.flatnonzero(live_keys(distinct, replies, parts)[where])
    place, near, far, ids = place[use], near[use], far[use], block.order[docs[use]]
    part = part_of(distinct, parts)[where[use]]
    rows = np.concatenate([part.astype(">u4").view(np.uint8).reshape(-1, 4), records(block, place, near, far, length)], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    new = common_prefixes(rows[order]) < rows.shape[1]
    first = np.flatnonzero(new)
    number = np.empty(len(use), np.int64)
    number[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], first) if len(first) else np.zeros(0, np.int64)
    rows, part = rows[order[first], 4:], part[order[first]]
    heads = np.flatnonzero(np.diff(part, prepend=-1))
    cuts = list(zip(part[heads].tolist(), heads.tolist(), np.append(heads[1:], len(part)).tolist()))
    return place, near, far, ids, number, least, rows, cuts


_RUNS = "block long, part int, data binary"


def repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes of each document that lie in a ``length``-byte string of a document with a smaller id.

    Returns one row per document row: doc_id, n_bytes, spans (array of removed runs as
    ``start`` and ``stop`` in bytes, maximal and ascending) and kept (the other bytes).

    Texts are UTF-8 bytes; strings never cross documents and are judged on the input. Null
    and empty texts, and texts shorter than ``length``, lose nothing. A null id counts as the
    largest; rows with equal ids don't remove each other's bytes. An empty table gives no rows.
    """
    width = length + min(DISTANCES, (length + 1) // 2) + 1
    blocks = stage_blocks(docs, id_col, text_col)
    parts = partitions_for(blocks)

    def keys_of(block: Block):
        return _block_keys(block, length)[4:6]

    def make_runs(block_table: pa.Table, replies: pa.Table) -> pa.Table:
        _, _, _, _, _, least, rows, cuts = _sorted_suffixes(open_block(block_table), replies, parts, length)
        out = [(part, front_code(rows[a:b], least[a:b])) for part, a, b in cuts]
        return pa.table({"block": pa.array([block_table["block"][0].as_py()] * len(out), pa.int64()), "part": pa.array([p for p, _ in out], pa.int32()), "data": pa.array([d for _, d in out], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        decoded = [front_decode(d, width) for d in table["data"].to_pylist()]
        order, common = merge_runs([(rows.tobytes(), prefixes.tolist()) for rows, prefixes, _ in decoded], width)
        order = np.array(order, np.int64)
        masks = np.empty(len(order), np.uint32)
        masks[order] = window_masks(np.concatenate([r for r, _, _ in decoded])[order], np.array(common, np.int64), np.concatenate([d for _, _, d in decoded])[order], length)
        ends = np.cumsum([len(r) for r, _, _ in decoded])
        return pa.table({"block": table["block"], "part": table["part"], "data": pa.array([pack(masks[e - len(r) : e]) for e, (r, _, _) in zip(ends, decoded)], pa.binary())})

    def remove(block_table: pa.Table, answers: pa.Table) -> pa.Table:
        block = open_block(block_table)
        kinds = answers["kind"].to_numpy()
        replies, answered = (answers.filter(pa.array(kinds == k)) for k in (0, 1))
        place, near, far, ids, number, least, _, cuts = _sorted_suffixes(block, replies.rename_columns({"data": "live"}), parts, length)
        by_part = dict(zip(answered["part"].to_pylist(), answered["data"].to_pylist()))
        masks = np.concatenate([np.zeros(0, np.uint32), *(unpack(by_part[part], np.uint32) for part, _, _ in cuts)])
        windows = np.zeros(len(block.data) + 1, bool)
        later = ids > least[number]
        windows[ranges((place - far)[later], (far - near + 1)[later])] = True
        for d in range(DISTANCES):
            hit = ~later & (masks[number] >> np.uint32(d) & np.uint32(1)).astype(bool)
            windows[place[hit] - d] = True
        return removed_table(block, covered_bytes(windows[:-1], length))

    # The runs are sorted once to be sent and once more to read the answers, which is less than
    # keeping all of them and their members on disk in between.
    replies = staged(shared_keys(blocks, keys_of), "shared-anchors")
    runs = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(make_runs, _RUNS)
    masks = runs.groupBy("part").applyInArrow(merge, _RUNS)
    answers = masks.selectExpr("block", "part", "data", "1 AS kind").unionByName(replies.selectExpr("block", "part", "live AS data", "0 AS kind"))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(remove, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def covered_bytes(windows: np.ndarray, length: int) -> np.ndarray:
    """Bytes within ``length`` of a window's begin."""
    sums = np.cumsum(windows, dtype=np.int64)
    sums[length:] -= sums[:-length].copy()
    return sums > 0


def removed_table(block: Block, gone: np.ndarray) -> pa.Table:
    """Documents of a block without the bytes that go."""
    edges = gone.copy()
    starts = edges & ~np.concatenate([[False], edges[:-1]])
    starts[block.starts[block.starts < len(gone)]] |= gone[block.starts[block.starts < len(gone)]]
    stops = edges & ~np.concatenate([edges[1:], [False]])
    lasts = block.ends[block.ends > block.starts] - 1
    stops[lasts] |= gone[lasts]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    of = np.searchsorted(block.ends, starts, "right")
    counts = np.bincount(of, minlength=len(block.ids))
    spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.StructArray.from_arrays([pa.array(starts - block.starts[of], pa.int64()), pa.array(stops - block.starts[of], pa.int64())], ["start", "stop"]))
    left = np.concatenate([[0], np.cumsum(~gone)])
    offsets = np.append(left[block.starts], left[-1]).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(block.ids), [None, pa.py_buffer(offsets), pa.py_buffer(block.data[~gone].tobytes())])
    return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array(block.ends - block.starts, pa.int64()), "spans": spans, "kept": kept})
