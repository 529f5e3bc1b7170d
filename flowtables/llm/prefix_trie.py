"""A trie of conversations' beginnings, in balanced parentheses.

**Shards.** Conversations are strings of turn names (16 bytes of SHA-256 each). They are
range-partitioned and sorted by these strings and their ids, so that a partition, a shard, holds a
stretch of the trie in depth-first order. A task adds one conversation after the other: what
it shares with the one before stays open, the rest is closed. The shape is a sequence of
parentheses, one pair a node.

**Parentheses.** The excess (opened less closed) has its minimum kept for blocks of
parentheses, and for pairs of blocks up to the whole. ``findclose`` walks to the first block that falls
below a node's excess, which ends its subtree. Leaves are pairs ``()``: counts of them up to
both ends give a subtree's leaves. Nodes number themselves in the order of their opening
parentheses, so that cumulative sums over that order give members and savings of any
subtree.

**Spines.** Only nodes on the way to a shard's first or last conversation can lie in other
shards too. A shard sends them as its outline, a row of a few numbers a node; outlines
merge by the same trie, in the order of shards. All other nodes are finished in their
shard, but for the name of a parent on the spine. Lists of members that end at a spine node
stay spread over shards until they are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import pack, staged, unpack

#: Bytes of a turn's name.
NAME = 16
#: Parentheses of a block.
BLOCK = 256
_FAR = np.int64(2**63 - 1)
_STATS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE = ", ".join(f"{c} long" for c in _STATS) + ", ends_sha256 string"
#: kind 0: a finished node; 1: one whose parent is the spine node (shard, spine); 2: an outline; 3: ids that end at a spine node.
_SHARD = f"kind int, shard long, spine long, data binary, {_NODE}"
_EMPTY = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A balanced sequence with block minima of its excess: closing partners and counts of leaves."""

    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits.astype(bool), block
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        room = -(-len(bits) // block) * block
        held = np.full(room, np.iinfo(np.int64).max)
        held[: len(bits)] = self.excess
        # Minima of blocks, of pairs of blocks and so on; a level of odd length ends with a block that is never low.
        self.levels = [held.reshape(-1, block).min(1)] if len(bits) else []
        while self.levels and len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = self.levels[-1] = np.append(low, np.iinfo(np.int64).max)
            self.levels.append(low.reshape(-1, 2).min(1))
        leaf = np.zeros(len(bits), bool)
        leaf[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.leaves = np.cumsum(leaf)

    def _scan(self, start: np.ndarray, stop: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place from ``start`` whose excess is not above ``target``; ``stop`` where there is none."""
        at, open_ = start.copy(), np.arange(len(start))
        while len(open_):
            open_ = open_[at[open_] < stop[open_]]
            open_ = open_[self.excess[at[open_]] > target[open_]]
            at[open_] += 1
        return at

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``opens`` close."""
        target = self.excess[opens] - 1
        end = np.minimum((opens // self.block + 1) * self.block, len(self.bits))
        at = self._scan(opens + 1, end, target)
        todo = np.flatnonzero(at == end)
        if len(todo):
            at[todo] = self._beyond(opens[todo] // self.block, target[todo])
        return at

    def _beyond(self, blocks: np.ndarray, target: np.ndarray) -> np.ndarray:
        node, level = blocks.copy(), np.zeros(len(blocks), np.int64)
        up = np.arange(len(blocks))
        height = 0
        while len(up):  # climb until the block to the right is low enough
            low = self.levels[height]
            right = (node[up] % 2 == 0) & (node[up] + 1 < len(low))
            right &= low[np.minimum(node[up] + 1, len(low) - 1)] <= target[up]
            node[up[right]] += 1
            level[up[right]] = height
            up = up[~right]
            node[up] //= 2
            height += 1
        for height in range(len(self.levels) - 1, 0, -1):  # down to the first block that is
            down = np.flatnonzero(level >= height)
            node[down] *= 2
            node[down[self.levels[height - 1][node[down]] > target[down]]] += 1
        start = node * self.block
        return self._scan(start, np.minimum(start + self.block, len(self.bits)), target)


class Trie:
    """Nodes in depth-first order, added by ascending strings, each node with what it holds itself.

    ``members``, ``least``, ``kids``, ``leaves`` and ``saved`` are of what hangs directly at a
    node and isn't in this trie: members that end there, or subtrees finished elsewhere.
    """

    def __init__(self):
        self.bits = bytearray(b"\1")
        self.names, self.depth, self.tokens, self.parent = [b""], [0], [0], [-1]
        self.members, self.least, self.kids, self.leaves, self.saved = [0], [int(_FAR)], [0], [0], [0]
        self.path = [0]

    def open(self, names: list[bytes], tokens: list[int]) -> int:
        """The node of this string of names, which must not be less than the one before."""
        at = 0
        while at < len(names) and at + 1 < len(self.path) and self.names[self.path[at + 1]] == names[at]:
            at += 1
        self.bits += bytes(len(self.path) - 1 - at)
        del self.path[at + 1 :]
        for name, n in zip(names[at:], tokens[at:]):
            self.bits.append(1)
            self.names.append(name)
            self.depth.append(len(self.path))
            self.tokens.append(n)
            self.parent.append(self.path[-1])
            for column, empty in ((self.members, 0), (self.least, int(_FAR)), (self.kids, 0), (self.leaves, 0), (self.saved, 0)):
                column.append(empty)
            self.path.append(len(self.names) - 1)
        return self.path[-1]

    def hold(self, node: int, members: int, least: int, kids: int = 0, leaves: int = 0, saved: int = 0) -> None:
        self.members[node] += members
        self.least[node] = min(self.least[node], least)
        self.kids[node] += kids
        self.leaves[node] += leaves
        self.saved[node] += saved

    def close(self) -> dict[str, np.ndarray]:
        """Statistics of every node over its subtree."""
        self.bits += bytes(len(self.path))
        self.path = []
        bits = np.frombuffer(bytes(self.bits), np.uint8)
        shape = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = shape.findclose(opens)
        first, stop = np.arange(len(opens)), np.cumsum(bits, dtype=np.int64)[closes]
        depth, parent = np.array(self.depth), np.array(self.parent)

        def below(values) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(np.asarray(values, np.int64))])
            return sums[stop] - sums[first]

        n_convs = below(self.members)
        least = np.array(self.least, np.int64)
        order = np.argsort(depth, kind="stable")[::-1]
        for at in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            at = at[parent[at] >= 0]
            np.minimum.at(least, parent[at], least[at])
        kids = np.array(self.kids, np.int64)
        inner = np.bincount(parent[1:], minlength=len(parent)).astype(np.int64)
        pairs = np.concatenate([[0], shape.leaves])
        # A pair () is a leaf unless something finished elsewhere hangs at it.
        own = (kids > 0) & (inner == 0)
        n_leaves = pairs[closes + 1] - pairs[opens] - below(own) + below(self.leaves)
        saved = below((n_convs - 1) * np.array(self.tokens, np.int64) + np.array(self.saved, np.int64))
        return {"conv_id": least, "depth": depth, "parent": parent, "n_convs": n_convs, "n_children": kids + inner, "n_leaves": n_leaves, "saved_tokens": saved}


def _split(key: bytes) -> list[bytes]:
    return [key[i : i + NAME] for i in range(0, len(key), NAME)]


def _listed(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trie of one shard: finished nodes, nodes below its spine, its outline, and ids that end at the spine."""
    number = TaskContext.get().partitionId()
    trie, ends, first = Trie(), {}, None
    for batch in batches:
        for conv_id, key, tokens in zip(*(batch[c].to_pylist() for c in ("conv_id", "names", "tokens"))):
            node = trie.open(_split(key), tokens)
            trie.hold(node, 1, conv_id)
            ends.setdefault(node, []).append(conv_id)
            first = list(trie.path) if first is None else first
    if first is None:
        return
    spine = sorted({*first, *trie.path})
    tokens, names, own_members, own_least = trie.tokens, trie.names, trie.members, trie.least
    stats = trie.close()
    parent, conv_id = stats["parent"], stats["conv_id"]
    on_spine = np.zeros(len(parent), bool)
    on_spine[spine] = True
    place = np.cumsum(on_spine) - 1
    hanging = np.flatnonzero(~on_spine & on_spine[parent])
    # What the spine holds itself: members that end there and the subtrees beside it.
    held = {"members": np.array(own_members, np.int64), "least": np.array(own_least, np.int64)}
    held |= {k: np.zeros(len(parent), np.int64) for k in ("kids", "leaves", "saved")}
    for column, values in (("members", stats["n_convs"]), ("kids", np.ones_like(parent)), ("leaves", stats["n_leaves"]), ("saved", stats["saved_tokens"])):
        np.add.at(held[column], parent[hanging], values[hanging])
    np.minimum.at(held["least"], parent[hanging], conv_id[hanging])
    outline = np.stack([stats["depth"][spine], np.array(tokens, np.int64)[spine], *(held[c][spine] for c in ("members", "least", "kids", "leaves", "saved"))])
    data = pack(outline.astype("<i8")), pack(b"".join(names[i] for i in spine))
    rest = np.flatnonzero(~on_spine)
    kind = np.where(on_spine[parent[rest]], 1, 0)
    for at in range(0, len(rest), 50_000):
        some, kinds = rest[at : at + 50_000], kind[at : at + 50_000]
        up = parent[some]
        hashes = [hashlib.sha256(_listed(ends[i])).hexdigest() if i in ends else _EMPTY for i in some.tolist()]
        columns = {"kind": kinds, "shard": np.full(len(some), number), "spine": place[up], "data": None, "conv_id": conv_id[some], "parent_conv_id": conv_id[up]}
        yield _rows(len(some), **columns, **{c: stats[c][some] for c in ("depth", "n_convs", "n_children", "n_leaves", "saved_tokens")}, ends_sha256=hashes)
    yield _rows(2, kind=[2, 2], shard=[number] * 2, spine=[0, 1], data=list(data))
    for i in spine:
        ids = ends.get(i, [])
        for at in range(0, len(ids), 100_000):
            yield _rows(1, kind=[3], shard=[number], spine=[int(place[i])], data=[_listed(ids[at : at + 100_000])], depth=[at])


def _rows(n: int, **columns) -> pa.RecordBatch:
    names = ["kind", "shard", "spine", "data", *_STATS, "ends_sha256"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * len(_STATS), pa.string()]
    arrays = [pa.nulls(n, t) if columns.get(c) is None else pa.array(columns[c], t) for c, t in zip(names, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _merged(table: pa.Table) -> pa.Table:
    """All outlines as one trie: for each spine node of each shard its place there and its statistics."""
    trie, where = Trie(), []
    parts: dict = {}
    for shard, part, data in zip(*(table[c].to_pylist() for c in ("shard", "spine", "data"))):
        parts.setdefault(shard, {})[part] = data
    for shard in sorted(parts):
        depth, tokens, members, least, kids, leaves, saved = unpack(parts[shard][0], "<i8").reshape(7, -1).tolist()
        names = [b"", *_split(unpack(parts[shard][1], np.uint8).tobytes())]
        path: list[int] = []
        for i, d in enumerate(depth):
            path = [*path[:d], i]
            if i + 1 < len(depth) and depth[i + 1] > d:
                continue  # on the way to the next one
            trie.open([names[j] for j in path[1:]], [tokens[j] for j in path[1:]])
            for j, node in zip(path, trie.path):
                if len(where) == 0 or where[-1][0] != shard or where[-1][1] < j:
                    trie.hold(node, members[j], least[j], kids[j], leaves[j], saved[j])
                    where.append((shard, j, node))
    stats = trie.close()
    shard, spine, node = (np.array(c, np.int64) for c in zip(*where))
    parent = stats["parent"][node]
    new = np.zeros(len(node), bool)
    new[np.unique(node, return_index=True)[1]] = True
    columns = {"shard": pa.array(shard), "spine": pa.array(spine), "node": pa.array(node), "first": pa.array(new)}
    columns |= {c: pa.array(stats[c][node], pa.int64()) for c in _STATS if c != "parent_conv_id"}
    columns["parent_conv_id"] = pa.array(stats["conv_id"][parent], pa.int64(), mask=parent < 0)
    return pa.table(columns)


_MERGED = "shard long, spine long, node long, first boolean, " + ", ".join(f"{c} long" for c in _STATS)


def _hash_ends(chunks: DataFrame) -> DataFrame:
    """(node, ends_sha256) of spine nodes: their lists of ids, in pieces by ascending shard, hashed as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            nodes, hashes = [], []
            for node, data in zip(batch["node"].to_pylist(), batch["data"].to_pylist()):
                if node != current:
                    if digest:
                        nodes.append(current)
                        hashes.append(digest.hexdigest())
                    current, digest = node, hashlib.sha256(data)
                else:
                    digest.update(b"," + data)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    return chunks.repartition("node").sortWithinPartitions("node", "shard", "depth").select("node", "data").mapInArrow(run, "node long, ends_sha256 string")


def sequences(turns: DataFrame) -> DataFrame:
    """Conversations as strings of turns: conv_id and ``seq``, an array of (turn, name, tokens) in order.

    Turns are taken by number, null first, and turns of one number by their names. A name
    is 16 bytes of SHA-256 of role and text (null: empty), tokens are the code points of the
    text. Rows without a conv_id are of no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * NAME))
    light = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), name.alias("name"), F.length(text).cast("long").alias("tokens")).alias("t"))
    return light.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("seq"))


def with_shared_heads(seqs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversation c begins with the first crc32(c) % ``most`` turns of conversation c - c % ``every``; its own first ones go."""
    c = F.col("conv_id")
    own = seqs.select("conv_id", "seq", (c - c % every).alias("base"), (F.crc32(c.cast("string").cast("binary")) % most).cast("int").alias("h"))
    # A base has ``every`` followers at most, and of its turns only the first few are joined.
    heads = seqs.where(c % every == 0).select(c.alias("base"), F.slice("seq", 1, most - 1).alias("head"))
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("seq", 1, 0)).otherwise(F.slice("head", F.lit(1), F.greatest("h", F.lit(1))))
    own_rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq"), F.lit(1)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, own_rest).alias("seq"))


def _names(seq: str) -> Column:
    """The names of a string of turns, one behind the other."""
    return F.unhex(F.concat_ws("", F.transform(seq, lambda t: F.hex(t["name"]))))


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per distinct beginning of the conversations in ``seqs`` (conv_id, seq).

    Returns conv_id (the smallest member), depth (turns), parent_conv_id (null for the
    root), n_convs (members: conversations that begin so), n_children, n_leaves (childless
    nodes of the subtree, itself included), saved_tokens (over the subtree, each node's
    n_convs - 1 times the tokens of its last turn) and ends_sha256 (of the ids of members that
    end there, ascending and comma-joined).

    A conversation without turns ends at the root; no conversations give no rows. A
    conversation is one row of some 50 bytes a turn in the exchange, so it must fit a task,
    as must the nodes of a shard; texts are never moved. Ids are distinct.
    """
    spark = seqs.sparkSession
    flat = staged(seqs.select("conv_id", _names("seq").alias("names"), F.transform("seq", lambda t: t["tokens"]).alias("tokens")), "strings")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = flat.repartitionByRange(parts, "names", "conv_id").sortWithinPartitions("names", "conv_id")
    found = staged(ordered.mapInArrow(_shard, _SHARD), "shards")
    outlines = found.where("kind = 2").select("shard", "spine", "data", F.lit(0).alias("one"))
    merged = staged(outlines.groupBy("one").applyInArrow(_merged, _MERGED), "spines")
    chunks = found.where("kind = 3").select("shard", "spine", "depth", "data").join(merged.select("shard", "spine", "node"), ["shard", "spine"])
    ends = _hash_ends(chunks)
    columns = [*_STATS, "ends_sha256"]
    inner = found.where("kind = 0").select(*columns)
    # A shard's children of its spine: as many rows a key as the shard has nodes, whatever the size of the spine node.
    beside = found.where("kind = 1").drop("parent_conv_id").join(merged.select("shard", "spine", F.col("conv_id").alias("parent_conv_id")), ["shard", "spine"]).select(*columns)
    spine = merged.where("first").join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(*columns)
    return inner.unionByName(beside).unionByName(spine)
