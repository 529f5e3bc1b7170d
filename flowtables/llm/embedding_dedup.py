"""Near duplicates among embeddings by sorted projection passes.

**Passes.** A pass turns a vector into a string of random hashes: after a random rotation, a
hash is the number and sign of the largest coordinate. Vectors are ordered lexicographically
by these strings, and each is compared with its neighbours in the order, at least ``WINDOW``
to either side, also across partitions. Close vectors share long beginnings of their strings
in some pass. How many passes are needed follows from the number of rows: a pair right at
the threshold meets in one pass with a chance that is estimated from the hashes.

**Comparisons.** A pass carries no vectors but bytes (8 bits a component) with the exact norm
of what the rounding lost, so a product of two of them bounds the cosine from both sides.
Pairs that are surely linked are united within the task; pairs that only may be are compared
exactly, unless they are in one component by then. Nothing is linked by an estimate.

**Links.** Windows are bounded, groups of copies aren't, so links are not counted in the
windows. Every component is counted exactly: small ones by all products within a task, large
ones around their centroid. Vectors within half the threshold's angle of it are all linked
with each other, whatever their number; the others are compared with the whole component in
blocks, which yields counts and no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from flowtables.llm.common import staged
from flowtables.llm.components import components

#: Neighbours compared to either side, at least.
WINDOW = 512
#: Hashes of a string; 64 components give 7 bits each.
HASHES = 6
#: The chance that a pair right at the threshold meets in a pass, when passes are counted.
RECALL = 0.98
#: Members of a component (or of a block of one) that one task compares with each other.
BLOCK = 2_000
#: A component is large only with more than this part of all members, so at most so many are broadcast.
LARGE_PART = 100_000
_WIDE = 256
_PASS = "key binary, vec_id long, nid long, sketch binary"
_FOUND = "kind int, a_vec long, a_nid long, b_vec long, b_nid long, edge int, key binary, sketch binary"


def unit_rows(column: pa.ListArray | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) of the usable vectors, by their length.

    Vectors that are null, empty or zero, or hold null or non-finite components, are left out.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        x = values[starts[rows][:, None] + np.arange(size)]
        top = np.abs(x).max(1)
        good = np.isfinite(top) & (top > 0)
        x = x[good] / top[good, None]
        yield rows[good], x / np.sqrt((x * x).sum(1))[:, None]


@lru_cache(maxsize=None)
def _rotation(size: int, number: int, hash_: int) -> np.ndarray:
    """A random rotation of vectors of this length; long ones are projected to fewer components."""
    random = np.random.default_rng([size, number, hash_]).standard_normal((size, min(size, _WIDE)))
    return (np.linalg.qr(random)[0] if size <= _WIDE else random / math.sqrt(_WIDE)).astype(np.float32)


def hashes(x: np.ndarray, number: int, count: int = HASHES) -> np.ndarray:
    """The hashes of pass ``number``, one row per vector: twice the place of the largest coordinate, plus its sign."""
    x = x.astype(np.float32)
    out = np.empty((len(x), count), ">u2")
    for h in range(count):
        y = x @ _rotation(x.shape[1], number, h)
        place = np.abs(y).argmax(1)
        out[:, h] = 2 * place + (y[np.arange(len(y)), place] < 0)
    return out


@lru_cache(maxsize=None)
def passes_for(rows: int, size: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes in which a pair at the threshold meets at least once with a chance of ``recall``.

    Two vectors share a beginning of h hashes with the chance p ** h; among so many rows a
    window holds the rows of a beginning of about log(rows / window) bits. p is measured on
    random pairs at the threshold.
    """
    random = np.random.default_rng(size)
    a, z = (v / np.linalg.norm(v, axis=1)[:, None] for v in random.standard_normal((2, 4000, size)))
    z -= (z * a).sum(1)[:, None] * a
    z /= np.maximum(np.linalg.norm(z, axis=1), 1e-300)[:, None]
    b = threshold * a + math.sqrt(max(0.0, 1 - threshold**2)) * z
    same = max(0.01, float((hashes(a, 0, 1) == hashes(b, 0, 1)).mean()))
    bits = math.log2(2 * min(size, _WIDE))
    meets = same ** (max(0.0, math.log2(max(rows, 1) / window)) / bits)
    return 1 if meets > 0.999 else max(2, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def _passes(vectors: DataFrame, passes: int) -> DataFrame:
    """One row per vector and pass: the pass, length and hashes as ``key``, and the vector in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch[at : at + 2_000]
                for rows, x in unit_rows(part["embedding"]):
                    if not len(rows):
                        continue
                    scale = np.abs(x).max(1) / 127
                    small = np.rint(x / scale[:, None]).astype(np.int8)
                    lost = np.sqrt(((x - small * scale[:, None]) ** 2).sum(1))
                    # The rounding of scale and loss to four bytes is part of the loss.
                    tail = np.stack([scale, lost + 2e-7], 1).astype("<f4")
                    sketch = pa.array([a.tobytes() + b.tobytes() for a, b in zip(small, tail)], pa.binary())
                    ids = part["vec_id"].take(pa.array(rows)), part["nid"].take(pa.array(rows))
                    for number in range(passes):
                        head = number.to_bytes(2, "big") + x.shape[1].to_bytes(4, "big")
                        key = pa.array([head + h.tobytes() for h in hashes(x, number)], pa.binary())
                        yield pa.RecordBatch.from_arrays([key, *ids, sketch], names=["key", "vec_id", "nid", "sketch"])

    return vectors.mapInArrow(run, _PASS)


class _Rows:
    """Rows of one pass and vector length in order: their places in the task, bytes and losses."""

    def __init__(self, places: np.ndarray, sketches: list[bytes]):
        self.places = places
        raw = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
        tail = np.ascontiguousarray(raw[:, -8:]).view("<f4")
        self.x = np.ascontiguousarray(raw[:, :-8]).view(np.int8).astype(np.float32) * tail[:, :1]
        self.lost = tail[:, 1]


class _Sets:
    """Sets of places that are united link by link."""

    def __init__(self):
        self.up: list[int] = []

    def grow(self, n: int) -> None:
        self.up.extend(range(len(self.up), len(self.up) + n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def tops(self, places: np.ndarray) -> np.ndarray:
        return np.array([self.top(i) for i in places.tolist()], np.int64)

    def join(self, left: _Rows, right: _Rows, threshold: float) -> np.ndarray:
        """Unite what is surely linked; returns the pairs of places that may be."""
        product = left.x @ right.x.T
        loss = left.lost[:, None] + right.lost[None, :] + left.lost[:, None] * right.lost[None, :] + np.float32(1e-5)
        sure = product - loss >= threshold
        maybe = (product + loss >= threshold) & ~sure
        while sure.any():
            sure &= self.tops(left.places)[:, None] != self.tops(right.places)[None, :]
            rows = np.flatnonzero(sure.any(1))
            for i, j in zip(rows.tolist(), sure[rows].argmax(1).tolist()):
                a, b = self.top(int(left.places[i])), self.top(int(right.places[j]))
                self.up[max(a, b)] = min(a, b)
        i, j = np.nonzero(maybe)
        return np.stack([left.places[i], right.places[j]], 1)


def _found(kind: int, a: list, b: list) -> pa.RecordBatch:
    columns = [[kind] * len(a), [x[0] for x in a], [x[1] for x in a], [x[0] for x in b], [x[1] for x in b]]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    rest = [pa.nulls(len(a), t) for t in (pa.int32(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds)), *rest], names=["kind", "a_vec", "a_nid", "b_vec", "b_nid", "edge", "key", "sketch"])


def _results(sets: _Sets, names: list, unsure: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """What was united (kind 0), each with the first of its set, and pairs of different sets to look at (kind 1)."""
    top = [sets.top(i) for i in range(len(names))]
    lower = [i for i, t in enumerate(top) if i != t]
    for at in range(0, len(lower), 50_000):
        some = lower[at : at + 50_000]
        yield _found(0, [names[i] for i in some], [names[top[i]] for i in some])
    for pairs in unsure:
        open_ = [(i, j) for i, j in pairs.tolist() if i != j and top[i] != top[j]]
        if open_:
            yield _found(1, [names[i] for i, _ in open_], [names[j] for _, j in open_])


def _neighbours(ordered: DataFrame, threshold: float, window: int) -> DataFrame:
    """Compare neighbours within the partitions; the rims come out as rows of kind 2, by the edge they lie at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        sets, names, unsure = _Sets(), [], []
        before, head, rim, tail = None, None, [], []

        def close(block: list) -> _Rows:
            rows = _Rows(np.arange(len(names), len(names) + len(block)), [r[3] for r in block])
            names.extend((r[1], r[2]) for r in block)
            sets.grow(len(block))
            unsure.append(sets.join(rows, rows, threshold))
            if before is not None:
                unsure.append(sets.join(before, rows, threshold))
            return rows

        block: list = []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("key", "vec_id", "nid", "sketch"))):
                if len(rim) < window:
                    rim.append(row)
                if block and (row[0][:6] != head or len(block) == window):
                    rows = close(block)
                    before = rows if row[0][:6] == head else None
                    tail = block
                    block = []
                head = row[0][:6]
                block.append(row)
        if block:
            close(block)
            tail = (tail + block)[-window:]
        yield from _results(sets, names, unsure)
        # Both rims of the partition: its first rows at edge ``number``, its last at the next.
        for edge, rows, kind in ((number, rim, 2), (number + 1, tail, 3)):
            if rows:
                key, vec, nid, sketch = (list(c) for c in zip(*rows))
                n = len(rows)
                columns = ([kind] * n, vec, nid, [None] * n, [None] * n, [edge] * n, [k[:6] for k in key], sketch)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["kind", "a_vec", "a_nid", "b_vec", "b_nid", "edge", "key", "sketch"])

    return ordered.mapInArrow(run, _FOUND)


def _across_edges(rims: DataFrame, threshold: float) -> DataFrame:
    """The last rows of a partition against the first of the next; a group has two windows of rows at most."""

    def run(table: pa.Table) -> pa.Table:
        sets, names, unsure = _Sets(), [], []
        kind, key = table["kind"].to_pylist(), table["key"].to_pylist()
        vec, nid, sketch = (table[c].to_pylist() for c in ("a_vec", "a_nid", "sketch"))
        names = list(zip(vec, nid))
        sets.grow(len(names))
        for head in set(key):
            sides = [[i for i in range(len(names)) if key[i] == head and kind[i] == side] for side in (3, 2)]
            if all(sides):
                left, right = (_Rows(np.array(side), [sketch[i] for i in side]) for side in sides)
                unsure.append(sets.join(left, right, threshold))
        return pa.Table.from_batches(list(_results(sets, names, unsure)) or [_found(0, [], [])])

    return rims.groupBy("edge").applyInArrow(run, _FOUND)


def _node(prefix: str) -> Column:
    """A vector as a node: nodes are ordered by vec_id, null last."""
    return F.struct(F.col(f"{prefix}_vec").isNull().alias("no_id"), F.col(f"{prefix}_vec").alias("vec_id"), F.col(f"{prefix}_nid").alias("nid"))


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose cosine, in double precision, reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            right = {int(i): v for rows, y in unit_rows(batch["y"]) for i, v in zip(rows, y)}
            for rows, x in unit_rows(batch["x"]):
                for i, v in zip(rows.tolist(), x):
                    good[i] = len(right[i]) == len(v) and float(v @ right[i]) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(good))

    kind = pairs.schema["a"].dataType.simpleString()
    left = vectors.select(F.col("nid").alias("a_key"), F.col("embedding").alias("x"))
    right = vectors.select(F.col("nid").alias("b_key"), F.col("embedding").alias("y"))
    both = pairs.join(left, F.col("a.nid") == F.col("a_key")).join(right, F.col("b.nid") == F.col("b_key"))
    return both.select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}")


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    return x @ y.T >= threshold


def _small_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(nid, n): links of each member of components that fit a task; rows come ordered by component."""

    def count(nids: list, vectors: pa.Table) -> pa.RecordBatch:
        n = np.zeros(len(nids), np.int64)
        for rows, x in unit_rows(vectors["embedding"]):
            n[rows] = _linked(x, x, threshold).sum(1) - 1
        return pa.RecordBatch.from_arrays([pa.array(nids, pa.int64()), pa.array(n)], names=["nid", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            labels = held["label"].to_numpy()
            cuts = np.flatnonzero(np.diff(labels)) + 1
            for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
                part = held.slice(a, b - a)
                yield count(part["nid"].to_pylist(), part)
            held = held.slice(int(cuts[-1])) if len(cuts) else held
        if held is not None and len(held):
            yield count(held["nid"].to_pylist(), held)

    ordered = members.select(F.col("label.nid").alias("label"), "nid", "embedding").repartition("label").sortWithinPartitions("label")
    return ordered.mapInArrow(run, "nid long, n long")


def _centroids(members: DataFrame) -> DataFrame:
    """(label, centre): the sum of the unit vectors of each component, from sums of its blocks."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(x.sum(0) for _, x in unit_rows(table["embedding"]))
        return pa.table({"label": pa.array([table["label"][0].as_py()] * len(total), pa.int64()), "place": pa.array(np.arange(len(total), dtype=np.int32)), "value": pa.array(total)})

    sums = members.groupBy("label", "own").applyInArrow(add, "label long, place int, value double")
    whole = sums.groupBy("label", "place").agg(F.sum("value").alias("value"))
    return whole.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda v: v["value"]).alias("centre"))


def _large_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(nid, n) for components of any size: ``members`` has label, nid, embedding, and blocks, the number of its blocks."""
    # Half the angle, less what rounding could add.
    near = math.cos(math.acos(max(-1.0, min(1.0, threshold))) / 2 - 1e-7)
    placed = staged(members.select(F.col("label.nid").alias("label"), "nid", "embedding", "blocks", F.expr("cast(pmod(xxhash64(nid), blocks) as int) AS own")), "large-members")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = np.zeros(len(batch), bool)
            centres = {int(i): c for rows, y in unit_rows(batch["centre"]) for i, c in zip(rows, y)}
            for rows, x in unit_rows(batch["embedding"]):
                for i, v in zip(rows.tolist(), x):
                    core[i] = i in centres and float(v @ centres[i]) >= near
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("label", "nid", "embedding", "blocks", "own")), pa.array(core)], names=["label", "nid", "embedding", "blocks", "own", "core"])

    def compare(table: pa.Table) -> pa.Table:
        side, core, nid = table["side"].to_numpy(), table["core"].to_numpy(zero_copy_only=False), table["nid"].to_numpy()
        n = np.zeros(len(nid), np.int64)
        (rows, x), = [r for r in unit_rows(table["embedding"])]
        mine, all_ = rows[side[rows] == 0], rows[side[rows] == 1]
        at = np.empty(len(nid), np.int64)
        at[rows] = np.arange(len(rows))
        links = _linked(x[at[mine]], x[at[all_]], threshold) & (nid[mine][:, None] != nid[all_][None, :])
        n[mine] = links.sum(1)
        n[all_] = np.where(core[all_], links.sum(0), 0)
        return pa.table({"nid": nid[n > 0], "n": n[n > 0]})

    spread = placed.select("label", "blocks").distinct().join(_centroids(placed), "label").select("label", "centre", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("own"))
    kind = dict(placed.dtypes)["embedding"]
    tested = placed.join(spread, ["label", "own"]).mapInArrow(test, f"label long, nid long, embedding {kind}, blocks long, own int, core boolean")
    cored = staged(tested, "cores")
    sizes = cored.groupBy("label").agg(F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("others"))
    # Sizes are one row per large component, at most LARGE_PART of them.
    known = cored.join(F.broadcast(sizes), "label").withColumn("rims", F.expr(f"cast(others div {BLOCK} + 1 as int)"))
    rims = known.where("others > 0")
    mine = rims.where("NOT core").select("label", "nid", "embedding", "core", F.lit(0).alias("side"), F.expr("cast(pmod(xxhash64(nid), rims) as int) AS i"), F.explode(F.expr("sequence(0, cast(blocks as int) - 1)")).alias("j"))
    all_ = rims.select("label", "nid", "embedding", "core", F.lit(1).alias("side"), F.explode(F.expr("sequence(0, rims - 1)")).alias("i"), F.col("own").alias("j"))
    compared = mine.unionByName(all_).groupBy("label", "i", "j").applyInArrow(compare, "nid long, n long")
    inner = known.where("core").select("nid", (F.col("cores") - 1).alias("n"))
    return inner.unionByName(compared).groupBy("nid").agg(F.sum("n").alias("n"))


def near_embeddings(vectors: DataFrame, threshold: float = 0.9, passes: int | None = None, window: int = WINDOW, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links and components of vectors whose cosine is at least ``threshold``.

    Returns one row per row: vec_id (long), n_links (other rows linked directly), component_id
    (the smallest vec_id reachable by links, itself included) and kept (vec_id =
    component_id).

    Vectors that are null, empty or zero, or hold null or non-finite components, have no link
    and are components of their own; vectors of different lengths have no link either. Rows
    with equal vec_ids are vectors of their own, and equal vectors are linked. A null vec_id
    counts as the largest. Other columns are not read, whatever their names. An empty table
    gives no rows. A row must fit a task; nothing else is held whole.

    ``passes`` follows from the number of rows if it isn't given: components are found with
    the chance RECALL for a pair right at the threshold, more for closer ones. All links
    within a component are counted. ``threshold`` is above zero.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    held = staged(rows.select(F.monotonically_increasing_id().alias("nid"), "vec_id", "embedding"), "vectors")
    facts = held.agg(F.count("*").alias("rows"), F.percentile_approx(F.size("embedding"), 0.5).alias("size")).first()
    passes = passes or passes_for(facts["rows"], max(1, facts["size"] or 1), threshold, window)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _passes(held, passes).repartitionByRange(parts, "key", "sketch").sortWithinPartitions("key", "sketch")
    found = staged(_neighbours(ordered, threshold, window), "neighbours")
    edges = staged(_across_edges(found.where("kind >= 2"), threshold), "edges")
    pairs = found.where("kind < 2").unionByName(edges).select("kind", _node("a").alias("a"), _node("b").alias("b"))
    sure = staged(pairs.where("kind = 0").select("a", "b").distinct(), "united")
    labels = components(sure)
    # Pairs that may be linked, unless their components are one already.
    open_ = pairs.where("kind = 1").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = labels.select(F.col("node"), "label")
    open_ = open_.join(of.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(of.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    open_ = open_.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")
    more = staged(_verified(open_, held, threshold), "verified")
    if not more.isEmpty():
        labels = components(sure.unionByName(more))
    members = staged(labels.select(F.col("node.nid").alias("nid"), "label").join(held.select("nid", "embedding"), "nid"), "members")
    sizes = members.groupBy("label").agg(F.count("*").alias("size"))
    least = max(BLOCK, members.count() // LARGE_PART)
    large = F.broadcast(sizes.where(F.col("size") > least).select("label", F.expr(f"size div {BLOCK} + 1").alias("blocks")))
    small = members.join(large, "label", "left_anti")
    counts = _small_counts(small, threshold).unionByName(_large_counts(members.join(large, "label"), threshold))
    counted = counts.join(labels.select(F.col("node.nid").alias("nid"), F.col("label.vec_id").alias("component_id"), F.lit(True).alias("joined")), "nid")
    out = held.select("nid", "vec_id").join(counted, "nid", "left")
    component = F.when(F.col("joined"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
