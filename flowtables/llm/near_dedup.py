"""Near duplicates by BagMinHash: weighted MinHash of multisets of word shingles.

**Signatures.** A shingle that occurs w times is a weight. Every shingle has independent
Poisson processes over the weight axis, one for each of the intervals [0, 1), [1, 2), [2, 4),
[4, 8) and so on, with as many points in a unit of time as the interval is long. A point
carries a signature component, chosen at random, and the halves of its interval it falls
into, down to a single unit; it counts if that unit lies below w. Shingles of equal weight
share all their points, and one of weight w shares those below w with heavier ones, so that
two signatures agree in a component with the probability of the weighted Jaccard similarity.
A component is the time of its first point. Times are drawn in ascending order and only up
to a limit at which almost surely all components are filled; documents for which they
aren't go on with twice the limit, so the result never depends on it.

**Links.** Bands of the signature put documents into buckets; equal multisets were made one
node before. Every node of a bucket is compared with the bucket's smallest (exact multiset
overlap), and the links give components. Where a bucket still holds several components, the
nodes of different components are compared as well, in blocks: by a bound, by their signatures,
and then exactly. The bound is from the shingles that a node has alone among all nodes
in question, which no other can have in common with it; it rules out most members of a family
of loosely edited copies. Nodes that are connected already need no comparison, so a large
group of copies costs a link for each of its nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.blocks import Block
from flowtables.llm.common import id_text, mix64, staged
from flowtables.llm.components import components
from flowtables.llm.decontamination import _FOLD
from flowtables.llm.substring_dedup import words_of

#: Bands of ROWS components: a pair with similarity 0.8 misses all with a chance of 3 in a million.
BANDS, ROWS = 24, 4
#: A pair of similarity 0.8 agrees in fewer of the 96 components once in a million.
AGREE = 56
#: Nodes of one block of a bucket that are compared with those of another.
BLOCK_NODES = 500
_TEXT_BYTES = 2 << 20
_M = BANDS * ROWS
_SIGNED = "doc_id long, node binary, bands array<long>, signature binary"
_STREAM, _STEP = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingles(texts: list[str | None], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight, second half of the shingle's name) of all texts, ascending: the multiset of runs of ``size`` words.

    Words are lower-case runs of ASCII letters, digits and all characters beyond ASCII. A text
    of fewer words, but not none, has one shingle of all its words.
    """
    data = [(t or "").encode().translate(_FOLD) for t in texts]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    block = Block([], np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends, np.frombuffer(b"".join(data), np.uint8))
    *halves, _, docs = words_of(block)
    n = len(docs)
    counts = np.bincount(docs, minlength=len(texts))
    last = np.cumsum(counts)
    whole = counts >= size
    begins = np.flatnonzero((np.arange(n) + size <= np.repeat(last, counts)) & np.repeat(whole, counts))
    few = np.flatnonzero((counts > 0) & ~whole)
    named = []
    for names, step in zip(halves, (_STEP, _STREAM)):
        with np.errstate(over="ignore"):
            rolled = np.zeros(n, np.uint64)
            for k in range(size):
                # Words beyond the document's end add nothing to its last shingles, which go below.
                rolled[: max(0, n - k)] += mix64(names[k:] + np.uint64(k + 1) * step)
            short = np.zeros(len(few), np.uint64)
            for i, d in enumerate(few):
                own = names[last[d] - counts[d] : last[d]]
                short[i] = mix64(np.add.reduce(mix64(own + np.arange(1, len(own) + 1).astype(np.uint64) * step)) + np.uint64(len(own)))
        named.append(np.concatenate([rolled[begins], short]))
    doc = np.concatenate([docs[begins], few])
    order = np.lexsort((named[0], doc))
    doc, element, second = doc[order], named[0][order], named[1][order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[new], element[new], np.diff(np.append(new, len(doc))), second[new]


def _multiset_names(heads: np.ndarray, element: np.ndarray, second: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """128-bit names of the multisets that begin at ``heads``, each half from one half of their shingles' names."""
    if not len(heads):
        return np.zeros((0, 2), np.uint64)
    with np.errstate(over="ignore"):
        return np.stack([mix64(np.add.reduceat(mix64(mix64(half ^ salt) + weight.astype(np.uint64)), heads)) for half, salt in ((element, _STREAM), (second, _STEP))], 1)


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int = _M) -> np.ndarray:
    """BagMinHash signatures: the time of each component's first point; infinite without elements."""
    # One process per element and interval of the weight axis up to the one that its weight ends in.
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    entry = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(entry)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    span = np.maximum(low, 1)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    signature = np.full((n_docs, m), np.inf)
    flat = signature.reshape(-1)
    with np.errstate(divide="ignore"):
        limit = np.where(total > 0, m * (math.log(m) + 4) / total, 0.0)
    todo = total > 0
    with np.errstate(over="ignore"):
        seed = mix64(element[entry] + (level + 1).astype(np.uint64) * _STREAM)
    while todo.any():
        live = np.flatnonzero(todo[doc[entry]])
        time, number = np.zeros(len(live)), np.uint64(0)
        while len(live):
            with np.errstate(over="ignore"):
                number += np.uint64(1)
                random = mix64(seed[live] + number * _STEP)
                other = mix64(random ^ _STREAM)
            time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / span[live]
            own = doc[entry[live]]
            within = time <= limit[own]
            live, time, own, other = live[within], time[within], own[within], other[within]
            # The bits of a point, from the first, are the halves it falls into; spans are powers of two.
            unit = low[live] + (other >> np.uint64(32)).astype(np.int64) % span[live]
            counts = unit < weight[entry[live]]
            component = ((other & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(flat, (own * m + component)[counts], time[counts])
        todo &= np.isinf(signature).any(axis=1)
        limit[todo] *= 2
    return signature


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """Each document's node (its multiset's 128-bit name; null without words), bands and signature bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(lengths // _TEXT_BYTES, prepend=0)).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(ids)]):
                if a < b:
                    yield one(ids[a:b], texts[a:b].to_pylist())

    def one(ids: list, texts: list[str]) -> pa.RecordBatch:
        doc, element, weight, second = shingles(texts, size)
        signature = bag_minhash(doc, element, weight, len(ids))
        bits = signature.view(np.uint64)
        some = np.bincount(doc, minlength=len(ids)) > 0
        named = np.zeros((len(ids), 2), np.uint64)
        bands = np.zeros((len(ids), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            named[some] = _multiset_names(np.flatnonzero(np.diff(doc, prepend=-1)), element, second, weight)
            for k in range(ROWS):
                bands = mix64(bands + bits[:, k::ROWS])
            bands = mix64(bands + np.arange(BANDS, dtype=np.uint64) * _STEP)
        small = (mix64(bits) & np.uint64(255)).astype(np.uint8)
        rows = [(i, named[r].tobytes(), bands[r].view(np.int64), small[r].tobytes()) if some[r] else (i, None, None, None) for r, i in enumerate(ids)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()))], names=["doc_id", "node", "bands", "signature"])

    return docs.mapInArrow(run, _SIGNED)


def _multisets(docs: DataFrame, size: int) -> DataFrame:
    """(node, elements, weights, total) of documents: packed arrays and the sum of the weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                texts = batch["text"][at : at + 500].to_pylist()
                doc, element, weight, second = shingles(texts, size)
                heads = np.flatnonzero(np.diff(doc, prepend=-1))
                if not len(heads):
                    continue
                named = _multiset_names(heads, element, second, weight)
                edges = np.append(heads, len(doc)).tolist()
                columns = ([n.tobytes() for n in named], [element[a:b].tobytes() for a, b in zip(edges, edges[1:])], [weight[a:b].astype("<u4").tobytes() for a, b in zip(edges, edges[1:])])
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in columns), pa.array(np.add.reduceat(weight, heads).astype(np.int64))], names=["node", "elements", "weights", "total"])

    return docs.mapInArrow(run, "node binary, elements binary, weights binary, total long")


def similarity(a: bytes, u: bytes, b: bytes, v: bytes) -> float:
    """Weighted Jaccard similarity of two packed multisets."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    s, t = np.frombuffer(u, "<u4").astype(np.int64), np.frombuffer(v, "<u4").astype(np.int64)
    place = np.searchsorted(y, x)
    place[place == len(y)] = 0
    common = np.flatnonzero(y[place] == x)
    both = int(np.minimum(s[common], t[place[common]]).sum())
    return both / (int(s.sum()) + int(t.sum()) - both)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets have at least this similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(*row) >= threshold for row in zip(*(batch[c].to_pylist() for c in ("xe", "xw", "ye", "yw")))]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("xe"), F.col("weights").alias("xw"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("ye"), F.col("weights").alias("yw"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "xe", "xw", "ye", "yw").mapInArrow(run, "a binary, b binary")


def _alone(sets: DataFrame) -> DataFrame:
    """(node, total, alone): a multiset's weight, and the weight of what it shares with no other of ``sets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch[at : at + 200]
                elements = [np.frombuffer(e, "<i8") for e in part["elements"].to_pylist()]
                sizes = np.array([len(e) for e in elements])
                node = part["node"].take(pa.array(np.repeat(np.arange(len(elements)), sizes)))
                weight = np.concatenate([np.frombuffer(w, "<u4") for w in part["weights"].to_pylist()]).astype(np.int64)
                yield pa.record_batch([pa.array(np.concatenate(elements)), node, pa.array(weight)], names=["element", "node", "weight"])

    spread = sets.mapInArrow(run, "element long, node binary, weight long")
    once = spread.groupBy("element").agg(F.count("*").alias("nodes"), F.min("node").alias("node"), F.min("weight").alias("weight")).where("nodes = 1")
    alone = once.groupBy("node").agg(F.sum("weight").alias("alone"))
    return sets.select("node", "total").join(alone, "node", "left").fillna(0, "alone")


def _across(members: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of one bucket in different components, enough to join what is linked.

    ``members`` has (band, node, label, signature, bands, total, alone, elements, weights) and
    ``blocks``, into how many blocks the bucket is cut. A task holds two blocks of one bucket.
    A pair is looked at in the first of the bands it shares, and not again when links found
    before have joined its components. It is compared exactly if the signatures agree enough
    and all that neither has alone could reach the threshold.
    """

    def compare(table: pa.Table) -> pa.Table:
        nodes, labels, of = table["node"].to_pylist(), table["label"].to_pylist(), table["own"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        signs = np.stack([np.frombuffer(s, np.uint8) for s in table["signature"].to_pylist()])
        bands = np.array(table["bands"].to_pylist(), np.int64)
        before = bands[:, : int(np.argmax(bands[0] == table["band"][0].as_py()))]
        number = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        group = np.array([number[x] for x in labels])
        total = table["total"].to_numpy()
        common = total - table["alone"].to_numpy()
        elements, weights = table["elements"].to_pylist(), table["weights"].to_pylist()
        out = []
        for r in np.flatnonzero(of == i):
            most = np.minimum(common, common[r])
            rivals = np.flatnonzero((of == j) & (group != group[r]) & (most >= (threshold - 1e-9) * (total + total[r] - most)))
            if len(rivals):
                rivals = rivals[(signs[rivals] == signs[r]).sum(1) >= AGREE]
                rivals = rivals[~(before[rivals] == before[r]).any(1)]
            for c in rivals:
                if group[c] != group[r] and similarity(elements[r], weights[r], elements[c], weights[c]) >= threshold:
                    out.append((min(nodes[r], nodes[c]), max(nodes[r], nodes[c])))
                    group[group == group[c]] = group[r]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    placed = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    columns = ["band", "node", "label", "signature", "bands", "total", "alone", "elements", "weights", "own"]
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("other")
    spread = placed.select(*columns, other).select(*columns, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return spread.groupBy("band", "i", "j").applyInArrow(compare, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of near-duplicate documents: links are weighted Jaccard similarities of at least ``threshold``.

    Returns one row per document row: doc_id, class_id (the smallest id of its class) and
    kept (it has that id). Classes are the connected components of all links.

    Null and empty texts, and texts without words, are classes of their own. Equal multisets
    are always one class. Null ids never name a class unless it has no other; rows with equal
    ids and equal texts stay together. An empty table gives no rows. Bands are chosen for
    thresholds of 0.8 and more. A task holds the shingles of a whole document; other columns
    are not read, whatever their names.
    """
    rows = id_text(docs, id_col, text_col)
    signed = staged(_signed(rows, size), "signatures")
    nodes = signed.where("node IS NOT NULL")
    # Rows of one node have equal bands and signatures.
    distinct = staged(nodes.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("bands").alias("bands"), F.min("signature").alias("signature")), "nodes")
    filed = distinct.select(F.explode("bands").alias("band"), "node")
    buckets = staged(filed.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = staged(filed.join(buckets, "band"), "bucket-members")
    pairs = staged(members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    involved = members.select("node").distinct().join(distinct.select("node", "least"), "node")
    wanted = involved.select(F.col("least").alias("doc_id")).distinct()
    texts = rows.alias("r").join(wanted.alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")), "left_semi")
    sets = staged(_multisets(texts, size).groupBy("node").agg(F.min("elements").alias("elements"), F.min("weights").alias("weights"), F.min("total").alias("total")), "multisets")
    links = staged(_verified(pairs, sets, threshold), "links")
    labels = components(links)
    # Buckets that hold several components: compare across them.
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    open_ = staged(labelled.join(mixed, "band", "left_semi").select("band", "node", "label", F.expr(f"n div {BLOCK_NODES} + 1").alias("blocks")), "mixed-buckets")
    kept = sets.join(open_.select("node").distinct(), "node", "left_semi")
    # A node with too much that it shares with none has no link at all.
    bounds = _alone(kept).where((F.col("total") - F.col("alone")) >= (threshold - 1e-9) * F.col("total"))
    facts = distinct.select("node", "signature", "bands").join(bounds, "node").join(kept.drop("total"), "node")
    more = staged(_across(open_.join(facts, "node"), threshold), "links-across")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = distinct.select("node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = staged(classes.join(classes.groupBy("label").agg(F.min("least").alias("class_id")), "label").select("node", "class_id"), "classes")
    judged = signed.select("doc_id", "node").join(named, "node", "left").select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
