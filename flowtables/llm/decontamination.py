"""Benchmark decontamination over a distributed positional inverted index.

The index is a table of document segments (about a million words each). A segment holds,
for every term in it, the ascending positions of the term. A search goes through every
segment with blocks of queries: a phrase starts from the rarest of its terms in the segment,
shifts that term's positions to where the phrase would begin, and intersects them with the
shifted lists of the other terms, again from the rarest. A term that is in no list ends it.

No posting is shuffled: an index partitioned by document answers a phrase where the
document is. What leaves a segment are its matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import id_text, pack, unpack
from flowtables.session import scratch_path

#: Words of a segment; a longer document has a segment of its own.
SEGMENT_WORDS = 1_000_000
#: Words of one block of queries.
BLOCK_WORDS = 1_000_000
#: Largest query set, in bytes of text, that is broadcast to the segments.
BROADCAST_BYTES = 32 << 20

# Lower-cases A-Z; every other ASCII character that is no digit or small letter becomes a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_INDEX = "segment long, doc_ids array<long>, n_words array<long>, terms binary, counts binary, postings binary"


def words(text: str | None) -> list[bytes]:
    """Lower-case words of digits, letters and all characters beyond ASCII, as UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the positional index of all documents and return it, one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), count()

        def segment(ids: list, lists: list[list[bytes]]) -> pa.RecordBatch:
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            of = np.array([numbers[w] for ws in lists for w in ws], np.int32)
            sizes = np.array([len(ws) for ws in lists], np.int64)
            # One free position after each document keeps its neighbours apart.
            positions = (np.arange(len(of)) + np.repeat(np.arange(len(lists)), sizes)).astype(np.uint32)
            order = np.argsort(of, kind="stable")
            counts = np.bincount(of, minlength=len(numbers)).astype("<u4")
            listed = positions[order]
            gaps = np.diff(listed, prepend=np.uint32(0))
            heads = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)[:-1]]) if len(counts) else np.zeros(0, np.int64)
            gaps[heads] = listed[heads]
            row = [[part << 32 | next(n)], [ids], [sizes.tolist()], [pack(b" ".join(numbers))], [pack(counts)], [pack(gaps.astype("<u4"))]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names=["segment", "doc_ids", "n_words", "terms", "counts", "postings"])

        ids, lists, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                found = words(text.as_py())
                if ids and size + len(found) > SEGMENT_WORDS:
                    yield segment(ids, lists)
                    ids, lists, size = [], [], 0
                ids.append(doc)
                lists.append(found)
                size += len(found)
        if ids:
            yield segment(ids, lists)

    path = scratch_path(docs.sparkSession, "positional-index")
    id_text(docs, id_col, text_col).mapInArrow(run, _INDEX).write.parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


class Postings:
    """The lists of one segment."""

    def __init__(self, row: dict):
        terms = unpack_bytes(row["terms"]).split()
        self.number = dict(zip(terms, range(len(terms))))
        self.counts = unpack(row["counts"], "<u4").astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.gaps = unpack(row["postings"], "<u4")
        self.sizes = np.array(row["n_words"], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.kept: dict[int, np.ndarray] = {}

    def positions(self, term: int) -> np.ndarray:
        if term not in self.kept:
            end = int(self.ends[term])
            self.kept[term] = np.cumsum(self.gaps[end - int(self.counts[term]) : end], dtype=np.int64)
        return self.kept[term]

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1

    def phrase(self, terms: list[int]) -> np.ndarray:
        """Positions where the terms follow each other."""
        rarest = sorted(range(len(terms)), key=lambda k: self.counts[terms[k]])
        at = self.positions(terms[rarest[0]]) - rarest[0]
        at = at[at >= 0]
        for k in rarest[1:]:
            if not len(at):
                break
            other = self.positions(terms[k])
            place = np.searchsorted(other, at + k)
            place[place == len(other)] = 0
            at = at[other[place] == at + k]
        return at  # a phrase can't reach over the free position between documents

    def together(self, terms: list[int], within: int) -> tuple[np.ndarray, np.ndarray]:
        """Shortest spans [start, end] of at most ``within`` words that hold all distinct terms, one per start."""
        terms = sorted(set(terms), key=lambda t: self.counts[t])
        first = self.positions(terms[0])
        starts = np.unique(np.concatenate([self.positions(t) for t in terms]))
        near = np.searchsorted(first, starts)
        starts = starts[(near < len(first)) & (first[np.minimum(near, len(first) - 1)] < starts + within)]
        ends = starts.copy()
        for t in terms:
            other = self.positions(t)
            place = np.searchsorted(other, starts)
            ends = np.maximum(ends, np.where(place < len(other), other[np.minimum(place, len(other) - 1)], starts + within))
        good = (ends < starts + within) & (self.documents(starts) == self.documents(ends))
        return starts[good], ends[good]


def unpack_bytes(data: bytes) -> bytes:
    return unpack(data, np.uint8).tobytes()


def _search(index: DataFrame, queries: DataFrame, id_col: str, text_col: str, find: Callable[[Postings, list[int | None]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Run ``find`` for every query in every segment; merge what it finds by document and block."""
    items = queries.select(F.col(id_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("query"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("query") + 16), F.lit(0)).alias("bytes")).first()["bytes"]
    blocks = max(1, -(-size // (6 * BLOCK_WORDS)))
    grouped = items.groupBy(F.pmod(F.xxhash64("item", "query"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("item", "query")).alias("queries"))
    if size <= BROADCAST_BYTES:
        grouped = F.broadcast(grouped)
    work = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(grouped, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch[c][i].as_py() for c in ("segment", "doc_ids", "n_words", "terms", "counts", "postings", "queries")}
                postings = Postings(row)
                found: dict[int, list] = defaultdict(list)
                for q in row["queries"]:
                    starts, ends = find(postings, [postings.number.get(w) for w in words(q["query"])])
                    for doc, a, b in zip(postings.documents(starts).tolist(), starts.tolist(), ends.tolist()):
                        found[doc].append((q["item"], a, b))
                if not found:
                    continue
                out = []
                for doc, hits in found.items():
                    origin = int(postings.starts[doc])
                    out.append((row["segment"], doc, [a - origin for _, a, _ in hits], [b - origin for _, _, b in hits], [item for item, _, _ in hits]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _FOUND)], names=["segment", "ordinal", "starts", "ends", "items"])

    return work.select("segment", "doc_ids", "n_words", "terms", "counts", "postings", "queries").mapInArrow(run, "segment long, ordinal long, starts array<long>, ends array<long>, items array<string>")


_FOUND = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]


def _merged(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of words covered by phrases of one length: first and last position."""
    starts = np.unique(starts)
    new = np.flatnonzero(np.diff(starts, prepend=-length - 1) > length)
    return starts[new], np.append(starts[new[1:] - 1], starts[-1:]) + length - 1


def phrase_matches(index: DataFrame, queries: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Exact matches of every window of ``window`` consecutive words of a query.

    A query of fewer words, but not none, is one window. Returns one row per document and
    block of queries with matches: segment, ordinal (of the document in it), and for each
    maximal matched run of a query its first word, last word and query in the arrays starts,
    ends and items.
    """

    def find(postings: Postings, terms: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        length = min(window, len(terms))
        missing = -1  # the last term so far that the segment doesn't have
        starts = []
        for i, t in enumerate(terms):
            if t is None:
                missing = i
            if length and i + 1 - length > missing:
                at = postings.phrase(terms[i + 1 - length : i + 1])
                if len(at):
                    starts.append(at)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _merged(np.concatenate(starts), length)

    return _search(index, queries, id_col, text_col, find)


def proximity_matches(index: DataFrame, queries: DataFrame, within: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Spans of at most ``within`` words that hold all words of a query in any order.

    The result has the form of ``phrase_matches``; a query without words matches nothing.
    """

    def find(postings: Postings, terms: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        if not terms or None in terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return postings.together(terms, within)

    return _search(index, queries, id_col, text_col, find)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Words of every document that lie within an occurrence of a benchmark window.

    Returns one row per document row: doc_id, n_words, n_hit, items (sorted strings, those
    with occurring windows) and contaminated. Null and empty texts have no words and aren't
    contaminated; rows with equal or null ids are judged each by itself; an empty benchmark
    contaminates nothing. Repeated items count once per id; null item ids never show in items.
    """
    index = build_index(docs, id_col, text_col)
    found = phrase_matches(index, benchmark, window, item_col, item_text)
    # At most one row per document and block of queries; runs are united in order of their start.
    runs = F.array_sort(F.arrays_zip(F.flatten(F.collect_list("starts")).alias("a"), F.flatten(F.collect_list("ends")).alias("b")))
    covered = F.aggregate(
        "runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("last")),
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(s["last"], x["a"] - 1))).alias("n"), F.greatest(s["last"], x["b"]).alias("last")),
        lambda s: s["n"],
    )
    hits = found.groupBy("segment", "ordinal").agg(runs.alias("runs"), F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.collect_list("items"))))).alias("items")).select("segment", "ordinal", covered.alias("n_hit"), "items")
    every = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "doc")).select("segment", F.col("ordinal").cast("long").alias("ordinal"), F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").alias("n_words"))
    return every.join(hits, ["segment", "ordinal"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
