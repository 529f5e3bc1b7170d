"""Concatenate and cut: documents as one stream of tokens, cut into sequences of equal length.

Pass one writes each document's ids together with its place in the stream of its partition.
The totals of the partitions, one row each, are summed up to global offsets. Pass two cuts
every document at the multiples of the sequence length: a document that crosses one leaves a
boundary piece on either side. No row is moved; the only exchange is that of the totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowtables.llm.common import id_text
from flowtables.llm.tokens import loaded
from flowtables.session import scratch_path

_TOKENS = "doc_id long, part int, local long, n_tokens long, ids binary"


def tokenized(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass one: ids of each document (2 or 4 bytes each) and its place within its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        part, at = TaskContext.get().partitionId(), 0
        narrow = encoder.size <= 1 << 16
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, local, counts = [], [], []
            for data in encoder.encode(batch["text"].to_pylist()):
                data += tail
                local.append(at)
                counts.append(len(data) // 4)
                at += counts[-1]
                ids.append(np.frombuffer(data, "<u4").astype("<u2").tobytes() if narrow else data)
            yield pa.record_batch([batch["doc_id"], pa.array([part] * len(ids), pa.int32()), pa.array(local, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "part", "local", "n_tokens", "ids"])

    path = scratch_path(docs.sparkSession, "tokens")
    id_text(docs, id_col, text_col).mapInArrow(run, _TOKENS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_TOKENS).parquet(path)


def with_offsets(parts: DataFrame) -> DataFrame:
    """Global offset of each partition: (part, base). One row per partition is all that is sorted here."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.groupBy("part").agg(F.sum("n_tokens").alias("total")).select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens; only the last sequence is not full.

    Returns one row per piece: doc_id, start (tokens of its document before it), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (in its sequence) and
    boundary (the document goes on in another sequence). Each id lies in exactly one piece.

    A null text is an empty one, of which the end id remains; without an end id an empty text
    has no piece. Null and repeated ids are packed like any other row. The order of documents
    is that of the input's partitions. An empty table gives no rows.
    """
    tokens = tokenized(docs, tokenizer, end_id, id_col, text_col)
    placed = tokens.join(F.broadcast(with_offsets(tokens)), "part").select("doc_id", (F.col("base") + F.col("local")).alias("at"), "n_tokens", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, at, n, data in zip(*(batch[c].to_pylist() for c in ("doc_id", "at", "n_tokens", "ids"))):
                ids = np.frombuffer(data, "<u2").astype("<u4").tobytes() if n and len(data) == 2 * n else data
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    out.append((doc, start, size, ids[4 * start : 4 * (start + size)], n, sequence, offset, size < n))
                    start += size
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, boundary boolean")


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("boundary", pa.bool_())])
