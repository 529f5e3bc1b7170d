"""Token files of directly addressable codes: any token can be read without decoding a block.

An id is split into chunks of 8 bits. Level 0 holds the lowest chunk of every id and one
continuation bit for each; level 1 the next chunk of the ids that go on, and so forth. The
chunk of position i on the next level is found by counting the continuation bits before i,
for which a rank directory holds the count before every 512 bits.

A file is a Parquet folder of segments in token order. Each segment is one binary value
(its image) with its documents: every document lies in one segment.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.llm.common import id_text, partitions_for
from flowtables.llm.packing import with_offsets
from flowtables.llm.tokens import loaded

#: Tokens of a segment; a longer document has a segment of its own.
SEGMENT = 1 << 19
_BLOCK = 64  # bytes of bitmap for each entry of the rank directory
_HEAD, _LEVEL = struct.Struct("<4sIQ"), struct.Struct("<Q")
_MAGIC = b"DAC1"
_FILE = "part int, segment int, n_tokens long, doc_ids array<long>, counts array<long>, image binary"
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """The image of an array of unsigned ids."""
    left = np.asarray(ids, np.uint64)
    levels = []
    while True:
        more = left > 255
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % _BLOCK))
        counts = _BITS[bitmap].reshape(-1, _BLOCK).sum(1, dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)]).astype("<u4")
        levels.append(_LEVEL.pack(len(left)) + (left & np.uint64(255)).astype(np.uint8).tobytes() + bitmap.tobytes() + rank.tobytes())
        left = left[more] >> np.uint64(8)
        if not len(left):
            return _HEAD.pack(_MAGIC, len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Random access to the ids of an image."""

    def __init__(self, image: bytes):
        magic, levels, self.n = _HEAD.unpack_from(image)
        if magic != _MAGIC:
            raise ValueError("not an image of directly addressable codes")
        self.levels, at = [], _HEAD.size
        for _ in range(levels):
            (n,) = _LEVEL.unpack_from(image, at)
            blocks = -(-(-(-n // 8)) // _BLOCK)
            at += _LEVEL.size
            chunks = np.frombuffer(image, np.uint8, n, at)
            bitmap = np.frombuffer(image, np.uint8, blocks * _BLOCK, at + n)
            rank = np.frombuffer(image, "<u4", blocks + 1, at + n + blocks * _BLOCK)
            self.levels.append((chunks, bitmap, rank))
            at += n + blocks * _BLOCK + 4 * (blocks + 1)

    @staticmethod
    def _rank(bitmap: np.ndarray, rank: np.ndarray, i: int) -> int:
        """Continuation bits before position i: one directory entry and at most one block of bits."""
        block, byte = i // (8 * _BLOCK), i // 8
        inside = int(_BITS[bitmap[block * _BLOCK : byte]].sum()) if byte > block * _BLOCK else 0
        rest = int(_BITS[bitmap[byte] & ((1 << i % 8) - 1)]) if i % 8 else 0
        return int(rank[block]) + inside + rest

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(bitmap, rank, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids of the positions [start, stop), which are neighbours on every level too."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for level, (chunks, bitmap, rank) in enumerate(self.levels):
            if start == stop:
                break
            out[where] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            bits = np.unpackbits(bitmap[start // 8 : stop // 8 + 1], bitorder="little")[start % 8 : start % 8 + stop - start]
            goes_on = np.flatnonzero(bits)
            where = where[goes_on]
            start = self._rank(bitmap, rank, start) if len(goes_on) else 0
            stop = start + len(goes_on)
        return out


def write_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, in ascending id order, as a token file at ``path``.

    The order is that of one range partitioning: the parts of the file hold ascending ranges.
    A null text is an empty one (its end id remains), null ids come first, and rows with equal
    ids are ordered by their text. An empty table gives a file without segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        part, segment = TaskContext.get().partitionId(), 0
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        docs_, counts, held = [], [], []

        def image() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([docs_], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([encode(ids)], pa.binary())], names=["part", "segment", "n_tokens", "doc_ids", "counts", "image"])

        for batch in batches:
            for doc, data in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"].to_pylist())):
                data += tail
                if held and sum(counts) + len(data) // 4 > SEGMENT:
                    yield image()
                    segment += 1
                    docs_, counts, held = [], [], []
                docs_.append(doc)
                counts.append(len(data) // 4)
                held.append(data)
        if docs_:
            yield image()

    rows = id_text(docs, id_col, text_col).repartitionByRange(partitions_for(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, _FILE).write.option("compression", "zstd").parquet(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a token file: (doc_id, start, n_tokens, ids), read through the codes.

    ``start`` counts the tokens of all documents before; ids are little-endian unsigned 32-bit.
    """
    file = spark.read.schema(_FILE).parquet(path)
    bases = with_offsets(file.select(F.expr("cast(part as long) * 4294967296 + segment").alias("part"), "n_tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, docs_, counts, image in zip(*(batch[c].to_pylist() for c in ("base", "doc_ids", "counts", "image"))):
                codes, ends = Codes(image), np.cumsum(counts)
                ids = [codes.slice(int(e) - c, int(e)).astype("<u4").tobytes() for e, c in zip(ends, counts)]
                yield pa.record_batch([pa.array(docs_, pa.int64()), pa.array(ends - counts + base, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    keyed = file.withColumn("part", F.expr("cast(part as long) * 4294967296 + segment"))
    return keyed.join(F.broadcast(bases), "part").select("base", "doc_ids", "counts", "image").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The token at a position of the whole file; only its segment is read."""
    file = spark.read.schema(_FILE).parquet(path).where("n_tokens > 0").withColumn("part", F.expr("cast(part as long) * 4294967296 + segment"))
    segment = with_offsets(file.select("part", "n_tokens")).where(F.col("base") <= position).orderBy(F.desc("base"), F.desc("part")).first()
    return Codes(file.where(F.col("part") == segment["part"]).first()["image"])[position - segment["base"]]
