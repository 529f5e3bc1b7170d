"""What several operators need: input columns, staging, hashes and byte packing."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from flowtables.session import staged

__all__ = ["id_text", "staged", "mix64", "pack", "unpack", "partitions_for", "ranges"]

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as ``doc_id`` long) and the text (null: empty); other columns never get in the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(a: np.ndarray | bytes) -> bytes:
    """Compressed bytes of an array; little-endian like every machine Spark runs on."""
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def partitions_for(df: DataFrame) -> int:
    """Hash buckets of an exchange of packed arrays: as many as the session shuffles into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
