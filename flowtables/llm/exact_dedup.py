"""Exact deduplication of incoming batches against an immutable snapshot.

``build_snapshot`` writes, once, the distinct texts of a snapshot by digest in buckets (digest,
SHA-256, id that stays, number of rows) and one static binary-fuse filter for each bucket.
A batch is grouped by itself. Its distinct digests then go to the filters of their buckets: a
negative is certainly new and never meets the snapshot; positives join their exact bucket,
and count as repeats when the bytes of both texts are equal. Filters stay as they are for
any number of batches.

Texts move only for repeated or positive digests. They are grouped with map-side combining,
so a text that a third of all rows share is one row per task from then on; digests of such
texts are few by definition and are broadcast, so that their rows never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.llm import fuse
from flowtables.llm.common import id_text, staged
from flowtables.session import scratch_path

#: Distinct digests one filter may hold: 1 MB of filter and some 100 MB while it is built.
KEYS_PER_FILTER = 500_000
#: Digests of a batch that one task screens at once.
KEYS_PER_TASK = 1_000_000
#: A digest is hot only with more than this part of all rows, so that the hot digests, which
#: are broadcast, are never more than 100,000 rows of 16 bytes.
HOT_PART = 100_000
_ENTRY = "digest long, sha string, keep_id long, n long, bucket int"
_FILTER = "bucket int, filter binary"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, row_key, digest, sha) of every row, written: a 64-bit digest to screen with and SHA-256 to name the text."""
    row = F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()
    text = F.coalesce(F.col(text_col), F.lit(""))
    return staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row_key"), F.xxhash64(text).alias("digest"), F.sha2(text, 256).alias("sha")), "digests")


def _matched(rows: DataFrame, wanted: DataFrame, total: int) -> DataFrame:
    """``rows`` with a digest of ``wanted`` (digest, n: at least so many rows have it); hot digests don't shuffle the rows."""
    limit = max(1, total // HOT_PART)
    hot = F.broadcast(wanted.where(F.col("n") > limit).select("digest"))
    rest = wanted.where(F.col("n") <= limit).select("digest")
    return rows.join(hot, "digest", "left_semi").unionByName(rows.join(hot, "digest", "left_anti").join(rest, "digest", "left_semi"))


def _texts(docs: DataFrame, wanted: DataFrame, total: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct texts with a wanted digest: (digest, text, sha, keep_id, n). Grouping by the text compares bytes."""
    rows = id_text(docs, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    grouped = _matched(rows, wanted, total).groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    return grouped.withColumn("sha", F.sha2("text", 256))


def _classes(docs: DataFrame, keys: DataFrame, counts: DataFrame, total: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct texts of one side by themselves: (digest, sha, keep_id, n)."""
    repeated = counts.where("n > 1")
    single = keys.join(counts.where("n = 1").select("digest"), "digest", "left_semi").select("digest", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    return single.unionByName(_texts(docs, repeated, total, id_col, text_col).select("digest", "sha", "keep_id", "n"))


def _counts(keys: DataFrame, label: str) -> tuple[DataFrame, int]:
    counts = staged(keys.groupBy("digest").agg(F.count("*").alias("n")), label)
    return counts, counts.agg(F.sum("n")).first()[0] or 0


def build_snapshot(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keys: DataFrame | None = None) -> None:
    """Write the snapshot of ``docs`` under ``path``: its distinct texts in buckets, and their filters."""
    spark = docs.sparkSession
    keys = digests(docs, id_col, text_col) if keys is None else keys
    counts, total = _counts(keys, "snapshot-digests")
    buckets = max(1, -(-counts.count() // KEYS_PER_FILTER), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod("digest", F.lit(buckets)).cast("int")
    entries = _classes(docs, keys, counts, total, id_col, text_col).withColumn("bucket", bucket)
    entries.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/texts")

    def make(table: pa.Table) -> pa.Table:
        return pa.table({"bucket": table["bucket"][:1], "filter": pa.array([fuse.build(table["digest"].to_numpy().view(np.uint64))], pa.binary())})

    counts.select("digest", bucket.alias("bucket")).groupBy("bucket").applyInArrow(make, _FILTER).write.parquet(f"{path}/filters")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/size")


def _screen(spark: SparkSession, path: str, counts: DataFrame) -> DataFrame:
    """(digest, n, bucket) of the batch digests that may be in the snapshot; the others are certainly not."""
    buckets = spark.read.parquet(f"{path}/size").first()["buckets"]
    # A bucket's digests are dealt over as many tasks as they need; each has the bucket's filter.
    slices = max(1, -(-counts.count() // (buckets * KEYS_PER_TASK)))
    keys = counts.select("digest", "n", F.pmod("digest", F.lit(buckets)).cast("int").alias("bucket"), F.pmod(F.xxhash64("digest"), F.lit(slices)).cast("int").alias("slice"))
    filters = spark.read.schema(_FILTER).parquet(f"{path}/filters").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def test(table: pa.Table, of: pa.Table) -> pa.Table:
        data = of["filter"][0].as_py() if len(of) else b""
        return table.select(["digest", "n", "bucket"]).filter(pa.array(fuse.maybe(data, table["digest"].to_numpy().view(np.uint64))))

    return keys.groupBy("bucket", "slice").cogroup(filters.groupBy("bucket", "slice")).applyInArrow(test, "digest long, n long, bucket int")


def screen_batch(path: str, docs: DataFrame, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: DataFrame | None = None) -> DataFrame:
    """The distinct texts of a batch against the stored snapshot of ``docs``.

    Returns digest, sha, keep_id and n (within the batch), positive (passed the filter), and
    old_keep_id and old_n of the snapshot's equal text, null if it has none.
    """
    spark = batch.sparkSession
    keys = digests(batch, id_col, text_col) if keys is None else keys
    counts, total = _counts(keys, "batch-digests")
    positive = staged(_screen(spark, path, counts), "positives")
    entries = spark.read.schema(_ENTRY).parquet(f"{path}/texts")
    # Buckets are named by a column of folders: those without positives are not read.
    near = entries.join(F.broadcast(positive.select("bucket").distinct()), "bucket", "left_semi")
    old = staged(near.join(positive.select("digest"), "digest", "left_semi").select("digest", F.col("sha").alias("old_sha"), F.col("keep_id").alias("old_keep_id"), F.col("n").alias("old_n")), "bucket-hits")
    # False positives of the filter are found by their digests; the rest compare bytes.
    hit = positive.select("digest", "n").join(old.groupBy("digest").agg(F.sum("old_n").alias("old")), "digest").select("digest", F.greatest("n", "old").alias("n"))
    size = max(total, old.agg(F.sum("old_n")).first()[0] or 0)
    new_texts = _texts(batch, hit, size, id_col, text_col).select("digest", "text", F.col("sha").alias("new_sha"))
    old_texts = _texts(docs, hit, size, id_col, text_col).select("digest", "text")
    same = staged(new_texts.join(old_texts, ["digest", "text"]).select("digest", F.col("new_sha").alias("sha")), "equal-bytes")
    met = same.join(old, (same["sha"] == old["old_sha"]) & (same["digest"] == old["digest"])).select(same["digest"], "sha", "old_keep_id", "old_n")
    classes = _classes(batch, keys, counts, total, id_col, text_col)
    return classes.join(met, ["digest", "sha"], "left").join(positive.select("digest", F.lit(True).alias("positive")), "digest", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))


def _with_class(rows: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """``rows`` with the columns of their class by digest and sha; large classes, few by definition, are broadcast."""
    limit = max(1, total // HOT_PART)
    hot = F.broadcast(classes.where(F.col("group_size") > limit))
    rest = rows.join(hot, ["digest", "sha"], "left_anti").join(classes.where(F.col("group_size") <= limit), ["digest", "sha"], "left")
    return rows.join(hot, ["digest", "sha"]).select(*rest.columns).unionByName(rest)


def exact_dedup(snapshot: DataFrame, incoming: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, path: str | None = None) -> DataFrame:
    """Classes of equal texts over ``snapshot`` and ``incoming``; the row with the largest id of a class stays.

    Returns one row per input row: doc_id, row_key, keep_id, group_size (long), kept,
    text_sha256, incoming (true for rows of the batch) and screened (the filters passed the
    row on to the exact bucket; null for snapshot rows). ``row_col`` names a column of
    unique numbers over both inputs, which comes back as ``row_key``; without it rows are numbered.
    ``path`` is where the snapshot is written.

    A null text is an empty text. A null id never stays unless the whole class has none. One
    row of a class stays, also where several have its largest id: the one with the smallest
    row_key. Texts of any length are moved whole, and only repeated ones. Other columns are
    not read, whatever their names. Empty inputs give no rows.
    """
    spark = snapshot.sparkSession
    path = path or scratch_path(spark, "snapshot")
    old_keys, new_keys = (digests(side, id_col, text_col, row_col) for side in (snapshot, incoming))
    build_snapshot(snapshot, path, id_col, text_col, old_keys)
    new = staged(screen_batch(path, snapshot, incoming, id_col, text_col, new_keys), "batch-classes")
    old = spark.read.schema(_ENTRY).parquet(f"{path}/texts").select("digest", "sha", "keep_id", "n")
    both = old.join(new.where("old_n IS NOT NULL").select("digest", "sha", F.col("keep_id").alias("new_keep_id"), F.col("n").alias("new_n")), ["digest", "sha"], "left")
    merged = both.select("digest", "sha", F.greatest("keep_id", "new_keep_id").alias("keep_id"), (F.col("n") + F.coalesce("new_n", F.lit(0))).alias("group_size"), F.col("new_n").isNotNull().alias("positive"))
    fresh = new.where("old_n IS NULL").select("digest", "sha", "keep_id", F.col("n").alias("group_size"), "positive")
    # Classes of one row need no lookup: only the others, and false positives, are joined to rows.
    classes = staged(merged.unionByName(fresh).where("group_size > 1 OR positive"), "classes")
    shift = 1 << 62 if row_col is None else 0
    keys = old_keys.withColumn("incoming", F.lit(False)).unionByName(new_keys.withColumn("row_key", F.col("row_key") + F.lit(shift)).withColumn("incoming", F.lit(True)))
    total = keys.count()
    judged = _with_class(keys, classes, total).withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
    judged = judged.withColumn("candidate", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # Of the rows with the id that stays the first one; classes of one row are decided already.
    first = judged.where("candidate AND group_size > 1").groupBy("digest", "sha").agg(F.min("row_key").alias("row_key")).select("row_key", F.lit(True).alias("first"))
    out = judged.join(first, "row_key", "left")
    return out.select(
        "doc_id", "row_key", "keep_id", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.coalesce("group_size", F.lit(1)) > 1, F.coalesce("first", F.lit(False))).otherwise(F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"), "incoming", F.when(F.col("incoming"), F.coalesce("positive", F.lit(False))).alias("screened"),
    )


def halves(docs: DataFrame, id_col: str = "doc_id") -> Iterator[DataFrame]:
    """The table as an earlier snapshot and a later batch, cut at the (approximate) middle id."""
    middle = docs.select(F.percentile_approx(F.col(id_col), 0.5, 1000).alias("middle")).first()["middle"]
    later = F.coalesce(F.col(id_col) > F.lit(middle), F.lit(False))
    yield docs.where(~later)
    yield docs.where(later)
