"""The corpus pipeline: toxic documents, copies, near copies and benchmark passages go, the rest is packed.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and
calls one operator of ``flowtables.llm``. All but the last return the columns of documents.
A stage that decides about single rows numbers them first, so that rows which share an id, or
have none, are judged each by itself, and a row that was delivered twice stays once. Rows of
Parquet files, which the stages hand on, are numbered by their places there; any others are
written with their numbers. Of what a stage works with, only the numbers it decided on, the list
of the files and such written rows outlive it. Empty inputs give empty outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flowtables.llm import decontamination, exact_dedup, near_dedup, packing, queries, toxicity
from flowtables.session import remove_path, scratch_path, scratch_scope, shuffles_removed, staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _places(docs: DataFrame) -> DataFrame | None:
    """(file, n, before): rows of every file of ``docs`` and of those before it by name; None if it isn't just rows of files as they lie there."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None  # more than a scan
    try:
        place = docs.metadataColumn("_metadata")
        rows = docs.select(place.getField("file_path").alias("file"), place.getField("row_index").alias("row"))
    except AnalysisException:
        return None  # no files, or of a kind whose rows have no numbers
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    counts = rows.groupBy("file").agg(F.count("*").alias("n"), F.max("row").alias("last"))
    files = staged(counts.select("file", "n", "last", F.coalesce(before, F.lit(0)).alias("before")), "pipeline-files")
    # A file that was named twice has two rows in each place.
    return files.select("file", "n", "before") if files.where("n <> last + 1").isEmpty() else None


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a unique number in a column of its own, the same whenever they are read; and the column's name.

    The number of a row of a file is how many come before it, there and in the files before. Rows
    that don't just lie in files are written, so that numbers stay.
    """
    name = "row_key"
    while name in docs.columns:
        name += "_"
    files = _places(docs)
    if files is None:
        return staged(docs.withColumn(name, F.monotonically_increasing_id()), "pipeline-rows"), name
    place = docs.metadataColumn("_metadata")
    placed = docs.select(F.struct("*").alias("doc"), place.getField("file_path").alias("file"), place.getField("row_index").alias("row"))
    numbered = placed.join(F.broadcast(files.select("file", "before")), "file")
    return numbered.select("doc.*", (F.col("before") + F.col("row")).alias(name)), name


def _without(rows: DataFrame, key: str, decide: Callable[[], DataFrame]) -> DataFrame:
    """The rows whose number ``decide`` doesn't give (row_number), as they came.

    The numbers are written, so that Spark knows how few they are, and what the operator
    staged and shuffled to find them is removed.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "pipeline-numbers")
    with scratch_scope(spark), shuffles_removed(spark):
        numbers = staged(decide(), path=path)
    return rows.join(numbers.select(F.col("row_number").alias(key)), key, "left_anti").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression, fitted on their labels, doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the largest id."""
    rows, key = _numbered(docs)

    def copies() -> DataFrame:
        snapshot, incoming = exact_dedup.halves(rows)
        judged = exact_dedup.exact_dedup(snapshot, incoming, row_col=key)
        return judged.where("NOT kept").select(F.col("row_key").alias("row_number"))

    return _without(rows, key, copies).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, one with the smallest id (null last)."""
    rows, key = _numbered(docs)

    def copies() -> DataFrame:
        judged = near_dedup.near_duplicates(rows, threshold=0.8, size=5, id_col=key)
        ids = rows.select(F.col(key).alias("row_number"), F.col("doc_id").cast("long").alias("row_id"))
        classes = staged(judged.select(F.col("doc_id").alias("row_number"), "class_id").join(ids, "row_number"), "pipeline-classes")
        first = classes.groupBy("class_id").agg(F.min(F.struct(F.col("row_id").isNull().alias("no_id"), "row_id", "row_number")).alias("first"))
        return classes.select("row_number").join(first.select("first.row_number"), "row_number", "left_anti")

    return _without(rows, key, copies).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    rows, key = _numbered(docs)

    def leaks() -> DataFrame:
        judged = decontamination.decontaminate(rows, _table(spark, sf_dir, "benchmark"), window=10, id_col=key)
        return judged.where("contaminated").select(F.col("doc_id").alias("row_number"))

    return _without(rows, key, leaks).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    pieces = packing.pack(docs, queries.tokenizer(), length=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontamination", drop_contaminated), ("packing", pack)]

#: A fitted model and MinHash classes have no SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written, read back by the next, and then removed."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
