"""Arriving files as a stream: each file is loaded exactly once.

The checkpoint is the file ledger.  ``availableNow`` takes what has arrived and ends, so
the same function serves an hourly call and, with another trigger, a running stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtables.operators.delta import hash_delta
from flowtables.session import remove_path, scratch_path, staged
from flowtables.sinks.tables import append_table, ensure_table
from flowtables.sources.files import landed_rows, parsed_records, rejected_lines, text_schema
from flowtables.sources.records import numbered, split_records


def lines_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of the lines of arriving files, each with its file and the place of its chunk."""
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"))


def _run(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@contextmanager
def _parsed(spark: SparkSession, lines: DataFrame, schema: T.StructType) -> Iterator[DataFrame]:
    """Records of a batch of lines, parsed once and written; gone afterwards."""
    paths = [scratch_path(spark, "arrived-lines"), scratch_path(spark, "arrived")]
    try:
        numbered(lines).write.parquet(paths[0])
        # The batch has a session of its own; from here on it is the caller's.
        read = spark.read.schema(numbered(lines).schema).parquet(paths[0])
        yield staged(parsed_records(split_records(read, len(schema)), schema), path=paths[1])
    finally:
        for path in paths:
            remove_path(spark, path)


def ingest_files_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    target: str,
    max_files: int | None = None,
    source: str = "csv",
) -> StreamingQuery:
    """Append arriving files to the folder ``target`` as parquet; returns when all are in.

    CSV files follow the landing rules; quoted fields may hold line breaks. A batch is parsed
    once. Its rows, and its records that don't fit the fields, are written to folders named by
    the number of the batch, here and under ``<target>_rejected``, so a batch that is tried
    again after a lost driver replaces what it left. ``read_landed`` reads them.
    """
    if source != "csv":
        reader = spark.readStream.format(source).schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        query = reader.load(folder).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def write(lines: DataFrame, number: int) -> None:
        with _parsed(spark, lines, schema) as rows:
            for part, path in ((rejected_lines(rows), f"{target}_rejected"), (landed_rows(rows), target)):
                part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _run(lines_stream(spark, folder, max_files), checkpoint, write)


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The rows under ``target``, or the rejected ones under ``<target>_rejected``."""
    return spark.read.parquet(target).drop("batch")


def for_new_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    work: Callable[[DataFrame, int], None],
    on_rejected: Callable[[int], None] = lambda lines: None,
) -> StreamingQuery:
    """Hand the rows of each batch of new files to ``work``; ``work`` must be idempotent.

    The batch is staged first: its files are parsed once however often ``work`` reads it,
    and ``work`` runs in the caller's session, whose table listings it keeps current.  Records
    that don't fit the fields are kept under ``<checkpoint>_rejected``, one folder per batch,
    and ``on_rejected`` gets their number; the other rows go on.
    """

    def parsed_work(lines: DataFrame, number: int) -> None:
        with _parsed(spark, lines, schema) as rows:
            bad = rejected_lines(rows)
            rejected = bad.count()
            if rejected:
                bad.write.mode("overwrite").parquet(f"{checkpoint}_rejected/batch={number}")
            on_rejected(rejected)
            work(landed_rows(rows), number)

    return _run(lines_stream(spark, folder), checkpoint, parsed_work)


def hash_delta_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    checkpoint: str,
    history: str,
    cols: Sequence[str],
) -> StreamingQuery:
    """Append to ``history`` the rows of arriving files whose fingerprint it lacks.

    A repeated batch finds its own fingerprints in the history and adds nothing.
    """
    ensure_table(spark, history, T.StructType([*text_schema(schema).fields, T.StructField("ROW_HASH", T.StringType())]))

    def work(batch: DataFrame, _: int) -> None:
        append_table(hash_delta(batch.filter(F.col(cols[0]) != ""), spark.table(history), cols), history)

    return for_new_files(spark, folder, schema, checkpoint, work)
