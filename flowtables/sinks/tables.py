"""Table writes: append, replace, replace a period, rewrite the partitions that change."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql import types as T

from flowtables.functions.dates import local_time, ntz
from flowtables.schemas import AUDIT_LOG, cast_text
from flowtables.session import remove_path, scratch_path, staged

_STAGING = "__staging"


@dataclass(frozen=True)
class LoadResult:
    """Outcome of one write."""

    name: str
    status: str
    rows: int
    message: str


def done(name: str, rows: int) -> LoadResult:
    return LoadResult(name, "SUCCESS", rows, f"SUCCESS: {name} ({rows} rows)")


def count_rows(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """Count the rows of ``df`` while it is written, instead of in a second pass."""
    seen = Observation()

    def rows() -> int:
        try:
            return int(seen.get["rows"])
        except Py4JJavaError:  # Spark saw beforehand that there are no rows and skipped the count
            return 0

    return df.observe(seen, F.count(F.lit(1)).alias("rows")), rows


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions present in the written rows."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_cols: Sequence[str] = ()) -> None:
    """Create the table if it is not there; add columns it lacks."""
    _recover(spark, name)
    if not spark.catalog.tableExists(name):
        writer = spark.createDataFrame([], schema).write.format("parquet")
        (writer.partitionBy(*partition_cols) if partition_cols else writer).saveAsTable(name)
        return
    have = {f.name.lower() for f in spark.table(name).schema}
    missing = [f for f in schema if f.name.lower() not in have]
    if missing:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")


def balanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Gather the rows of a partition into few files; a large partition is split, not one task."""
    return df.hint("rebalance", *[F.col(c) for c in partition_cols]) if partition_cols else df


def in_table_order(df: DataFrame, name: str) -> DataFrame:
    """Columns by name in the order of the table, cast to its types; absent ones are NULL."""
    have = {f.name.lower(): f.dataType for f in df.schema}

    def fitted(field: T.StructField) -> str:
        dtype = have.get(field.name.lower())
        name = f"`{field.name}`"
        return name if dtype == field.dataType else cast_text("NULL" if dtype is None else name, field)

    return df.selectExpr(*[fitted(f) for f in df.sparkSession.table(name).schema])


def append_table(df: DataFrame, name: str) -> LoadResult:
    """Append rows by column name."""
    counted, rows = count_rows(in_table_order(df, name))
    counted.write.insertInto(name)
    return done(name, rows())


def append_outbound(df: DataFrame, name: str, mapping: Mapping[str, str | Column]) -> LoadResult:
    """Append to another party's table; ``mapping`` gives its columns from ours."""
    renamed = df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])
    return append_table(renamed, name)


def replace_table(df: DataFrame, name: str, partition_cols: Sequence[str] | None = None) -> LoadResult:
    """Replace a table by the rows of ``df``, which may itself read the table.

    The rows are complete in a staging table before the old table goes.  A crash before the
    swap leaves the old table; a crash inside it leaves the staging table, which the next
    write of this table puts in place.  A partitioned table is replaced partition by
    partition in one commit, and partitions that got no rows are dropped after it.
    """
    spark = df.sparkSession
    _recover(spark, name)
    exists = spark.catalog.tableExists(name)
    if partition_cols is None:
        partition_cols = partition_columns(spark, name) if exists else ()
    if exists and partition_cols:
        return _replace_partitions(df, name, partition_cols)
    counted, rows = count_rows(df)
    writer = balanced(counted, partition_cols).write.format("parquet")
    if not exists:
        (writer.partitionBy(*partition_cols) if partition_cols else writer).saveAsTable(name)
        return done(name, rows())
    staging = name + _STAGING
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    writer.saveAsTable(staging)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    return done(name, rows())


def _replace_partitions(df: DataFrame, name: str, cols: Sequence[str]) -> LoadResult:
    """Replace the rows partition by partition; which partitions stay is read from the rows as they were staged."""
    spark = df.sparkSession
    path = scratch_path(spark, "replacement")
    try:
        rows = staged(in_table_order(df, name), path=path)
        with dynamic_overwrite(spark):
            balanced(rows, cols).write.mode("overwrite").insertInto(name)
        kept = {tuple(r) for r in touched_partitions(rows, cols)}
        for old in touched_partitions(spark.table(name), cols):
            if tuple(old) not in kept:
                spec = ", ".join(f"`{c}` = {_literal(old[c])}" for c in cols)
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        return done(name, rows.count())
    finally:
        remove_path(spark, path)


def _recover(spark: SparkSession, name: str) -> None:
    staging = name + _STAGING
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(staging):
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")


def rewrite_if_nonempty(df: DataFrame, name: str) -> LoadResult:
    """Replace the table unless the new rows are none, e.g. because a feed came empty."""
    if df.isEmpty():
        return LoadResult(name, "SKIPPED", 0, f"SKIPPED: {name} kept, the new set is empty")
    return replace_table(df, name)


def replace_period(df: DataFrame, name: str, period: Mapping[str, object]) -> LoadResult:
    """Replace one period of a table partitioned by the period columns.

    Rows of other periods in ``df`` are left out: they belong to the run of their own
    period.  The partition is named, so a period that became empty is emptied.
    """
    spark = df.sparkSession
    inside = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in period.items()])
    rows = in_table_order(df.filter(inside), name).drop(*period)
    counted, count = count_rows(rows)
    view = f"__period_rows_{uuid.uuid4().hex}"  # loads may run side by side
    counted.createOrReplaceTempView(view)
    spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in period.items())
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return done(name, count())


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    if isinstance(value, (date, datetime)):
        value = value.isoformat()
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def touched_partitions(df: DataFrame, partition_cols: Sequence[str]) -> list[Row]:
    """Distinct partition values of ``df``: no more than the table has partitions."""
    return df.select(*partition_cols).distinct().collect()


def only_partitions(df: DataFrame, rows: Sequence[Row], partition_cols: Sequence[str]) -> DataFrame:
    """Keep the listed partitions, by literals that prune the scan."""
    if not rows:
        return df.limit(0)
    if len(partition_cols) == 1:
        col = partition_cols[0]
        values = [r[col] for r in rows if r[col] is not None]
        keep = F.col(col).isin(*values) if values else F.lit(False)
        return df.filter(keep | F.col(col).isNull()) if len(values) < len(rows) else df.filter(keep)
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_cols]) for r in rows]
    return df.filter(reduce(lambda a, b: a | b, each))


def change_table(
    spark: SparkSession,
    name: str,
    touching: DataFrame,
    change: Callable[[DataFrame], DataFrame],
) -> LoadResult:
    """Apply ``change`` to the table, rewriting only the partitions that ``touching`` falls in.

    ``touching`` carries the partition columns of the rows that will change or come in.  An
    unpartitioned table is rewritten whole.  The change must not move rows between
    partitions nor empty one.
    """
    cols = partition_columns(spark, name)
    current = spark.table(name)
    if not cols:
        return replace_table(in_table_order(change(current), name), name)
    rows = touched_partitions(touching, cols)
    if not rows:
        return done(name, 0)
    new = in_table_order(change(only_partitions(current, rows, cols)), name)
    counted, count = count_rows(new)
    with dynamic_overwrite(spark):
        balanced(counted, cols).write.mode("overwrite").insertInto(name)
    return done(name, count())


def drain(spark: SparkSession, name: str) -> None:
    """Empty a landing table whose rows are safely stored elsewhere."""
    spark.sql(f"TRUNCATE TABLE {name}")


def audit(
    spark: SparkSession,
    table: str,
    task: str,
    message: str,
    status: str,
    as_of: datetime,
    files: str | None = None,
    zone: str = "Europe/London",
) -> LoadResult:
    """Append one log row. Messages carry counts and file names, never field values."""
    ensure_table(spark, table, AUDIT_LOG)
    row = spark.range(1).select(
        ntz(local_time(as_of, zone)).alias("LOG_TIMESTAMP"),
        F.lit(task).alias("TASK_NAME"),
        F.lit(message).alias("RETURN_MESSAGE"),
        F.lit(files).cast("string").alias("PROCESSED_FILES"),
        F.lit(status).alias("STATUS"),
    )
    return append_table(row, table)


def audited(
    spark: SparkSession,
    table: str,
    task: str,
    as_of: datetime,
    job: Callable[[], tuple[str, str | None]],
    label: str,
) -> str:
    """Run a job returning (message, files); log success, or log the failure and return it."""
    try:
        message, files = job()
        status = "SUCCESS"
    except Exception as error:  # the caller gets a text, never an exception
        message, files, status = f"{label} ERROR: {str(error)[:250]}", None, "FAILURE"
    audit(spark, table, task, message, status, as_of, files)
    return message


def kept_rows(df: DataFrame, stamp: str, days: int, as_of: date, task: str | None = None, task_col: str = "TASK_NAME") -> DataFrame:
    """Log rows young enough to keep; with ``task``, only rows of that task are removed."""
    cutoff = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=days)
    old = F.coalesce(F.col(stamp) < ntz(cutoff), F.lit(False))
    if task is not None:
        old = old & F.coalesce(F.col(task_col) == F.lit(task), F.lit(False))
    return df.filter(~old)


def prune(
    spark: SparkSession, name: str, stamp: str, days: int, as_of: date, task: str | None = None, task_col: str = "TASK_NAME"
) -> LoadResult:
    """Drop old log rows."""
    return replace_table(kept_rows(spark.table(name), stamp, days, as_of, task, task_col), name)


def create_view(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Projection of a table for report users."""
    view = df.select(*columns)
    view.createOrReplaceTempView(name)
    return view
