"""Shared and periodic tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from flowtables.functions.dates import period_key
from flowtables.sinks.tables import LoadResult, count_rows, replace_table

HIDDEN_MARKS = ("HISTORY", "TEMP")


def shared_table(spark: SparkSession, name: str) -> DataFrame:
    """Another party's table, named by configuration."""
    return spark.table(name)


def snapshot_table(spark: SparkSession, source: str, target: str) -> LoadResult:
    """Copy a table into our layer."""
    return replace_table(spark.table(source), target)


def load_once(spark: SparkSession, target: str, loader: Callable[[], LoadResult]) -> LoadResult:
    """Run ``loader`` unless ``target`` is there already: a loaded period never changes."""
    if spark.catalog.tableExists(target):
        return LoadResult(target, "SKIPPED", 0, f"SKIPPED: {target} already exists")
    return loader()


def snapshot_period(spark: SparkSession, source_prefix: str, target_prefix: str, as_of: date, padded: bool = False) -> LoadResult:
    """Copy last month's shared table, once."""
    key = period_key(as_of, padded)
    target = f"{target_prefix}{key}"
    return load_once(spark, target, lambda: snapshot_table(spark, f"{source_prefix}{key}", target))


def period_tables(spark: SparkSession, prefix: str, exclude: Iterable[str] = HIDDEN_MARKS) -> list[str]:
    """Names of the catalog tables that start with ``prefix``, in order.

    The prefix is compared as text: its underscores are not wildcards.
    """
    marks = [m.upper() for m in exclude]
    database, _, stem = prefix.rpartition(".")
    tables = spark.catalog.listTables(database or None)
    names = [t.name for t in tables if not t.isTemporary and t.tableType != "VIEW"]
    kept = sorted(n for n in names if n.upper().startswith(stem.upper()) and not any(m in n.upper() for m in marks))
    return [f"{database}.{n}" if database else n for n in kept]


def union_periods(
    spark: SparkSession,
    prefix: str,
    view: str | None = None,
    exclude: Iterable[str] = HIDDEN_MARKS,
) -> DataFrame:
    """UNION ALL of every period table of a dataset, also registered as ``view``."""
    names = period_tables(spark, prefix, exclude)
    if not names:
        raise ValueError(f"no table starts with {prefix}")
    union = reduce(DataFrame.unionByName, [spark.table(n) for n in names])
    if view:
        union.createOrReplaceTempView(view)
    return union


def load_all(loaders: Mapping[str, Callable[[], LoadResult]]) -> list[LoadResult]:
    """Run independent loads one after the other; each is itself a parallel Spark job."""
    return [load() for load in loaders.values()]


def status_line(results: Iterable[LoadResult]) -> str:
    return " | ".join(r.message for r in results)


__all__ = [
    "LoadResult", "count_rows", "load_all", "load_once", "period_tables", "shared_table",
    "snapshot_period", "snapshot_table", "status_line", "union_periods",
]
