"""Registry of queries and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_database(spark: SparkSession, label: str) -> str:
    """A database of its own under the workspace for a query that writes tables."""
    name = f"ft_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")
    return name


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def money(col):
    """Currency from a double column; exact from here on."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def number(col, name: str):
    """Result column as a double, so that both engines report the same type."""
    return (F.col(col) if isinstance(col, str) else col).cast("double").alias(name)
