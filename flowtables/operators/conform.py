"""Bringing several sources to one shape."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowtables.schemas import conform, pad_to

__all__ = ["conform", "pad_to", "conform_union", "append_by_name"]


def conform_union(branches: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """UNION ALL of the branches, each projected to ``schema`` with typed NULLs for gaps."""
    return reduce(DataFrame.unionByName, [pad_to(b, schema) for b in branches])


def append_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append rows by column name, whatever order the columns were built in."""
    return first.unionByName(second.select(*first.columns))
