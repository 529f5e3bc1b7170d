"""Keep-latest and movement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from flowtables.functions.text import row_hash

_RANK = "__rank"
_HASH = "__hash"
_UNORDERED = (T.MapType, T.VariantType)


def latest_first(col: Column | str) -> Column:
    """Descending with NULL first, the order the source system's ``DESC`` means."""
    return (F.col(col) if isinstance(col, str) else col).desc_nulls_first()


def _key_names(df: DataFrame, keys: Sequence[str | Column]) -> tuple[DataFrame, list[str]]:
    """Give expression keys a temporary column name, so they can also be grouping keys."""
    names = []
    for i, key in enumerate(keys):
        if isinstance(key, str):
            names.append(key)
        else:
            name = f"__key{i}"
            df = df.withColumn(name, key)
            names.append(name)
    return df, names


def keep_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    tiebreak: Sequence[str] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per key: the first by ``order``, then by the remaining columns.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle, so a key holding a third of all rows sends one row per task.  The trailing
    columns make the choice total: rows that still tie are equal in every column.  Several
    keys are led by their hash, which decides nearly every comparison of the sort.  With
    ``keep_null_keys`` a NULL key equals no other key, so such rows stay unless they are
    copies of one another.
    """
    columns = df.columns
    if keep_null_keys:
        any_null = reduce(lambda a, b: a | b, [(F.col(k) if isinstance(k, str) else k).isNull() for k in keys])
        keys = [*keys, F.when(any_null, row_hash(columns)).otherwise(F.lit(""))]
    work, names = _key_names(df, keys)
    if tiebreak is None:
        orderable = {f.name for f in df.schema if not isinstance(f.dataType, _UNORDERED)}
        tiebreak = [c for c in columns if c not in names and c in orderable]
    if len(names) > 1:
        work = work.withColumn(_HASH, F.xxhash64(*names))
        names = [_HASH, *names]
    ordering = [*order, *[F.col(c).asc_nulls_last() for c in tiebreak]]
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*ordering))
    return work.withColumn(_RANK, rank).filter(F.col(_RANK) == 1).select(*columns)


def keep_latest_per_month(
    df: DataFrame,
    keys: Sequence[str],
    stamp: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key and calendar month of ``stamp``."""
    return keep_latest(df, [*keys, F.trunc(F.col(stamp), "MM")], [latest_first(stamp)], tiebreak)


def movement(df: DataFrame, keys: Sequence[str], period: str, value: str, out: str) -> DataFrame:
    """Change of ``value`` against the previous period of the key; the first is the whole value.

    Expects one row per key and period (see ``keep_latest_per_month``), so that the window
    of a key never holds more rows than there are periods.
    """
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(F.col(period).asc_nulls_last()))
    return df.withColumn(out, F.col(value) - F.coalesce(previous, F.lit(0).cast(df.schema[value].dataType)))
