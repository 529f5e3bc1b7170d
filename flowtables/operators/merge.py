"""Upserts and updates as new snapshots.

Each function returns the whole new target.  Writing it, and limiting the rewrite to the
partitions that change, is the business of ``sinks.tables``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.dates import ntz
from flowtables.operators.joins import BROADCAST_BYTES, anti_join, fits_broadcast, join_unique, no_null, salted_join

_HIT = "__hit"


class DuplicateSourceKey(ValueError):
    """Two source rows of a merge share one key."""


def _keyed(df: DataFrame, keys: Sequence[str], blank_null: Sequence[str]) -> tuple[DataFrame, list[str]]:
    names = []
    for i, key in enumerate(keys):
        name = f"__mk{i}"
        df = df.withColumn(name, F.coalesce(F.col(key), F.lit("")) if key in blank_null else F.col(key))
        names.append(name)
    return df, names


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Stop when two rows share a key without NULLs; one grouped count, no rows collected."""
    repeated = df.filter(no_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise DuplicateSourceKey(f"source rows repeat a key of {list(keys)}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_cols: Sequence[str] | None = None,
    blank_null: Sequence[str] = (),
    check: bool = True,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Update ``update_cols`` of matching rows and insert the source rows that match none.

    Keys in ``blank_null`` treat NULL as the empty string; any other NULL never matches.
    A small source is broadcast, so the target is scanned but not shuffled; a large one is
    joined with salted keys.  The source is read more than once: stage it first when it is
    the result of more than a scan.
    """
    insert_cols = list(insert_cols if insert_cols is not None else [c for c in target.columns if c in source.columns])
    source_k, names = _keyed(source, keys, blank_null)
    target_k, _ = _keyed(target, keys, blank_null)
    if check:
        assert_unique(source_k, names)
    small = fits_broadcast(source_k.select(*names, *update_cols), limit)

    changes = source_k.filter(no_null(names)).select(
        *names, *[F.col(c).alias(f"__new_{c}") for c in update_cols], F.lit(True).alias(_HIT)
    )
    if small:
        joined = target_k.join(F.broadcast(changes), names, "left")
    else:
        joined = salted_join(target_k, changes, names, "left")
    dtypes = {f.name: f.dataType for f in target.schema}
    updated = joined.select(
        *[
            F.when(F.col(_HIT), F.col(f"__new_{c}").cast(dtypes[c])).otherwise(F.col(c)).alias(c)
            if c in update_cols
            else F.col(c)
            for c in target.columns
        ]
    )

    inserts = anti_join(source_k, target_k, names, small=small).select(
        *[
            (F.col(c) if c in insert_cols else F.lit(None)).cast(dtypes[c]).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(inserts)


def merge_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Insert-only merge: the distinct source rows whose key the target lacks, appended."""
    return target.unionByName(missing_rows(target, source, keys, limit), allowMissingColumns=True)


def missing_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Distinct source rows whose key is not in the target; what an insert-only merge appends."""
    small = fits_broadcast(source.select(*keys), limit)
    return anti_join(source.distinct(), target, keys, small=small).select(*source.columns)


def update_from(
    target: DataFrame,
    source: DataFrame,
    key: str,
    set_cols: Sequence[str],
    where: Column | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Set ``set_cols`` from the source row of the same key where ``where`` holds.

    Several source rows for one key would make the result arbitrary, so each column takes
    its smallest value; a NULL source value leaves the target as it is.
    """
    chosen = source.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(f"__new_{c}") for c in set_cols])
    joined = join_unique(target, chosen, [key], limit=limit, size_of=source.select(key, *set_cols))
    where = F.lit(True) if where is None else where
    return joined.select(
        *[
            F.when(where & F.col(f"__new_{c}").isNotNull(), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in set_cols
            else F.col(c)
            for c in target.columns
        ]
    )


def mark_sent(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    stamp: datetime,
    stamp_col: str = "SENT_TIMESTAMP",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Stamp exactly the unsent rows whose key is in the exported batch.

    NULL keys compare as equal here: a row that was sent has to be stamped.
    """
    # A NULL key becomes a pair (is null, blank), which compares as equal.
    def safe(df: DataFrame) -> DataFrame:
        parts = []
        for i, key in enumerate(keys):
            parts += [F.col(key).isNull().alias(f"__n{i}"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias(f"__k{i}")]
        return df.select("*", *parts)

    names = [f"__{kind}{i}" for i in range(len(keys)) for kind in "nk"]
    sent = safe(batch.select(*keys)).select(*names)
    hits = sent.distinct().withColumn(_HIT, F.lit(True))
    joined = join_unique(safe(target), hits, names, limit=limit, size_of=sent)
    due = F.col(_HIT) & F.col(stamp_col).isNull()
    return joined.withColumn(stamp_col, F.when(due, ntz(stamp)).otherwise(F.col(stamp_col))).select(*target.columns)


def mark_where(target: DataFrame, condition: Column, stamp: datetime, stamp_col: str = "SENT_TIMESTAMP") -> DataFrame:
    """Stamp the unsent rows that satisfy ``condition``; needs no join."""
    due = condition & F.col(stamp_col).isNull()
    return target.withColumn(stamp_col, F.when(due, ntz(stamp)).otherwise(F.col(stamp_col))).select(*target.columns)


def resend(
    target: DataFrame,
    system: str,
    stamp: datetime,
    system_col: str = "ROSTER_SYSTEM",
    stamp_col: str = "SENT_TIMESTAMP",
) -> DataFrame:
    """Clear the stamp of one batch so that it is sent again."""
    batch = (F.col(system_col) == F.lit(system)) & (F.col(stamp_col) == ntz(stamp))
    cleared = F.when(batch, F.lit(None)).otherwise(F.col(stamp_col))
    return target.withColumn(stamp_col, cleared.cast("timestamp_ntz")).select(*target.columns)
