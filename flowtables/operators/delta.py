"""Finding what is new: by watermark, by tracking table, by row hash, by file ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.dates import ntz
from flowtables.functions.text import ColumnLike, row_hash
from flowtables.operators.joins import join_unique, lookup_by_key, new_rows
from flowtables.operators.windows import keep_latest, latest_first

BEGINNING = datetime(1900, 1, 1)


def high_watermark(df: DataFrame, stamp: str, default: datetime = BEGINNING) -> datetime:
    """Largest stamp already loaded; one value, so it may come to the driver."""
    return df.agg(F.max(stamp)).first()[0] or default


def after_watermark(
    df: DataFrame,
    stamp: str,
    watermark: datetime,
    loaded: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows beyond the watermark, which is a literal and so reaches the scan.

    With ``loaded`` and ``keys``, rows sharing the watermark instant are taken as well
    unless they are loaded already: a late row at the maximum is not lost.  Keys compare with
    NULL equal to NULL, so a row without a key is taken once and not again in every run.
    """
    if loaded is None:
        return df.filter(F.col(stamp) > ntz(watermark))
    at_mark = loaded.filter(F.col(stamp) == ntz(watermark))
    fresh, names = _null_safe(df.filter(F.col(stamp) >= ntz(watermark)), [*keys, stamp])
    known, _ = _null_safe(at_mark, [*keys, stamp])
    return new_rows(fresh, known, names).select(*df.columns)


def _null_safe(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Key columns without NULL: for each key its text, and whether it is missing."""
    added = {}
    for i, key in enumerate(keys):
        added[f"__key{i}"], added[f"__gap{i}"] = F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(key).isNull()
    return df.withColumns(added), list(added)


def tracked_delta(
    df: DataFrame,
    tracking: DataFrame,
    stamp: Column,
    out: str,
    loaded: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows after the last successful run of a tracking table; unparsable stamps are left out."""
    watermark = high_watermark(tracking.filter(F.col("STATUS") == "SUCCESS"), "MAX_DATE")
    parsed = df.withColumn(out, stamp).filter(F.col(out).isNotNull())
    return after_watermark(parsed, out, watermark, loaded, keys)


def hash_delta(
    source: DataFrame,
    history: DataFrame,
    cols: Sequence[ColumnLike],
    hash_col: str = "ROW_HASH",
    key: str | None = None,
    recency: str | None = None,
    **join_options,
) -> DataFrame:
    """Rows whose fingerprint the history lacks, once each even if the batch repeats them.

    By default a fingerprint seen at any time is old.  With ``key`` and ``recency`` only
    the latest history row of each key counts, so a value that changes and changes back is
    reported both times.
    """
    hashed = source.withColumn(hash_col, row_hash(cols)) if hash_col not in source.columns else source
    once = keep_latest(hashed, [hash_col], [])
    if key is not None:
        history = keep_latest(history, [key], [latest_first(recency)])
    return new_rows(once, history, [hash_col], wanted=hashed, **join_options)


def retry_unmapped(
    history: DataFrame,
    dim: DataFrame,
    key: ColumnLike,
    dim_key: ColumnLike,
    system_col: str = "ROSTER_SYSTEM",
    **join_options,
) -> DataFrame:
    """Rows that had no system before and have one in the refreshed lookup."""
    waiting = history.filter(F.col(system_col).isNull()).drop(system_col)
    mapped = dim.filter(F.col(system_col).isNotNull())
    found = lookup_by_key(waiting, mapped, key, dim_key, [system_col], how="inner", **join_options)
    return found.select(*history.columns)


def new_files(files: DataFrame, ledger: DataFrame, part: str = "", name: str = "file_name") -> DataFrame:
    """Distinct file names containing ``part`` that the ledger does not list.

    The part is matched as text, not as a LIKE pattern, because names contain underscores.
    """
    names = files.select(name)
    if part:
        names = names.filter(F.contains(F.col(name), F.lit(part)))
    return names.subtract(ledger.select(name))


def mark_processed(ledger: DataFrame, files: DataFrame, as_of: datetime, name: str = "file_name") -> DataFrame:
    """Ledger rows to append for a processed batch."""
    return files.select(F.col(name), ntz(as_of).alias("processed_at")).select(*ledger.columns)


def forget(ledger: DataFrame, names: Sequence[str], name: str = "file_name") -> DataFrame:
    """Ledger without the given names, so that those files are processed again."""
    return ledger.filter(~F.col(name).isin(*names))


def rows_of_new_files(rows: DataFrame, fresh: DataFrame, name: str = "file_name", **join_options) -> DataFrame:
    """Rows that came from one of the new files."""
    return join_unique(rows, fresh.select(name).distinct(), [name], "left_semi", **join_options)


def conform_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename by ``{new: old}``, every column as text."""
    return df.select(*[F.col(old).cast("string").alias(new) for new, old in mapping.items()])
