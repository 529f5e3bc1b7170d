"""Reusable predicates and row splits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.text import ColumnLike, as_col, is_blank, is_filled


def differs_or_null(col: ColumnLike, value) -> Column:
    """Not equal to ``value``, with NULL counted as different."""
    col = as_col(col)
    return (col != F.lit(value)) | col.isNull()


def unlike(col: ColumnLike, pattern: str) -> Column:
    """Case-insensitive NOT LIKE; a NULL name drops out, as in SQL."""
    return ~F.upper(as_col(col)).like(pattern.upper())


def filter_nonblank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(is_filled(col))


def flagged(flags: dict[str, str]) -> Column:
    """All text flags have the given value, e.g. ``{"IS_DELETED": "FALSE"}``."""
    out = F.lit(True)
    for name, value in flags.items():
        out = out & (F.col(name) == F.lit(value))
    return out


def pending(
    df: DataFrame,
    system: str | None = None,
    types: Iterable[str] = (),
    system_col: str = "ROSTER_SYSTEM",
    type_col: str = "CONTACT_TYPE",
    stamp_col: str = "SENT_TIMESTAMP",
) -> DataFrame:
    """Rows of one system and type that were not sent yet."""
    out = df.filter(F.col(stamp_col).isNull())
    if system is not None:
        out = out.filter(F.col(system_col) == F.lit(system))
    types = list(types)
    if types:
        out = out.filter(F.col(type_col).isin(*types))
    return out


def split_matched(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a value in ``col`` and rows without: together exactly ``df``."""
    return df.filter(~is_blank(col)), df.filter(is_blank(col))


def cutover(old: DataFrame, new: DataFrame, year: int, year_col: str = "INVOICE_YEAR") -> tuple[DataFrame, DataFrame]:
    """Keep ``old`` before ``year`` and ``new`` from it on."""
    return old.filter(F.col(year_col) < year), new.filter(F.col(year_col) >= year)
