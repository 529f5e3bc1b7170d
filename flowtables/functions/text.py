"""Name normalisation, join keys and row fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_name(col: ColumnLike, strip_patterns: Iterable[str] = (), drop_words: Iterable[str] = ()) -> Column:
    """Display name: decode ``&amp;``, drop literal words, strip patterns and ``( ) -``, trim."""
    out = F.replace(as_col(col), F.lit("&amp;"), F.lit("&"))
    for word in drop_words:
        out = F.replace(out, F.lit(word), F.lit(""))
    for pattern in strip_patterns:
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, "[()-]", ""))


def join_key(col: ColumnLike, drop_words: Iterable[str] = ()) -> Column:
    """Hard key: upper case, ``&`` spelled ``AND``, words dropped, only ``A-Z0-9`` kept."""
    out = F.upper(F.trim(as_col(col)))
    for mark in ("&AMP;", "&"):
        out = F.replace(out, F.lit(mark), F.lit("AND"))
    for word in drop_words:
        out = F.replace(out, F.lit(word.upper()), F.lit(""))
    return F.regexp_replace(out, "[^A-Z0-9]", "")


def compact_key(col: ColumnLike) -> Column:
    """Soft key: `` & `` spelled ``AND``, blanks removed, upper case."""
    spelled = F.replace(F.trim(as_col(col)), F.lit(" & "), F.lit(" AND "))
    return F.upper(F.replace(spelled, F.lit(" "), F.lit("")))


def plain_key(col: ColumnLike) -> Column:
    return F.upper(F.trim(as_col(col)))


def first_part(col: ColumnLike, sep: str = "-") -> Column:
    return F.trim(F.split_part(as_col(col), F.lit(sep), F.lit(1)))


def last_part(col: ColumnLike, sep: str = "/") -> Column:
    return F.split_part(as_col(col), F.lit(sep), F.lit(-1))


def blank_if_null(col: ColumnLike) -> Column:
    return F.coalesce(as_col(col), F.lit(""))


def is_blank(col: ColumnLike) -> Column:
    col = as_col(col)
    return col.isNull() | (col == "")


def is_filled(col: ColumnLike) -> Column:
    col = as_col(col)
    return col.isNotNull() & (col != "")


def row_hash(cols: Iterable[ColumnLike]) -> Column:
    """MD5 over the columns as text, NULL as the empty string, joined by a bar."""
    return F.md5(F.concat_ws("|", *[blank_if_null(as_col(c).cast("string")) for c in cols]))
