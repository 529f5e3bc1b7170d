"""Value mapping, fallbacks and billing arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

from flowtables.functions.text import ColumnLike, as_col

_HUNDREDTH = Decimal("0.01")


def map_values(col: ColumnLike, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace listed values; others pass through, or become ``default``."""
    col = as_col(col)
    first, *rest = mapping.items()
    cases = F.when(col == first[0], F.lit(first[1]))
    for key, value in rest:
        cases = cases.when(col == key, F.lit(value))
    return cases.otherwise(col if default is None else default)


def label_by_like(col: ColumnLike, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """Label of the first LIKE pattern that matches."""
    col = as_col(col)
    return reduce(
        lambda otherwise, rule: F.when(col.like(rule[0]), F.lit(rule[1])).otherwise(otherwise),
        reversed(list(rules)),
        F.lit(default),
    )


def first_tagged(preferred: ColumnLike, fallback: ColumnLike, untagged: Iterable[str] = ("", "Untagged")) -> Column:
    """``preferred`` unless it is NULL or one of the untagged marks."""
    preferred = as_col(preferred)
    return F.when(preferred.isNull() | preferred.isin(*untagged), as_col(fallback)).otherwise(preferred)


def whole_percent(text: ColumnLike) -> Column:
    """Percent text as a whole number; junk, and values outside 0..100, count as no percent."""
    number = as_col(text).try_cast("decimal(38,0)")
    return F.when(number.between(0, 100), number).otherwise(F.lit(0)).cast("decimal(3,0)")


def split_amount(amount: ColumnLike, split: ColumnLike) -> Column:
    """Share of the amount given by a positive split percent; otherwise the whole amount.

    Widths are kept below 38 digits on purpose: multiplying two 38-digit decimals would
    leave only six fractional digits.
    """
    amount = as_col(amount).cast("decimal(18,2)")
    share = as_col(split).cast("decimal(9,0)")
    part = (amount * share * F.lit(_HUNDREDTH)).cast("decimal(24,4)")
    return F.when(share > 0, part).otherwise(amount.cast("decimal(24,4)"))


def adjusted_amount(amount: ColumnLike, split: ColumnLike, discount: ColumnLike) -> Column:
    """Split share less the discount percent, exact to six fractional digits."""
    kept = F.lit(1).cast("decimal(3,0)") - whole_percent(discount) * F.lit(_HUNDREDTH)
    return (split_amount(amount, split) * kept).cast("decimal(27,6)")


def gross_up(amount: ColumnLike, vat: ColumnLike, exempt: int = 99) -> Column:
    """Amount with VAT added; NULL and the exempt code add nothing. Rounded to cents."""
    return F.round(with_vat(amount, vat, exempt), 2)


def with_vat(amount: ColumnLike, vat: ColumnLike, exempt: int = 99) -> Column:
    """The same before rounding, for amounts that are summed first."""
    vat = as_col(vat).cast("decimal(5,0)")
    factor = F.lit(1).cast("decimal(3,0)") + vat * F.lit(_HUNDREDTH)
    exact = as_col(amount).cast("decimal(27,6)")
    return F.when(vat.isNotNull() & (vat != exempt), exact * factor).otherwise(exact)
