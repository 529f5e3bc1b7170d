"""Billing summaries, variance and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.dates import in_period, month_text, shift_month
from flowtables.functions.text import ColumnLike
from flowtables.functions.values import adjusted_amount, split_amount, with_vat

# Totals are stored in whole units unless asked otherwise.
WHOLE_UNITS = "decimal(38,0)"
CENTS = "decimal(38,2)"


def detail_aggregate(
    headers: DataFrame,
    items: DataFrame,
    key: str,
    item_cols: Sequence[str],
    sums: Mapping[str, str],
    amount_type: str = WHOLE_UNITS,
) -> DataFrame:
    """Sums per invoice and item group, with the header columns attached.

    ``headers`` has one row per key, so its columns depend on ``key`` alone and the items
    can be summed before the join.  That is the same grouping, but the sums start in the
    map tasks: an invoice holding much of the data reaches the join as a few rows.
    """
    lines = items.groupBy(key, *item_cols).agg(
        *[F.round(F.sum(source), 2).cast(amount_type).alias(name) for name, source in sums.items()]
    )
    return headers.join(lines, key, "inner")


def summarise_billing(
    detail: DataFrame,
    keys: Sequence[str],
    name: str | None = None,
    amount_type: str = WHOLE_UNITS,
) -> DataFrame:
    """Invoiced amounts, expenses and hours per group.

    Split and discount apply per line, VAT once per group at the highest code found there.
    Amounts are rounded to cents and then stored as ``amount_type``.

    ``name`` is a text that belongs to a group but may be spelled in several ways; the
    largest spelling is kept.  Each spelling takes the highest code of its own lines: amounts
    are summed and grossed up per spelling, and the few spellings of a group are added then.
    """
    expense = F.col("TYPE") == "expense"
    zero = F.lit(0).cast("decimal(27,6)")
    billed = F.when(~expense, adjusted_amount("TOT_AMT_BILLING", "SPLIT", "DISCOUNTPERCENT")).otherwise(zero)
    spent = F.when(expense, split_amount("TOT_AMT_BILLING", "SPLIT").cast("decimal(27,6)")).otherwise(zero)
    spellings = [name] if name else []
    groups = detail.groupBy(*keys, *spellings).agg(
        F.sum(billed).alias("__billed"),
        F.sum(spent).alias("__spent"),
        F.sum("TOT_CNT_HOURS").alias("__hours"),
        F.max("VAT").alias("__vat"),
    )
    groups = groups.withColumns({c: with_vat(c, "__vat") for c in ("__billed", "__spent")})
    if name:
        groups = groups.groupBy(*keys).agg(F.max(name).alias(name), *[F.sum(c).alias(c) for c in ("__billed", "__spent", "__hours")])
    return groups.select(
        *keys,
        *spellings,
        F.round("__billed", 2).cast(amount_type).alias("TOT_AMT_INVOICED"),
        F.round("__spent", 2).cast(amount_type).alias("TOT_AMT_EXPENSES"),
        F.round("__hours", 2).cast(amount_type).alias("TOT_CNT_HOURS"),
    )


def rounded_sums(df: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, str], digits: int = 0) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.round(F.sum(source), digits).alias(name) for name, source in sums.items()])


def monthly_summary(df: DataFrame, dims: Sequence[str | Column], year: str, month: str, amount: str) -> DataFrame:
    """Sum in whole units per dimension and month, the month as three-letter text."""
    grouped = rounded_sums(df, [*dims, year, month], {amount: amount})
    return grouped.withColumn(month, month_text(F.col(year), F.col(month)))


def hours_summary(
    df: DataFrame,
    office: str = "OFFICE_ID",
    period_end: str = "PERIOD_END",
    customers: str = "CUSTOMERS",
    visits: str = "PERIOD_VISITS",
    hours: str = "CHARGED_HOURS",
) -> DataFrame:
    """Average customers, total visits and hours per office and month."""
    return df.groupBy(
        F.col(office), F.year(period_end).alias("INVOICE_YEAR"), F.month(period_end).alias("INVOICE_MONTH")
    ).agg(
        F.round(F.avg(customers), 0).alias("TOT_CNT_CUSTOMERS"),
        F.round(F.sum(visits), 0).alias("TOT_CNT_VISITS"),
        F.round(F.sum(hours), 0).alias("TOT_CNT_HOURS"),
    )


def period_variance(
    df: DataFrame,
    current: Column,
    previous: Column,
    amount: ColumnLike,
) -> DataFrame:
    """One row comparing two periods: totals, percent to one decimal, and the message.

    Both totals come from one pass; a previous total that is not positive gives no percent.
    """
    def total(period: Column) -> Column:
        return F.coalesce(F.sum(F.when(period, amount)), F.lit(0))

    amount = F.col(amount) if isinstance(amount, str) else amount
    totals = df.filter(current | previous).agg(
        total(current).cast(CENTS).alias("CURR_TOTAL"), total(previous).cast(CENTS).alias("PREV_TOTAL")
    )
    share = (F.col("CURR_TOTAL") - F.col("PREV_TOTAL")).cast("double") / F.col("PREV_TOTAL").cast("double")
    pct = F.when(F.col("PREV_TOTAL") > 0, F.round(share * 100, 1))
    with_pct = totals.withColumn("VARIANCE_PCT", pct)
    return with_pct.withColumn(
        "MESSAGE",
        F.concat(
            F.lit("Current: "), F.format_number("CURR_TOTAL", 0),
            F.lit(" | Previous: "), F.format_number("PREV_TOTAL", 0),
            F.lit(" | Variance: "),
            F.coalesce(F.concat(F.col("VARIANCE_PCT").cast("string"), F.lit("%")), F.lit("N/A")),
        ),
    )


def month_variance(df: DataFrame, day: date, amount: str, month_as_text: bool = False) -> DataFrame:
    """``period_variance`` of the month of ``day`` against the month before it."""
    def period(d: date) -> Column:
        if month_as_text:
            return (F.col("INVOICE_YEAR") == d.year) & (F.col("INVOICE_MONTH") == d.strftime("%b"))
        return in_period(d)

    return period_variance(df, period(day), period(shift_month(day, -1)), amount)


def profile(
    df: DataFrame,
    dims: Sequence[str | Column],
    sums: Mapping[str, str] | None = None,
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Row count and sums per dimension, ordered for reading."""
    measures = [F.count("*").alias("CNT"), *[F.sum(source).alias(name) for name, source in (sums or {}).items()]]
    out = df.groupBy(*dims).agg(*measures)
    return out.orderBy(*order) if order else out


def counts(
    df: DataFrame, conditions: Mapping[str, Column], total: str = "TOTAL", value: str | None = None
) -> DataFrame:
    """One row, one pass: row count, conditional counts, and the largest and summed ``value``.

    The sum is zero, not NULL, when there are no rows.
    """
    measures = [F.count("*").alias(total), *[F.count_if(c).alias(name) for name, c in conditions.items()]]
    if value is not None:
        measures += [F.max(value).alias("MAX_VALUE"), F.coalesce(F.sum(value), F.lit(0)).alias("SUM_VALUE")]
    return df.agg(*measures)


def joined_names(df: DataFrame, name: str, keys: Sequence[str] = (), sep: str = ", ", out: str = "NAMES") -> DataFrame:
    """Distinct names in order as one text per group; for lists of files, tables or codes.

    Names are made distinct first, so what a group gathers grows with its names, not rows.
    """
    ordered = F.array_join(F.array_sort(F.collect_list(name)), sep)
    return df.select(*keys, name).distinct().groupBy(*keys).agg(ordered.alias(out))


def most_recent(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, found without sorting the whole frame."""
    return df.orderBy(*order).limit(n)
