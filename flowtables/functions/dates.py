"""Period keys, month text, safe parsing and local stamps.

Nothing here reads the clock: every job passes one ``as_of`` UTC instant.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions.text import ColumnLike, as_col

# An all-digit text is an epoch whose unit follows from its size.
_EPOCH_UNITS = [
    (31_536_000_000, 1_000_000),  # seconds
    (31_536_000_000_000, 1_000),  # milliseconds
    (31_536_000_000_000_000, 1),  # microseconds
]
_DAY_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$"
_DAY_FIRST_TIME = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2})\s*$"


def month_start(day: date) -> date:
    return date(day.year, day.month, 1)


def shift_month(day: date, months: int) -> date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def period_key(as_of: date | datetime, padded: bool = True) -> str:
    """Key of the month before ``as_of``: ``2026_02``, or ``2026_2`` unpadded."""
    previous = shift_month(as_of, -1)
    return f"{previous.year}_{previous.month:02d}" if padded else f"{previous.year}_{previous.month}"


def local_time(as_of: datetime, zone: str = "Europe/London") -> datetime:
    """Wall-clock time in ``zone`` of a UTC instant, without a zone."""
    utc = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    return utc.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def file_stamp(as_of: datetime, zone: str = "Europe/London") -> str:
    return local_time(as_of, zone).strftime("%Y%m%d_%H%M%S")


def ntz(moment: datetime) -> Column:
    """A wall-clock literal that does not depend on the session time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_text(year: ColumnLike, month: ColumnLike) -> Column:
    """Three-letter month name, such as ``Jan``."""
    return F.date_format(F.make_date(as_col(year), as_col(month), F.lit(1)), "MMM")


def month_of_text(text: ColumnLike) -> Column:
    return F.month(F.to_date(as_col(text), "MMM"))


def closed_months_only(df: DataFrame, as_of: date, year: str = "INVOICE_YEAR", month: str = "INVOICE_MONTH") -> DataFrame:
    """Keep rows whose month, held as year and three-letter month text, ended before ``as_of``.

    Stored values are compared with literals, so the condition prunes partitions and row groups.
    """
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    earlier = F.col(year) < F.lit(as_of.year)
    this_year = (F.col(year) == F.lit(as_of.year)) & F.col(month).isin(*names[: as_of.month - 1]) if as_of.month > 1 else F.lit(False)
    return df.filter((earlier & F.col(month).isin(*names)) | this_year)


def in_period(day: date, year: str = "INVOICE_YEAR", month: str = "INVOICE_MONTH") -> Column:
    """Year and month equality with literals, so that partitions are pruned."""
    return (F.col(year) == F.lit(day.year)) & (F.col(month) == F.lit(day.month))


def filter_period(df: DataFrame, day: date, year: str = "INVOICE_YEAR", month: str = "INVOICE_MONTH") -> DataFrame:
    return df.filter(in_period(day, year, month))


def same_year(col: ColumnLike, as_of: date) -> Column:
    """The timestamp falls in the calendar year of ``as_of``, written as a range.

    The range form reaches the scan as a pushed filter; ``year(col) = n`` would not.
    """
    start, end = datetime(as_of.year, 1, 1), datetime(as_of.year + 1, 1, 1)
    return (as_col(col) >= ntz(start)) & (as_col(col) < ntz(end))


def day_first_date(col: ColumnLike) -> Column:
    """``DD/MM/YYYY`` text, padded or not; NULL when it is no date."""
    iso = F.regexp_replace(as_col(col), _DAY_FIRST, "$3-$2-$1")
    return F.when(as_col(col).rlike(_DAY_FIRST), iso.try_cast("date"))


def day_first_timestamp(col: ColumnLike) -> Column:
    """``DD/MM/YYYY HH24:MI`` text, padded or not; NULL when it is no timestamp."""
    iso = F.regexp_replace(as_col(col), _DAY_FIRST_TIME, "$3-$2-$1 $4:$5:00")
    return F.when(as_col(col).rlike(_DAY_FIRST_TIME), iso.try_cast("timestamp_ntz"))


def safe_timestamp(col: ColumnLike) -> Column:
    """ISO text or an epoch written as digits; NULL for anything else."""
    text = as_col(col)
    number = text.try_cast("bigint")
    micros = F.floor(number / F.lit(1000)).cast("bigint")
    for limit, factor in reversed(_EPOCH_UNITS):
        micros = F.when(number < F.lit(limit), number * F.lit(factor)).otherwise(micros)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    from_epoch = epoch + F.make_dt_interval(secs=micros.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)"))
    return F.when(text.rlike(r"^\d{5,19}$"), from_epoch).otherwise(text.try_cast("timestamp_ntz"))


def text_of_date(col: ColumnLike, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_col(col), pattern)


def retype_column(df: DataFrame, col: str, pattern: str = "dd/MM/yyyy") -> DataFrame:
    """Turn a date column into formatted text under the same name and position."""
    return df.withColumn(col, text_of_date(col, pattern))
