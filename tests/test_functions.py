"""Column functions: names, keys, dates, billing arithmetic."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtables.functions import dates, text, values


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("raw, want", [
    ("Unit 7: (North-East) &amp; Sons", "NorthEast & Sons"),
    ("Kiosk 31: South", "South"),
    ("unit 7: East", "unit 7: East"),  # patterns are case-sensitive
    ("Unit 7: A Kiosk 12: B", "A B"),  # every match goes
    (None, None),
])
def test_clean_name(spark, raw, want):
    assert one(spark, raw, lambda c: text.clean_name(c, ["(?:Unit|Kiosk) [0-9]+: "])) == want


@pytest.mark.parametrize("raw, want", [
    (" Unit 7: North & South ", "NORTHANDSOUTH"),
    ("North &amp; South", "NORTHANDSOUTH"),
    ("unit 7:", ""),
    (None, None),
])
def test_join_key(spark, raw, want):
    assert one(spark, raw, lambda c: text.join_key(c, ["Unit 7:"])) == want


def test_other_keys(spark):
    assert one(spark, " North & South ", text.compact_key) == "NORTHANDSOUTH"
    assert one(spark, "North&South", text.compact_key) == "NORTH&SOUTH"
    assert one(spark, "  mixed Case ", text.plain_key) == "MIXED CASE"
    assert one(spark, " first - second", text.first_part) == "first"
    assert one(spark, "a/b/c.json", text.last_part) == "c.json"


def test_row_hash_treats_null_as_blank(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("", "a")], "x string, y string").select(text.row_hash(["x", "y"]).alias("h")).collect()
    assert rows[0].h == rows[1].h != rows[2].h


@pytest.mark.parametrize("raw, want", [
    ("2024-01-05T10:00:00.5Z", datetime(2024, 1, 5, 10, 0, 0, 500000)),
    ("2024-01-05", datetime(2024, 1, 5)),
    ("1700000000", datetime(2023, 11, 14, 22, 13, 20)),
    ("1700000000123", datetime(2023, 11, 14, 22, 13, 20, 123000)),
    ("1700000000123456", datetime(2023, 11, 14, 22, 13, 20, 123456)),
    ("1700000000123456789", datetime(2023, 11, 14, 22, 13, 20, 123456)),
    ("junk", None), ("", None), (None, None),
])
def test_safe_timestamp(spark, raw, want):
    assert one(spark, raw, dates.safe_timestamp) == want


@pytest.mark.parametrize("raw, want", [
    ("05/01/2024 09:05", datetime(2024, 1, 5, 9, 5)),
    ("5/1/2024 9:05", datetime(2024, 1, 5, 9, 5)),
    ("31/02/2024 09:05", None), ("2024-01-05 09:05", None), ("", None), (None, None),
])
def test_day_first_timestamp(spark, raw, want):
    assert one(spark, raw, dates.day_first_timestamp) == want


def test_day_first_timestamp_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:  # 01:30 does not exist on this London day
        assert one(spark, "31/03/2024 01:30", dates.day_first_timestamp) == datetime(2024, 3, 31, 1, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_first_date(spark):
    assert one(spark, "5/1/1950", dates.day_first_date) == date(1950, 1, 5)
    assert one(spark, "1950-01-05", dates.day_first_date) is None


def test_period_keys():
    assert dates.period_key(date(2026, 3, 1)) == "2026_02"
    assert dates.period_key(date(2026, 3, 1), padded=False) == "2026_2"
    assert dates.period_key(datetime(2026, 1, 31, 8)) == "2025_12"
    assert dates.shift_month(date(2024, 1, 31), 1) == date(2024, 2, 1)
    assert dates.file_stamp(datetime(2024, 6, 10, 9, 55)) == "20240610_105500"
    assert dates.local_time(datetime(2024, 1, 10, 9, 55)) == datetime(2024, 1, 10, 9, 55)


def test_month_text_and_closed_months(spark):
    df = spark.createDataFrame([(2024, m) for m in range(1, 13)], "INVOICE_YEAR int, m int")
    df = df.withColumn("INVOICE_MONTH", dates.month_text("INVOICE_YEAR", "m"))
    rows = df.withColumn("back", dates.month_of_text("INVOICE_MONTH")).collect()
    assert [r.INVOICE_MONTH for r in rows] == "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    assert all(r.back == r.m for r in rows)
    assert dates.closed_months_only(df, date(2024, 4, 30)).count() == 3


def test_retype_column(spark):
    df = spark.createDataFrame([(1, date(2024, 2, 3), "z")], "a int, d date, b string")
    out = dates.retype_column(df, "d")
    assert out.columns == ["a", "d", "b"] and out.first().d == "03/02/2024"


@pytest.mark.parametrize("discount, want", [(None, 0), ("10", 10), ("12.5", 13), ("150", 0), ("-5", 0), ("abc", 0), ("100", 100)])
def test_whole_percent(spark, discount, want):
    assert one(spark, discount, values.whole_percent) == want


@pytest.mark.parametrize("amount, split, discount, want", [
    ("100.00", None, None, "100"), ("100.00", 0, None, "100"), ("100.00", 33, "10", "29.7"), ("0.07", 33, "13", "0.020097"),
])
def test_adjusted_amount_is_exact(spark, amount, split, discount, want):
    df = spark.createDataFrame([(Decimal(amount), split, discount)], "a decimal(38,2), s int, d string")
    assert df.select(values.adjusted_amount("a", "s", "d").alias("y")).first().y == Decimal(want)


@pytest.mark.parametrize("vat, want", [(None, "10.01"), (99, "10.01"), (0, "10.01"), (20, "12.01"), (5, "10.51")])
def test_gross_up(spark, vat, want):
    df = spark.createDataFrame([(Decimal("10.005000"), vat)], "a decimal(27,6), v int")
    assert df.select(values.gross_up("a", "v").alias("y")).first().y == Decimal(want)


def test_mapping_and_labels(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "x string")
    rows = df.select(
        values.map_values("x", {"A": "Active"}).alias("m"),
        values.map_values("x", {"A": "Active"}, F.lit("other")).alias("d"),
        values.label_by_like("x", [("A%", "first"), ("%", "any")], "none").alias("l"),
        values.first_tagged("x", F.lit("office"), ("Z",)).alias("t"),
    ).collect()
    assert [tuple(r) for r in rows] == [("Active", "Active", "first", "A"), ("Z", "other", "any", "office"), (None, "other", "none", "office")]
