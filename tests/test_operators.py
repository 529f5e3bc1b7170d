"""Windows, joins, merges and deltas against brute force, on both join paths."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtables import schemas
from flowtables.operators import aggregates, conform, delta, filters, joins, merge, windows

SMALL, LARGE = 64 * 1024 * 1024, -1  # a negative limit forces the shuffled path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ windows


def test_keep_latest_puts_null_first_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "a"), (1, None, "b"), (2, datetime(2024, 1, 2), "y"), (2, datetime(2024, 1, 2), "x")],
        "k int, t timestamp_ntz, v string",
    )
    assert rows(windows.keep_latest(df, ["k"], [windows.latest_first("t")])) == [(1, None, "b"), (2, datetime(2024, 1, 2), "x")]


def test_keep_latest_is_the_same_for_any_partitioning(spark):
    random.seed(7)
    data = [(random.choice([1, 1, 1, 2, 3]), random.randint(0, 3), random.randint(0, 5)) for _ in range(500)]
    want = {}
    for k, t, v in data:
        want[k] = min(want.get(k, (9, 9)), (-t, v))
    for parts in (1, 7):
        got = windows.keep_latest(spark.createDataFrame(data, "k int, t int, v int").repartition(parts), ["k"], [F.col("t").desc()])
        assert {r.k: (-r.t, r.v) for r in got.collect()} == want


def test_keep_latest_keeps_null_keys_apart(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a"), (1, "b")], "k int, v string")
    assert windows.keep_latest(df, ["k"], []).count() == 2
    assert rows(windows.keep_latest(df, ["k"], [], keep_null_keys=True)) == [(1, "a"), (None, "a"), (None, "b")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = windows.keep_latest(spark.range(100).select((F.col("id") % 3).alias("k"), "id"), ["k"], [F.col("id").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0 and "Partial" in plan


def test_movement_sums_to_the_last_value(spark):
    random.seed(3)
    data = [(k, m, Decimal(random.randint(0, 99))) for k in range(5) for m in range(6) if random.random() < 0.8]
    df = spark.createDataFrame(data, "k int, m int, v decimal(18,2)")
    moved = windows.movement(df, ["k"], "m", "v", "d").groupBy("k").agg(F.sum("d").alias("d"))
    last = {k: v for k, m, v in sorted(data)}
    assert {r.k: r.d for r in moved.collect()} == last


def test_latest_per_month_keeps_one_row_per_month(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, d), d) for d in (1, 9)] + [(1, datetime(2024, 2, 1), 3)], "k int, t timestamp_ntz, v int")
    assert [r.v for r in windows.keep_latest_per_month(df, ["k"], "t").orderBy("t").collect()] == [9, 3]


# ------------------------------------------------------------------ joins


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows share one key, another part has none."""
    random.seed(11)
    data = [(i, random.choice(["hot"] * 4 + [None, None] + [f"k{n}" for n in range(6)])) for i in range(600)]
    return data, spark.createDataFrame(data, "id int, k string")


@pytest.mark.parametrize("limit", [SMALL, LARGE])
def test_join_unique(spark, facts, limit):
    data, df = facts
    dim = {"hot": "H", "k1": "one", "k2": "two", "unused": "x"}
    right = spark.createDataFrame(list(dim.items()), "k string, v string")
    for how, want in {
        "left": [(k, i, dim.get(k)) for i, k in data],
        "inner": [(k, i, dim[k]) for i, k in data if k in dim],
        "left_anti": [(k, i) for i, k in data if k not in dim],
        "left_semi": [(k, i) for i, k in data if k in dim],
    }.items():
        assert rows(joins.join_unique(df, right, ["k"], how, limit=limit)) == sorted(want, key=repr)


@pytest.mark.parametrize("limit", [SMALL, LARGE])
def test_lookup_never_multiplies_rows(spark, facts, limit):
    _, df = facts
    # Two spellings of one key: the later id wins, and neither doubles a row.
    dim = spark.createDataFrame([(1, " HOT", "old"), (2, "hot ", "new"), (3, "", "blank"), (4, None, "none")], "id int, name string, v string")
    key = lambda c: F.upper(F.trim(c))
    out = joins.lookup_by_key(df, dim, key("k"), key("name"), ["v"], [F.col("id").desc()], limit=limit)
    assert out.count() == df.count()
    assert {(r.k, r.v) for r in out.collect() if r.v} == {("hot", "new")}
    assert rows(joins.duplicate_names(dim, key("name"), "name")) == [("HOT", 2, " HOT", "hot ")]


@pytest.mark.parametrize("limit", [SMALL, LARGE])
def test_anti_join(spark, facts, limit):
    data, df = facts
    target = spark.createDataFrame([("hot",), ("hot",), ("k1",), (None,)], "k string")
    want = [(i, k) for i, k in data if k not in ("hot", "k1")]
    assert rows(joins.new_rows(df, target, ["k"], limit=limit)) == sorted(want, key=repr)


def test_large_side_is_not_broadcast(spark, facts):
    _, df = facts
    right = spark.createDataFrame([("hot", "H")], "k string, v string")
    assert joins.fits_broadcast(right) and not joins.fits_broadcast(right, 5)
    assert joins.measured_bytes(right) == len('{"k":"hot","v":"H"}')
    assert "__salt" in joins.join_unique(df, right, ["k"], limit=LARGE)._jdf.queryExecution().analyzed().toString()


def test_map_codes_and_enrich(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, code string")
    codes = spark.createDataFrame([("a", "Z"), ("a", "A"), ("c", "C")], "c string, v string")
    assert rows(joins.map_codes(df, codes, "code", "c", "v")) == [(1, "A"), (2, "b"), (3, None)]
    dim = spark.createDataFrame([(1, "p", "q"), (1, "p", "r"), (None, "n", "n")], "k int, x string, y string")
    assert rows(joins.enrich(df, dim, ("id", "k"), ["x"])) == [(1, "a", "p"), (2, "b", None), (3, None, None)]
    assert joins.enrich(df, dim, ("id", "k"), ["x", "y"]).count() == 3


# ------------------------------------------------------------------ merges


def brute_merge(target, source, key):
    by_key = {key(s): s for s in source if key(s) is not None}
    out = [(t[0], t[1], by_key[key(t)][2] if key(t) in by_key else t[2]) for t in target]
    known = {key(t) for t in target if key(t) is not None}
    return sorted(out + [s for s in source if key(s) is None or key(s) not in known], key=repr)


@pytest.mark.parametrize("limit", [SMALL, LARGE])
@pytest.mark.parametrize("blank", [(), ("b",)])
def test_merge_upsert(spark, limit, blank):
    target = [(1, "x", 10), (1, "x", 11), (2, None, 20), (3, "", 30), (None, "x", 40)] + [(7, "h", n) for n in range(50)]
    source = [(1, "x", 99), (2, "", 98), (3, None, 97), (None, "x", 96), (5, "n", 95), (7, "h", 94)]

    def key(r):
        a, b = r[0], (r[1] or "") if blank else r[1]
        return None if a is None or b is None else (a, b)

    t, s = spark.createDataFrame(target, "a int, b string, v int"), spark.createDataFrame(source, "a int, b string, v int")
    assert rows(merge.merge_upsert(t, s, ["a", "b"], ["v"], blank_null=blank, limit=limit)) == brute_merge(target, source, key)


def test_merge_refuses_two_source_rows_for_one_key(spark):
    t = spark.createDataFrame([(1, 1)], "a int, v int")
    twice = spark.createDataFrame([(1, 2), (1, 3)], "a int, v int")
    with pytest.raises(merge.DuplicateSourceKey):
        merge.merge_upsert(t, twice, ["a"], ["v"])
    nulls = spark.createDataFrame([(None, 2), (None, 3)], "a int, v int")
    assert merge.merge_upsert(t, nulls, ["a"], ["v"]).count() == 3


def test_merge_blank_keys_in_source_collide(spark):
    t = spark.createDataFrame([(1, "x", 1)], "a int, b string, v int")
    s = spark.createDataFrame([(1, None, 2), (1, "", 3)], "a int, b string, v int")
    with pytest.raises(merge.DuplicateSourceKey):
        merge.merge_upsert(t, s, ["a", "b"], ["v"], blank_null=["b"])


def test_merge_twice_changes_nothing(spark):
    t = spark.createDataFrame([(1, 1), (2, 2)], "a int, v int")
    s = spark.createDataFrame([(2, 5), (3, 6)], "a int, v int")
    once = merge.merge_upsert(t, s, ["a"], ["v"])
    assert rows(merge.merge_upsert(once, s, ["a"], ["v"])) == rows(once) == [(1, 1), (2, 5), (3, 6)]


@pytest.mark.parametrize("limit", [SMALL, LARGE])
def test_merge_insert_and_update_from(spark, limit):
    t = spark.createDataFrame([(1, None), (2, "b"), (None, None)], "k int, v string")
    s = spark.createDataFrame([(1, "z"), (1, "y"), (2, "q"), (3, "n"), (3, "n"), (None, "w")], "k int, v string")
    assert rows(merge.merge_insert(t, s, ["k"], limit)) == sorted([(1, None), (2, "b"), (None, None), (3, "n"), (None, "w")], key=repr)
    out = merge.update_from(t, s, "k", ["v"], F.col("v").isNull(), limit)
    assert rows(out) == [(1, "y"), (2, "b"), (None, None)]


@pytest.mark.parametrize("limit", [SMALL, LARGE])
def test_mark_sent_stamps_exactly_the_batch(spark, limit):
    stamp, before = datetime(2024, 5, 1), datetime(2024, 4, 1)
    t = spark.createDataFrame([("a", None), ("b", None), ("c", before), (None, None)], "k string, SENT_TIMESTAMP timestamp_ntz")
    batch = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    out = {r.k: r.SENT_TIMESTAMP for r in merge.mark_sent(t, batch, ["k"], stamp, limit=limit).collect()}
    assert out == {"a": stamp, "b": None, "c": before, None: stamp}


def test_resend_and_mark_where(spark):
    stamp = datetime(2024, 5, 1)
    t = spark.createDataFrame([("S", None), ("T", None)], "ROSTER_SYSTEM string, SENT_TIMESTAMP timestamp_ntz")
    sent = merge.mark_where(t, F.col("ROSTER_SYSTEM") == "S", stamp)
    assert {tuple(r) for r in sent.collect()} == {("S", stamp), ("T", None)}
    assert rows(merge.resend(sent, "S", stamp)) == rows(t)
    assert rows(merge.resend(sent, "S", datetime(2024, 5, 2))) == rows(sent)


# ------------------------------------------------------------------ deltas


def test_watermark_takes_late_rows_at_the_maximum(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    loaded = spark.createDataFrame([("a", t1), ("b", t2)], "k string, t timestamp_ntz")
    source = spark.createDataFrame([("a", t1), ("b", t2), ("late", t2), ("new", datetime(2024, 1, 3))], "k string, t timestamp_ntz")
    mark = delta.high_watermark(loaded, "t")
    assert mark == t2
    assert {r.k for r in delta.after_watermark(source, "t", mark).collect()} == {"new"}
    assert {r.k for r in delta.after_watermark(source, "t", mark, loaded, ["k"]).collect()} == {"late", "new"}
    assert delta.high_watermark(loaded.limit(0), "t") == delta.BEGINNING


def test_watermark_reaches_the_scan(spark, folder):
    spark.createDataFrame([("a", datetime(2024, 1, 1))], "k string, t timestamp_ntz").write.parquet(f"{folder}/t")
    plan = delta.after_watermark(spark.read.parquet(f"{folder}/t"), "t", datetime(2023, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t," in plan


def test_tracked_delta_counts_only_success(spark):
    tracking = spark.createDataFrame([(datetime(2024, 1, 1), "SUCCESS"), (datetime(2025, 1, 1), "RETRY")], "MAX_DATE timestamp_ntz, STATUS string")
    df = spark.createDataFrame([("2024-02-01",), ("2023-02-01",), ("junk",)], "s string")
    assert [r.s for r in delta.tracked_delta(df, tracking, F.col("s").try_cast("timestamp_ntz"), "ts").collect()] == ["2024-02-01"]


def test_hash_delta_drops_repeats_in_one_batch(spark):
    batch = spark.createDataFrame([("1", "A"), ("1", "A"), ("2", None), ("2", ""), ("3", "C")], "id string, v string")
    history = delta.hash_delta(spark.createDataFrame([("3", "C")], "id string, v string"), spark.createDataFrame([], "ROW_HASH string"), ["id", "v"])
    assert sorted(r.id for r in delta.hash_delta(batch, history, ["id", "v"]).collect()) == ["1", "2"]


def test_hash_delta_can_report_a_value_that_comes_back(spark):
    none = spark.createDataFrame([], "ROW_HASH string")
    a, b = (spark.createDataFrame([("1", v)], "id string, v string") for v in "AB")
    seen = delta.hash_delta(a, none, ["id", "v"]).withColumn("n", F.lit(1)).unionByName(delta.hash_delta(b, none, ["id", "v"]).withColumn("n", F.lit(2)))
    assert delta.hash_delta(a, seen, ["id", "v"]).count() == 0
    assert delta.hash_delta(a, seen, ["id", "v"], key="id", recency="n").count() == 1
    assert delta.hash_delta(b, seen, ["id", "v"], key="id", recency="n").count() == 0


def test_file_ledger(spark):
    files = spark.createDataFrame([("contacts_1.json",), ("contacts_2.json",), ("contactsX3.json",)], "file_name string")
    ledger = delta.mark_processed(spark.createDataFrame([], schemas.FILE_LEDGER), files.limit(1), datetime(2024, 1, 1))
    assert rows(delta.new_files(files, ledger, "contacts_")) == [("contacts_2.json",)]  # `_` is no wildcard
    assert rows(delta.new_files(files, delta.forget(ledger, ["contacts_1.json"]), "contacts_")) == [("contacts_1.json",), ("contacts_2.json",)]


def test_retry_unmapped(spark):
    hist = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "x", "OLD")], "id int, office string, ROSTER_SYSTEM string")
    dim = spark.createDataFrame([("X", "NEW"), ("Y", None)], "name string, ROSTER_SYSTEM string")
    out = delta.retry_unmapped(hist, dim, F.upper("office"), "name")
    assert out.columns == hist.columns and rows(out) == [(1, "x", "NEW")]


# ------------------------------------------------------------------ filters, conforming, aggregates


def test_split_is_an_exact_complement(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, n string")
    ok, bad = filters.split_matched(df, "n")
    assert rows(ok) == [(1, "a")] and ok.count() + bad.count() == 3


def test_predicates(spark):
    df = spark.createDataFrame([(1, "Training day"), (2, "Open"), (None, None)], "m int, n string")
    assert df.filter(filters.differs_or_null("m", 2)).count() == 2
    assert [r.n for r in df.filter(filters.unlike("n", "%training%")).collect()] == ["Open"]
    old, new = filters.cutover(df.withColumn("INVOICE_YEAR", F.lit(2025)), df.withColumn("INVOICE_YEAR", F.lit(2026)), 2026)
    assert old.count() == new.count() == 3


def test_pad_and_conform(spark):
    schema = schemas.struct_of("a int\nb string\nc decimal(38,2)")
    df = conform.conform_union([spark.createDataFrame([(1,)], "A int"), spark.createDataFrame([("x", 2)], "b string, c int")], schema)
    assert df.schema.simpleString() == schema.simpleString()
    assert rows(df) == [(1, None, None), (None, "x", Decimal("2.00"))]
    assert conform.conform(spark.createDataFrame([("1", 2, "3")], "x string, y int, z string"), schema, positional=True).first().c == Decimal(3)
    with pytest.raises(ValueError):
        conform.conform(df.select("a"), schema, positional=True)
    assert rows(conform.append_by_name(df.select("a", "b"), df.select("b", "a"))) == sorted(2 * [(1, None), (None, "x")], key=repr)


def test_billing_is_stored_in_whole_units_or_cents(spark):
    detail = spark.createDataFrame(
        [("g", "n1", "timesheet", Decimal("100.60"), None, "10", Decimal("2.00"), 20), ("g", "n2", "expense", Decimal("10.40"), 50, "10", Decimal("1.00"), None)],
        "K string, NAME string, TYPE string, TOT_AMT_BILLING decimal(38,2), SPLIT int, DISCOUNTPERCENT string, TOT_CNT_HOURS decimal(38,2), VAT int",
    )
    cents = aggregates.summarise_billing(detail, ["K"], "NAME", aggregates.CENTS).first()
    # VAT by the highest code of each spelling: none on the second; no discount on expenses.
    assert (cents.NAME, cents.TOT_AMT_INVOICED, cents.TOT_AMT_EXPENSES) == ("n2", Decimal("108.65"), Decimal("5.20"))
    whole = aggregates.summarise_billing(detail, ["K"]).first()
    assert (whole.TOT_AMT_INVOICED, whole.TOT_AMT_EXPENSES, whole.TOT_CNT_HOURS) == (109, 6, 3)


@pytest.mark.parametrize("previous, pct, tail", [(Decimal(80), 25.0, "25.0%"), (Decimal(0), None, "N/A"), (Decimal(-5), None, "N/A")])
def test_variance(spark, previous, pct, tail):
    df = spark.createDataFrame([(1, Decimal(1234)), (0, previous)], "p int, a decimal(18,2)")
    row = aggregates.period_variance(df.withColumn("a", F.when(F.col("p") == 1, F.lit(100)).otherwise(F.col("a"))), F.col("p") == 1, F.col("p") == 0, "a").first()
    assert row.VARIANCE_PCT == pct and row.MESSAGE.endswith(tail)


def test_small_aggregates(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 1)], "n string, v int")
    assert aggregates.joined_names(df, "n").first().NAMES == "a, b"
    assert tuple(aggregates.counts(df, {"ONES": F.col("v") == 1}).first()) == (3, 2)
    assert tuple(aggregates.counts(df, {}, value="v").first()) == (3, 2, 4)
    assert tuple(aggregates.counts(df.limit(0), {}, value="v").first()) == (0, None, 0)
    assert [r.n for r in aggregates.most_recent(df, [F.col("v").desc()], 1).collect()] == ["b"]
    assert [tuple(r) for r in aggregates.profile(df, ["n"], {"S": "v"}, ["n"]).collect()] == [("a", 2, 2), ("b", 1, 2)]
