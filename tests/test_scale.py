"""What keeps large tables off the driver, a single task and the disk."""

import os
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from flowtables import schemas, session
from flowtables.harness import billing
from flowtables.operators import joins
from flowtables.plans import invoice_index, movement_state, revenue
from flowtables.plans.invoice_index import InvoiceIndex
from flowtables.plans.movement_state import MovementState
from flowtables.sinks import exports
from flowtables.sinks.tables import append_table, ensure_table
from flowtables.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_side_found_too_large_is_never_broadcast(spark, folder):
    # Packed columns are small on disk, which is what Spark's planner goes by.
    spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v")).write.parquet(f"{folder}/right")
    right = spark.read.parquet(f"{folder}/right")
    left = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    out = joins.join_unique(left, right, ["k"], limit=-1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(out) == sorted([("1", "v"), ("2", "v"), (None, None)], key=repr)


def test_only_hot_keys_are_repeated(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    left = spark.createDataFrame([(i, "hot" if i < 50 else None if i < 90 else f"k{i}") for i in range(120)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k95", 2), ("none", 3), (None, 4)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert rows(joins.salted_join(left, right, ["k"], how)) == rows(left.join(right, ["k"], how))
    # Keys of different types meet as Spark compares them.
    numbers = left.select("id", F.when(F.col("id") < 50, 7).otherwise(F.col("id")).alias("n"))
    longs = spark.createDataFrame([(7, "seven"), (60, "sixty")], "n bigint, v string")
    assert rows(joins.salted_join(numbers, longs, ["n"], "left")) == rows(numbers.join(longs, ["n"], "left"))


def test_exported_array_is_read_by_many_tasks(spark, folder):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('a]},{"[\n, '), "id")).alias("t"))
    schema = files.json_schema(["id", "t"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for single in (True, False):
            path = exports.export_json_array(df, folder, f"{single}.json", single_file=single).path
            read = files.read_array_lines(spark, path, schema)
            assert read.rdd.getNumPartitions() > 1
            assert rows(read) == rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    none = exports.export_json_array(df.limit(0), folder, "none.json").path
    assert files.read_array_lines(spark, none, schema).count() == 0


def test_compressed_parts_hold_the_same_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(exports, "_PACKED_ROWS", 100)
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, 'say "hi",').alias("t"), *[F.lit(None).cast("string").alias(f"n{i}") for i in range(30)])
    sizes = {}
    for kind in ("none", "gzip"):
        path = exports.export_csv(df, folder, f"{kind}.csv", single_file=False, null_value="NULL", compression=kind).path
        parts = [f"{path}/{n}" for n in os.listdir(path) if n.startswith("part-")]
        sizes[kind] = sum(map(os.path.getsize, parts)) / 1000
        assert rows(files.read_typed_csv(spark, path, df.schema)) == rows(df)
    assert len(parts) >= 10 and sizes["gzip"] < sizes["none"] / 5


def test_shuffles_and_scratch_go_with_the_work(spark):
    def shuffled():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    def counted():
        return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()

    with session.staging(spark) as stage:
        before = shuffled()
        assert stage(counted(), "a").count() == 7
        for _ in range(50):
            if shuffled() <= before:
                break
            import time

            time.sleep(0.1)
        assert shuffled() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with session.scratch_scope(spark):
        path = session.scratch_path(spark, "x")
        assert session.staged(counted(), path=path).count() == 7 and os.path.isdir(path)
    assert not os.path.exists(path) and "scope-" not in session.scratch_path(spark, "y")


def test_wide_files_are_loaded_by_methods_the_jvm_compiles(spark, db, folder, monkeypatch):
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)
    inner = revenue.replace_period
    monkeypatch.setattr(revenue, "replace_period", lambda *a: (seen.append(spark.conf.get(key)), inner(*a))[1])
    path = exports.export_csv(schemas.pad_to(spark.range(3).select(F.col("id").alias("invoiceid")), schemas.INVOICE_ITEM), folder, "i.csv", single_file=False, null_value="NULL").path
    assert revenue.load_file_once(spark, path, schemas.INVOICE_ITEM, f"{db}.items", "A", "2026_02").rows == 3
    assert seen == ["8000"] and spark.conf.get(key) == before
    with session.staging(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == before


def test_detail_is_not_shuffled_where_few_deliveries_were_superseded(spark, db, monkeypatch):
    def detail(period, invoices):
        own = [(i, "2026_01" if i < 4 else period, 2026, 1 if i < 4 else 2) for i in invoices]
        shape = "INVOICEID decimal(38,0), TYPE string, INVOICE_YEAR int, INVOICE_MONTH int, ROSTER_SYSTEM string, LOAD_PERIOD string"
        return spark.createDataFrame([(Decimal(i), t, y, m, "SYS", period) for i, t, y, m in own for _ in range(2)], shape)

    loads = {"2026_01": detail("2026_01", [1, 2, 3, 5]), "2026_02": detail("2026_02", [2, 6])}
    ensure_table(spark, f"{db}.detail", loads["2026_01"].schema, ["ROSTER_SYSTEM", "LOAD_PERIOD"])
    for rows_of_load in loads.values():
        append_table(rows_of_load, f"{db}.detail")
    index, months = InvoiceIndex(spark, f"{db}.index", f"{db}.detail", "SYS"), [date(2026, 1, 1), date(2026, 2, 1)]
    deliveries = session.staged(index.deliveries(months))
    want = [(i, p) for p, own in (("2026_01", [1, 3, 5]), ("2026_02", [2, 6])) for i in own for _ in range(2)]

    def found():
        return sorted((int(r.INVOICEID), r.LOAD_PERIOD) for r in index.standing(months, deliveries).collect())

    assert found() == sorted(want)
    plan = index.standing(months, deliveries)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(invoice_index, "fits_broadcast", lambda df: False)
    assert found() == sorted(want)


def test_movement_of_new_keys_needs_no_history(spark, db, monkeypatch):
    state = MovementState(f"{db}.rows", f"{db}.last", ("k", "c"), "stamp", "v")
    shape = "k string, c string, stamp date, v decimal(18,2)"

    def frame(*found):
        return spark.createDataFrame([(k, c, date(2026, m, 3), Decimal(v)) for k, c, m, v in found], shape)

    state.advance(spark, frame(("a", None, 1, 10), ("b", "x", 1, 5), ("b", "x", 2, 7)))
    plans, inner = {}, session.staged

    def seen(df, label="stage", path=None):
        plans[path.rpartition("-")[2]] = df._jdf.queryExecution().executedPlan().toString()
        return inner(df, label, path)

    monkeypatch.setattr(session, "staged", seen)
    state.advance(spark, frame(("c", None, 1, 3), ("c", None, 2, 4)))
    assert "SortMergeJoin" not in plans["moved"] + plans["after"] and "merged" not in plans
    # A corrected month of c, and a value of b that ties by date and loses to the smaller one; by shuffled joins.
    more = [("c", None, 3, 9), ("b", "x", 2, 8), ("c", None, 1, 2), ("d", "y", 2, 1)]
    monkeypatch.setattr(movement_state, "fits_broadcast", lambda df: False)
    state.advance(spark, frame(*more))
    got = sorted((r.k, r.STATE_MONTH.month, int(r.v), r.STATE_BEFORE and int(r.STATE_BEFORE)) for r in spark.table(state.rows).collect())
    assert got == [("a", 1, 10, None), ("b", 1, 5, None), ("b", 2, 7, 5), ("c", 1, 2, None), ("c", 2, 4, 2), ("c", 3, 9, 4), ("d", 2, 1, None)]
    last = {r.k: (r.LAST_MONTH.month, int(r.LAST_VALUE)) for r in spark.table(state.last).collect()}
    assert last["a"] == (1, 10) and last["c"] == (3, 9) and last["d"] == (2, 1) and len(last) == 4


def test_revenue_chain_is_worked_out_once(spark, folder, monkeypatch):
    days = "timestamp_ntz"
    made = {
        "nation": spark.createDataFrame([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": spark.createDataFrame([(1, "Supplier#000000001", 0, 9000.0), (2, "Supplier#000000002", 1, 1.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
        "orders": spark.createDataFrame(
            [(k, k, "OFP"[k % 3], 10.5 * k, f"{1998 + k % 3}-03-0{k}", "5-LOW") for k in range(1, 7)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, d string, o_orderpriority string",
        ).withColumn("o_orderdate", F.col("d").cast(days)).drop("d"),
        "lineitem": spark.createDataFrame(
            [(k, n, k % 3, n, 2.0, 7.25 * k, 0.05, 0.0, "ARN"[n % 3], "OF"[k % 2], f"{1999 + n % 2}-0{n}-11") for k in range(1, 7) for n in range(1, 5)],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, d string",
        ).withColumn("l_shipdate", F.col("d").cast(days)).drop("d"),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    want = rows(billing.revenue_master(spark, folder))
    assert want
    # A lookup that is too large to broadcast counts the rows of its other side beforehand.
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, limit=0: False)
    out = billing.revenue_master(spark, folder)
    assert not any("lineitem.parquet" in f or "orders.parquet" in f for f in out.inputFiles())
    assert rows(out) == want
    staged = []
    found = billing.snapshots(spark, folder)
    steps = revenue.snapshot_detail(found, stage=lambda df, label: staged.append(label) or session.staged(df, label))
    assert rows(steps) == rows(revenue.snapshot_detail(found)) and staged == ["monthly"]


def test_null_tokens_mean_the_same_wherever_they_are_resolved(spark, folder):
    with open(f"{folder}/x.csv", "w") as f:
        f.write('a,b,c\n"NULL",NULL,null\n"",," NULL "\n"null"," null ",x\n  ,"  ",NULL x\n1,"2""q",NULL\n')
    schema = schemas.struct_of("a string\nb string\nc string")

    def read(*tokens):
        return [tuple(r) for r in files.read_typed_csv(spark, f"{folder}/x.csv", schema, tokens).collect()]

    n = None
    assert read("", "NULL", "null") == [(n, n, n), (n, n, n), (n, n, "x"), (n, n, "NULL x"), ("1", '2"q', n)]
    assert read("NULL") == [(n, n, "null"), (n, n, n), ("null", "null", "x"), (n, "", "NULL x"), ("1", '2"q', n)]
    # Fields of the token never become text: the reader gives NULL already.
    plan = files.read_typed_csv(spark, f"{folder}/x.csv", schema)._jdf.queryExecution().analyzed().collectLeaves().head().relation().options()
    assert plan.apply("nullValue") == "NULL"
