"""Files and tables written and read back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables import schemas
from flowtables.functions.text import blank_if_null
from flowtables.harness.billing import headers, items
from flowtables.harness.registry import money, ntz, number, own_database, query, table
from flowtables.operators.delta import mark_processed, new_files, rows_of_new_files
from flowtables.operators.windows import keep_latest, latest_first
from flowtables.operators.aggregates import CENTS
from flowtables.plans.revenue import load_files, refine_lines
from flowtables.plans.rules import Region, RevenueConfig
from flowtables.session import scratch_path, staged
from flowtables.sinks.exports import export_csv, export_json_array
from flowtables.sinks.tables import append_table, create_view, ensure_table, prune, replace_period, replace_table, rewrite_if_nonempty
from flowtables.sources.files import json_schema, list_files, project_json, project_variant, read_array_lines, read_json_array, read_typed_csv
from flowtables.sources.tables import snapshot_period, snapshot_table, union_periods
from flowtables.streaming.ingest import ingest_files_stream, read_landed

ORDER_FILE = schemas.struct_of("""
    o_orderkey bigint
    o_custkey bigint
    o_orderstatus string
    o_totalprice decimal(18,2)
    o_orderdate timestamp_ntz
    o_orderpriority string
""")


@query("typed_csv_scan", sql="""
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderdate,
           nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders
""")
def typed_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    # Padding, quotes around everything and a NULL token, as the sending system writes them.
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("o_orderstatus"),
        money("o_totalprice").alias("o_totalprice"), "o_orderdate",
        F.when(F.col("o_orderpriority") == "5-LOW", "null").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    export = export_csv(orders, scratch_path(spark, "csv"), "orders.csv", single_file=False, null_value="NULL")
    return read_typed_csv(spark, export.path, ORDER_FILE).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("json_array_scan", sql="""
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type,
           json_extract_string(props, '$.k') AS k, '' AS absent
    FROM events
""")
def json_array_scan(spark: SparkSession, sf: str) -> DataFrame:
    # One array per line, some elements with an explicit null.
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"), kind, "props")
    folder = scratch_path(spark, "json")
    rows.select(
        F.concat(F.lit("["), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), F.lit("]"))
    ).write.text(folder)
    read = read_json_array(spark, folder, json_schema(["event_id", "event_type", "props"], ["ts"]), multi_line=False)
    typed = project_json(read, ["event_id", "event_type", "props"], ["ts"])
    fields = project_variant(typed, "PROPS", ["k", "absent"], [], keep=["EVENT_ID", "TS", "EVENT_TYPE"])
    return fields.toDF(*[c.lower() for c in fields.columns])


@query("file_ledger_delta", sql="SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def file_ledger_delta(spark: SparkSession, sf: str) -> DataFrame:
    events, cut = table(spark, sf, "events"), ntz("2024-01-16 00:00:00")
    folder = scratch_path(spark, "ledger")
    events.filter(F.col("ts") < cut).write.parquet(folder)
    ledger = spark.createDataFrame([], schemas.FILE_LEDGER)
    arrived = new_files(list_files(spark, folder, "*.parquet"), ledger, "part-")
    ledger = staged(mark_processed(ledger, arrived, datetime(2024, 1, 16)), "ledger")
    events.filter(F.col("ts") >= cut).write.mode("append").parquet(folder)
    fresh = new_files(list_files(spark, folder, "*.parquet"), ledger, "part-")
    rows = spark.read.schema(events.schema).parquet(folder).select("*", F.col("_metadata.file_name").alias("file_name"))
    return rows_of_new_files(rows, fresh).select(*events.columns)


@query("stream_autoingest", sql="""
    SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type, value, props
    FROM events
""")
def stream_autoingest(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type")
    events = table(spark, sf, "events").select("event_id", "ts", kind, "value", "props")
    folder, checkpoint, target = (scratch_path(spark, n) for n in ("inbox", "checkpoint", "landing"))
    schema = schemas.struct_of("event_id string\nts string\nevent_type string\nvalue string\nprops string")
    cut = ntz("2024-01-16 00:00:00")
    # Two arrivals and one call in between with nothing new: every file is loaded once.
    for arrived in (F.col("ts") < cut, F.lit(False), F.col("ts") >= cut):
        texts = events.filter(arrived).select(*[F.col(c).cast("string").alias(c) for c in events.columns])
        texts.write.mode("append").options(header=True, nullValue="", escape='"').csv(folder)
        ingest_files_stream(spark, folder, schema, checkpoint, target)
    landed = read_landed(spark, target)
    return landed.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("value", F.col("value").cast("double"))


@query("stream_multiline", sql=r"""
    WITH e AS (SELECT CAST(event_id AS VARCHAR) AS event_id, ts,
                      event_type || CASE WHEN event_id % 3 = 0 THEN E'\n"in", the middle' ELSE '' END AS event_type, value,
                      props || CASE event_id % 5 WHEN 0 THEN E'\r\n\nat the end' ELSE '' END AS props,
                      event_id % 8 < 2 AND event_id % 97 < 3 AS torn FROM events)
    SELECT event_id, ts, event_type, value, props, false AS rejected FROM e
    UNION ALL SELECT 'torn-' || event_id, NULL, NULL, NULL, '"never closed', true FROM e WHERE torn
""")
def stream_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of several lines, and in some files lines with a quote that is never closed."""
    k = F.col("event_id")

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    kind = F.concat("event_type", F.when(k % 3 == 0, '\n"in", the middle').otherwise(""))
    props = F.concat("props", F.when(k % 5 == 0, "\r\n\nat the end").otherwise(""))
    line = F.concat_ws(",", k.cast("string"), F.col("ts").cast("string"), quoted(kind), F.col("value").cast("string"), quoted(props))
    torn = F.when((k % 8 < 2) & (k % 97 < 3), F.concat(F.lit("\ntorn-"), k.cast("string"), F.lit(',,,,"never closed'))).otherwise("")
    rows = table(spark, sf, "events").select("ts", (k % 8).cast("int").alias("part"), k.alias("n"), F.concat(line, torn).alias("value"))
    folder, checkpoint, target = (scratch_path(spark, n) for n in ("inbox", "checkpoint", "landing"))
    schema = schemas.struct_of("event_id string\nts string\nevent_type string\nvalue string\nprops string")
    heads = spark.range(8).select(F.col("id").cast("int").alias("part"), F.lit(-1).cast("long").alias("n"), F.lit(",".join(schema.names)).alias("value"))
    for early in (True, False):
        part = rows.filter((F.col("ts") < ntz("2024-01-16 00:00:00")) == early).drop("ts").unionByName(heads)
        part.repartition("part").sortWithinPartitions("part", "n").select("part", "value").write.mode("append").partitionBy("part").text(folder)
        ingest_files_stream(spark, folder, schema, checkpoint, target)
    good, bad = read_landed(spark, target).withColumn("rejected", F.lit(False)), read_landed(spark, f"{target}_rejected")
    # A line that was set aside is one text; here it is cut where its first field ends.
    cut = bad.select(F.substring_index("line", ",", 1).alias("event_id"), F.lit(None).cast("string").alias("ts"), F.lit(None).cast("string").alias("event_type"),
                     F.lit(None).cast("string").alias("value"), F.substring_index("line", ",", -1).alias("props"), F.lit(True).alias("rejected"))
    return good.unionByName(cut).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("value", F.col("value").cast("double"))


@query("union_period_tables", sql="SELECT *, 'loaded then skipped' AS status FROM orders")
def union_period_tables(spark: SparkSession, sf: str) -> DataFrame:
    db, orders = own_database(spark, "periods"), table(spark, sf, "orders")
    bounds = orders.agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    statuses = []
    for year in range(bounds.first, bounds.last + 1):
        start, end = ntz(f"{year}-01-01 00:00:00"), ntz(f"{year + 1}-01-01 00:00:00")
        orders.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).createOrReplaceTempView(f"ft_shared_{year}_1")
        for _ in range(2):
            statuses.append(snapshot_period(spark, "ft_shared_", f"{db}.orders_", date(year, 2, 1)).status)
        spark.catalog.dropTempView(f"ft_shared_{year}_1")
    orders.createOrReplaceTempView("ft_shared_all")
    snapshot_table(spark, "ft_shared_all", f"{db}.orders_HISTORY")
    spark.catalog.dropTempView("ft_shared_all")
    in_turn = statuses == ["SUCCESS", "SKIPPED"] * (len(statuses) // 2)
    return union_periods(spark, f"{db}.orders_").withColumn("status", F.lit("loaded then skipped" if in_turn else "wrong"))


@query("monthly_loads", sql="""
    WITH headers AS (
        SELECT CASE WHEN o_orderstatus = 'O' THEN 'A' ELSE 'B' END AS region, o_orderkey AS id FROM orders
        UNION ALL SELECT 'A', o_orderkey FROM orders WHERE o_orderstatus = 'O')
    SELECT 'header' AS kind, region, count(*) AS cnt, CAST(sum(id) AS DOUBLE) AS total, 'SKIPPED' AS second_run FROM headers GROUP BY 2
    UNION ALL
    SELECT 'item', CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'B' END, count(*), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 'SKIPPED'
    FROM lineitem GROUP BY 2
""")
def monthly_loads(spark: SparkSession, sf: str) -> DataFrame:
    db, folder = own_database(spark, "loads"), scratch_path(spark, "monthly")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("invoiceid"), "o_orderstatus")
    status = headers(spark, sf).join(orders, "invoiceid").withColumn("__a", F.col("o_orderstatus") == "O")
    lines = items(spark, sf).withColumn("__a", F.col("jobtypegroupname") == "O")
    for kind, rows, schema in (("header", status, schemas.INVOICE_HEADER), ("item", lines, schemas.INVOICE_ITEM)):
        for region, chosen in (("A", F.col("__a")), ("B", ~F.col("__a"))):
            export_csv(schemas.pad_to(rows.filter(chosen), schema), folder, f"{region}_{kind}_2026_02.csv", single_file=False, null_value="NULL", compression="gzip")
    cfg = RevenueConfig(
        regions=(Region("A", "SYS-A"), Region("B", "SYS-B")), landing=folder,
        header_table=f"{db}.invoice_header", item_table=f"{db}.invoice_item",
    )
    load_files(spark, cfg, date(2026, 3, 1))
    again = load_files(spark, cfg, date(2026, 3, 15))
    second = "SKIPPED" if again.count("SKIPPED") == 4 else again

    def totals(kind: str, value) -> DataFrame:
        loaded = spark.table(f"{db}.invoice_{kind}")
        return loaded.groupBy("region").agg(F.count("*").alias("cnt"), number(F.sum(value), "total")).select(
            F.lit(kind).alias("kind"), "region", "cnt", "total", F.lit(second).alias("second_run")
        )

    return totals("header", "invoiceid").unionByName(totals("item", "billing"))


@query("late_invoices", sql="""
    WITH sent AS (
        SELECT o_orderkey, o_custkey % 25 AS branchid, o_orderpriority AS funder,
               CASE WHEN o_orderstatus = 'P' THEN (o_orderkey + 7) % 56 ELSE o_orderkey % 56 END AS day
        FROM orders)
    SELECT CAST(branchid AS BIGINT) AS branchid, CASE WHEN day < 28 THEN 2 ELSE 3 END AS invoice_month, funder, l_linestatus AS category,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS invoiced
    FROM sent JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4
""")
def late_invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Two file months, each with invoices dated in the other, and invoices that both deliver with other dates."""
    db, folder = own_database(spark, "late"), scratch_path(spark, "late")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("invoiceid"), "o_custkey", "o_orderpriority", "o_orderstatus")
    status = F.col("o_orderstatus")
    for period, chosen, shift in (("2026_02", status != "O", 0), ("2026_03", status != "F", F.when(status == "P", 7).otherwise(0))):
        sent = orders.filter(chosen)
        day = F.pmod(F.col("invoiceid") + F.lit(shift), F.lit(56)).cast("int")
        head = sent.select(
            "invoiceid", (F.col("o_custkey") % 25).alias("branchid"), F.concat(F.lit("Branch "), (F.col("o_custkey") % 25).cast("string")).alias("branchname"),
            F.date_add(F.lit(date(2026, 2, 1)), day).cast("timestamp_ntz").alias("created"), F.col("o_orderpriority").alias("jobtypename"),
        )
        lines = table(spark, sf, "lineitem").join(sent.select(F.col("invoiceid").alias("l_orderkey")), "l_orderkey", "left_semi").select(
            F.col("l_orderkey").alias("invoiceid"), F.lit("timesheet").alias("type"), money("l_extendedprice").alias("billing"),
            money("l_quantity").alias("invoicehrs"), F.col("l_linestatus").alias("jobtypegroupname"),
        )
        for kind, rows, schema in (("header", head, schemas.INVOICE_HEADER), ("item", lines, schemas.INVOICE_ITEM)):
            export_csv(schemas.pad_to(rows, schema), folder, f"A_{kind}_{period}.csv", single_file=False, null_value="NULL", compression="gzip")
    cfg = RevenueConfig(
        regions=(Region("A", "SYS-A"),), landing=folder, amount_type=CENTS, header_table=f"{db}.invoice_header", item_table=f"{db}.invoice_item",
        line_detail=f"{db}.line_detail", line_index=f"{db}.line_index", line_summary=f"{db}.line_summary",
    )
    for as_of, month in ((date(2026, 3, 1), date(2026, 2, 1)), (date(2026, 4, 1), date(2026, 3, 1))):
        load_files(spark, cfg, as_of)
        refine_lines(spark, cfg, "A", month)
    refine_lines(spark, cfg, "A", date(2026, 2, 1))  # a rerun of the earlier load changes nothing
    return spark.table(cfg.line_summary).select(
        F.col("BRANCHID").cast("bigint").alias("branchid"), F.col("INVOICE_MONTH").alias("invoice_month"), F.col("FUNDER_TYPE").alias("funder"),
        F.col("CATEGORY_OF_CARE").alias("category"), number("TOT_AMT_INVOICED", "invoiced"),
    )


@query("export_json_array", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey FROM customer
""")
def exported_json(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).alias("c_nationkey"),
    )
    export = export_json_array(customers, scratch_path(spark, "outbox"), "customers.json")
    return read_array_lines(spark, export.path, json_schema(customers.columns))


@query("prune_log", sql="SELECT event_id, ts, event_type, CAST(NULL AS VARCHAR) AS note FROM events WHERE ts >= TIMESTAMP '2024-01-20' OR event_type <> 'error'")
def pruned(spark: SparkSession, sf: str) -> DataFrame:
    log = f"{own_database(spark, 'log')}.task_log"
    ensure_table(spark, log, schemas.struct_of("event_id bigint\nts timestamp_ntz"))
    ensure_table(spark, log, schemas.struct_of("event_id bigint\nts timestamp_ntz\nevent_type string\nnote string"))
    append_table(table(spark, sf, "events"), log)
    prune(spark, log, "ts", 3, date(2024, 1, 23), "error", "event_type")
    return spark.table(log)


@query("replace_period", sql="""
    SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS invoice_year, CAST(month(o_orderdate) AS INTEGER) AS invoice_month,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN year(o_orderdate) = 1997 AND month(o_orderdate) = 6 THEN 2 ELSE 1 END AS DOUBLE) AS amount
    FROM orders
""")
def replaced(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{own_database(spark, 'period')}.invoices"
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", money("o_totalprice").alias("amount"),
        F.year("o_orderdate").alias("invoice_year"), F.month("o_orderdate").alias("invoice_month"),
    )
    replace_table(rows, name, ["invoice_year", "invoice_month"])
    # The corrected feed holds every month; only June 1997 is due, and it is rebuilt twice.
    for _ in range(2):
        replace_period(rows.withColumn("amount", F.col("amount") * 2), name, {"invoice_year": 1997, "invoice_month": 6})
    return create_view(spark.table(name), "ft_invoices", ["o_orderkey", "o_custkey", "invoice_year", "invoice_month", "amount"]).withColumn(
        "amount", F.col("amount").cast("double")
    )


@query("rewrite_if_nonempty", sql="""
    SELECT l_orderkey, l_linenumber, l_shipdate, coalesce(l_returnflag, '') AS l_returnflag FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS FIRST, l_returnflag DESC NULLS FIRST) = 1
""")
def rewritten(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{own_database(spark, 'swap')}.hired"
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    replace_table(lines, name)
    order = [latest_first("l_shipdate"), latest_first(blank_if_null("l_returnflag"))]
    rewrite_if_nonempty(keep_latest(spark.table(name), ["l_orderkey", "l_linenumber"], order), name)
    rewrite_if_nonempty(spark.table(name).filter("l_orderkey IS NULL"), name)
    return spark.table(name)
