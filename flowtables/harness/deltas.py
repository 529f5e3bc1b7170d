"""Deltas, merges, outbox stamps and small aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.functions.dates import day_first_timestamp, retype_column, same_year
from flowtables.functions.text import row_hash
from flowtables.harness.registry import money, ntz, number, query, table
from flowtables.operators.aggregates import counts, joined_names, most_recent
from flowtables.operators.conform import append_by_name
from flowtables.operators.delta import after_watermark, conform_names, hash_delta, high_watermark, retry_unmapped, tracked_delta
from flowtables.operators.filters import pending
from flowtables.operators.joins import enrich, lookup_by_key, new_rows
from flowtables.operators.merge import mark_sent, merge_insert, merge_upsert, resend, update_from
from flowtables.session import staged

STAMP = datetime(2024, 2, 1, 9, 30)


@query("enrich_outbox", sql="""
    SELECT CAST(o_orderkey AS VARCHAR) AS object_id, CAST(o_orderstatus AS VARCHAR) AS status, 'Active' AS customer_status,
           c_mktsegment AS portal
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderdate >= TIMESTAMP '1997-01-01'
""")
def enrich_outbox(spark: SparkSession, sf: str) -> DataFrame:
    # An order counts as sent when it is older than 1997.
    orders = table(spark, sf, "orders").withColumn(
        "sent_at", F.when(F.col("o_orderdate") < ntz("1997-01-01 00:00:00"), F.col("o_orderdate"))
    )
    batch = pending(orders, "O", ["1-URGENT", "5-LOW"], "o_orderstatus", "o_orderpriority", "sent_at")
    joined = enrich(batch, table(spark, sf, "customer"), ("o_custkey", "c_custkey"), ["c_mktsegment"])
    sent = conform_names(joined, {"object_id": "o_orderkey", "status": "o_orderstatus", "portal": "c_mktsegment"})
    return sent.withColumn("customer_status", F.lit("Active"))


@query("anti_new_rows", sql="""
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END)
""")
def anti_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    # Building customers carry a NULL key: it is never found, so they are always new.
    key = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("key")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", key)
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    return new_rows(customers, orders, ["key"]).select("c_custkey", "c_name")


@query("watermark_delta", sql="""
    WITH loaded AS (SELECT * FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20')
    SELECT event_id, ts, event_type, value, 'old' AS history FROM events e
    WHERE ts >= coalesce((SELECT max(ts) FROM loaded), TIMESTAMP '1900-01-01')
      AND NOT EXISTS (SELECT 1 FROM loaded l WHERE l.event_id = e.event_id AND l.ts = e.ts)
    UNION ALL
    SELECT event_id, ts, event_type, value, 'none' FROM events
""")
def watermark_delta(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    loaded = events.filter((F.col("event_type") == "click") & (F.col("ts") < ntz("2024-01-20 00:00:00")))
    empty = events.filter(F.lit(False))
    after = after_watermark(events, "ts", high_watermark(loaded, "ts"), loaded, ["event_id"])
    first = after_watermark(events, "ts", high_watermark(empty, "ts"))
    return after.withColumn("history", F.lit("old")).unionByName(first.withColumn("history", F.lit("none")))


@query("tracked_delta", sql="""
    WITH texts AS (
        SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 'not a date'
               ELSE concat(CAST(day(ts) AS VARCHAR), '/', CAST(month(ts) AS VARCHAR), '/', CAST(year(ts) AS VARCHAR), ' ',
                           CAST(hour(ts) AS VARCHAR), ':', lpad(CAST(minute(ts) AS VARCHAR), 2, '0')) END AS status_text
        FROM events)
    SELECT event_id, status_text, try_strptime(status_text, '%d/%m/%Y %H:%M') AS status_ts,
           strftime(try_strptime(status_text, '%d/%m/%Y %H:%M'), '%d/%m/%Y') AS day_text
    FROM texts
    WHERE try_strptime(status_text, '%d/%m/%Y %H:%M') > TIMESTAMP '2024-01-12 00:00:00'
""")
def tracked(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat_ws(
        " ",
        F.concat_ws("/", F.dayofmonth("ts"), F.month("ts"), F.year("ts")),
        F.concat_ws(":", F.hour("ts"), F.lpad(F.minute("ts").cast("string"), 2, "0")),
    )
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "not a date").otherwise(text).alias("status_text")
    )
    # The tracking table: one successful run, one later failed run that must not count.
    runs = table(spark, sf, "region").select(
        F.when(F.col("r_regionkey") == 0, ntz("2024-01-12 00:00:00")).otherwise(ntz("2024-01-25 00:00:00")).alias("MAX_DATE"),
        F.when(F.col("r_regionkey") == 0, "SUCCESS").otherwise("RETRY").alias("STATUS"),
    )
    found = tracked_delta(events, runs, day_first_timestamp("status_text"), "status_ts")
    return retype_column(found.withColumn("day_text", F.col("status_ts").cast("date")), "day_text")


@query("retry_unmapped", sql="""
    WITH first_try AS (
        SELECT c_custkey, c_nationkey, n_name AS roster_system FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 2),
    again AS (
        SELECT c_custkey, c_nationkey, n_name AS roster_system FROM first_try f JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 4
        WHERE f.roster_system IS NULL)
    SELECT * FROM first_try WHERE roster_system IS NOT NULL UNION ALL SELECT * FROM again
""")
def retried(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("k"), F.col("n_name").alias("roster_system"), "n_regionkey"
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    key = F.col("c_nationkey").cast("string")
    first = lookup_by_key(customers, nation.filter("n_regionkey < 2"), key, "k", ["roster_system"])
    again = retry_unmapped(first, nation.filter("n_regionkey < 4"), key, "k", "roster_system")
    mapped = first.filter(F.col("roster_system").isNotNull())
    return append_by_name(mapped, again.select("roster_system", "c_nationkey", "c_custkey"))


# Target: customers, some with a NULL or blank second key. Source: the latest order of each
# customer as a change, with the other spelling of the blank, and all suppliers as new rows.
@query("merge_upsert", sql="""
    WITH target AS (
        SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END AS seg,
               c_name AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS amount FROM customer),
    source AS (
        SELECT o_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS seg,
               concat('order ', CAST(max(o_orderkey) AS VARCHAR)) AS name, max(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
        UNION ALL
        SELECT -1 - s_suppkey, NULL, s_name, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier)
    SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NOT NULL THEN coalesce(t.seg, '<null>') ELSE coalesce(s.seg, '<null>') END AS seg,
           coalesce(t.name, s.name) AS name, CAST(coalesce(s.amount, t.amount) AS DOUBLE) AS amount
    FROM target t FULL JOIN source s ON t.id = s.id AND coalesce(t.seg, '') = coalesce(s.seg, '')
""")
def merged(spark: SparkSession, sf: str) -> DataFrame:
    customer, segment = table(spark, sf, "customer"), F.col("c_mktsegment")
    target = customer.select(
        F.col("c_custkey").alias("id"),
        F.when(segment == "BUILDING", F.lit(None)).when(segment == "MACHINERY", "").otherwise(segment).alias("seg"),
        F.col("c_name").alias("name"), money("c_acctbal").alias("amount"),
    )
    # Reduced per customer before the join, so an active customer does not weigh it down.
    changes = (
        table(spark, sf, "orders").groupBy("o_custkey")
        .agg(F.max("o_orderkey").alias("last"), F.max(money("o_totalprice")).alias("amount"))
        .join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
        .select(
            F.col("o_custkey").alias("id"),
            F.when(segment == "BUILDING", "").when(segment == "MACHINERY", F.lit(None)).otherwise(segment).alias("seg"),
            F.concat(F.lit("order "), F.col("last").cast("string")).alias("name"), "amount",
        )
    )
    new = table(spark, sf, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("id"), F.lit(None).cast("string").alias("seg"), F.col("s_name").alias("name"),
        money("s_acctbal").alias("amount"),
    )
    source = staged(changes.unionByName(new), "merge-source")
    result = merge_upsert(target, source, ["id", "seg"], ["amount"], blank_null=["seg"])
    return result.select("id", F.coalesce("seg", F.lit("<null>")).alias("seg"), "name", number("amount", "amount"))


@query("merge_insert_only", sql="""
    WITH stored AS (SELECT event_id, ts, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16')
    SELECT * FROM stored
    UNION ALL
    SELECT DISTINCT event_id, ts, event_type FROM events e
    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'
      AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.event_id = e.event_id AND s.ts = e.ts)
""")
def inserted(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    stored = events.filter(F.col("ts") < ntz("2024-01-16 00:00:00"))
    # The feed delivers everything again, twice.
    delivered = events.unionAll(events).filter(same_year("ts", datetime(2024, 1, 31)))
    return merge_insert(stored, delivered, ["event_id", "ts"])


@query("update_from", sql="""
    SELECT c_custkey, c_name, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, p) AS c_mktsegment
    FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def updated(spark: SparkSession, sf: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    target = table(spark, sf, "customer").select("c_custkey", "c_name", segment.alias("c_mktsegment"))
    source = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"))
    return update_from(target, source, "c_custkey", ["c_mktsegment"], F.col("c_mktsegment").isNull())


@query("mark_sent", sql="""
    WITH state AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN o_orderdate END AS sent_at FROM orders),
    marked AS (SELECT o_orderkey, o_orderstatus, CASE WHEN sent_at IS NULL AND o_orderstatus = 'O' THEN TIMESTAMP '2024-02-01 09:30:00' ELSE sent_at END AS sent_at FROM state)
    SELECT o_orderkey, o_orderstatus, sent_at, 'sent' AS step FROM marked
    UNION ALL
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' AND sent_at = TIMESTAMP '2024-02-01 09:30:00' THEN NULL ELSE sent_at END, 'reset' FROM marked
""")
def marked(spark: SparkSession, sf: str) -> DataFrame:
    state = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderdate") < ntz("1997-01-01 00:00:00"), F.col("o_orderdate")).alias("sent_at"),
    )
    batch = pending(state, "O", system_col="o_orderstatus", stamp_col="sent_at")
    sent = mark_sent(state, batch, ["o_orderkey"], STAMP, "sent_at")
    reset = resend(sent, "O", STAMP, "o_orderstatus", "sent_at")
    return sent.withColumn("step", F.lit("sent")).unionByName(reset.withColumn("step", F.lit("reset")))


@query("row_hash_delta", sql="""
    WITH hashed AS (
        SELECT c_custkey, c_name, c_mktsegment, md5(concat_ws('|', CAST(c_custkey AS VARCHAR), coalesce(c_name, ''), coalesce(c_mktsegment, ''))) AS row_hash
        FROM (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)),
    history AS (
        SELECT md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS row_hash FROM customer WHERE c_acctbal > 0)
    SELECT * FROM hashed WHERE row_hash NOT IN (SELECT row_hash FROM history)
""")
def hashed(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    history = customer.filter("c_acctbal > 0").select(row_hash(cols).alias("row_hash"))
    changed = customer.select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment")
    )
    return hash_delta(changed.unionAll(changed), history, cols, "row_hash")


@query("recent_top_n", sql="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS sent_at FROM orders
    ORDER BY sent_at DESC NULLS LAST, o_orderkey LIMIT 20
""")
def recent(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("sent_at")
    )
    return most_recent(orders, [F.col("sent_at").desc_nulls_last(), F.col("o_orderkey").asc()], 20)


@query("ordered_names", sql="""
    SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names
    FROM (SELECT DISTINCT n_regionkey, n_name FROM nation JOIN customer ON c_nationkey = n_nationkey) GROUP BY 1
""")
def ordered_names(spark: SparkSession, sf: str) -> DataFrame:
    used = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    return joined_names(table(spark, sf, "nation").join(used, "n_nationkey"), "n_name", ["n_regionkey"], out="names")


@query("global_counts", sql="""
    SELECT 'events' AS source, count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS valid,
           CAST(max(value) AS DOUBLE) AS largest, CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS DOUBLE) AS summed FROM events
    UNION ALL
    SELECT 'labels', count(*), count(*) FILTER (WHERE quality = 1), CAST(max(toxic) AS DOUBLE), CAST(coalesce(sum(toxic), 0) AS DOUBLE) FROM labels
    UNION ALL
    SELECT 'none', 0, 0, -1, 0
""")
def global_counts(spark: SparkSession, sf: str) -> DataFrame:
    def line(source: str, df: DataFrame, valid, value: str) -> DataFrame:
        totals = counts(df, {"valid": valid}, "total", value)
        peak = F.coalesce("MAX_VALUE", F.lit(-1))
        return totals.select(F.lit(source).alias("source"), "total", "valid", number(peak, "largest"), number("SUM_VALUE", "summed"))

    events = table(spark, sf, "events").withColumn("value", money("value"))
    labels = table(spark, sf, "labels")
    none = events.filter("event_type IS NULL")
    return (
        line("events", events, F.col("event_type") != "error", "value")
        .unionByName(line("labels", labels, F.col("quality") == 1, "toxic"))
        .unionByName(line("none", none, F.col("event_type") != "error", "value"))
    )
