"""Names, keys, mappings and predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.functions.dates import closed_months_only, month_text
from flowtables.functions.text import clean_name, compact_key, first_part, is_filled, join_key
from flowtables.functions.values import first_tagged, label_by_like, map_values
from flowtables.harness.registry import number, query, table
from flowtables.operators.filters import split_matched, unlike
from flowtables.operators.joins import lookup_by_key, map_codes

STRIP = ["(?:Unit|Kiosk) [0-9]+: "]
DROP = [" /archived"]
KEY_DROP = ["Unit 7:", "/archived"]

# Names as they come from two systems: prefixed, bracketed, with entities and suffix words.
RAW_NAMES = """
    SELECT 'supplier' AS kind, s_suppkey AS id,
           concat('Unit 7: (', s_name, ') &amp; Sons /archived ') AS raw FROM supplier
    UNION ALL
    SELECT 'part' AS kind, p_partkey AS id,
           concat('Kiosk 31: ', p_name, ' & Co - ', p_brand, ' Unit 12: ') AS raw FROM part
"""


def raw_names(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
        F.concat(F.lit("Unit 7: ("), "s_name", F.lit(") &amp; Sons /archived ")).alias("raw"),
    )
    parts = table(spark, sf, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("id"),
        F.concat(F.lit("Kiosk 31: "), "p_name", F.lit(" & Co - "), "p_brand", F.lit(" Unit 12: ")).alias("raw"),
    )
    return suppliers.unionByName(parts)


@query("clean_names", sql=f"""
    WITH raw_names AS ({RAW_NAMES}), cleaned AS (
        SELECT kind, id, trim(regexp_replace(regexp_replace(
            replace(replace(raw, '&amp;', '&'), ' /archived', ''),
            '(?:Unit|Kiosk) [0-9]+: ', '', 'g'), '[()-]', '', 'g')) AS display_name
        FROM raw_names)
    SELECT kind, id, display_name,
           upper(replace(replace(trim(display_name), ' & ', ' AND '), ' ', '')) AS soft_key
    FROM cleaned
""")
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    named = raw_names(spark, sf).select("kind", "id", clean_name("raw", STRIP, DROP).alias("display_name"))
    return named.withColumn("soft_key", compact_key("display_name"))


@query("join_keys", sql=f"""
    WITH raw_names AS ({RAW_NAMES}), keyed AS (
        SELECT kind, id, raw, regexp_replace(replace(replace(replace(replace(
            upper(trim(raw)), '&AMP;', 'AND'), '&', 'AND'), 'UNIT 7:', ''), '/ARCHIVED', ''),
            '[^A-Z0-9]', '', 'g') AS hard_key
        FROM raw_names)
    SELECT kind, id, hard_key, trim(split_part(raw, '-', 1)) AS first_part
    FROM keyed WHERE hard_key IS NOT NULL AND hard_key <> ''
""")
def join_keys(spark: SparkSession, sf: str) -> DataFrame:
    keyed = raw_names(spark, sf).withColumn("hard_key", join_key("raw", KEY_DROP)).filter(is_filled("hard_key"))
    return keyed.select("kind", "id", "hard_key", first_part("raw").alias("first_part"))


@query("status_mapping", sql="""
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Active' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'FAST' WHEN o_orderpriority LIKE '2%' THEN 'QUICK'
                ELSE 'NORMAL' END AS system_label,
           CASE WHEN (CASE WHEN o_orderstatus = 'P' THEN 'Untagged' WHEN o_orderpriority = '5-LOW' THEN NULL
                           WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE 'North' END) IN ('', 'Untagged')
                  OR (CASE WHEN o_orderstatus = 'P' THEN 'Untagged' WHEN o_orderpriority = '5-LOW' THEN NULL
                           WHEN o_orderpriority = '3-MEDIUM' THEN '' ELSE 'North' END) IS NULL
                THEN o_orderpriority ELSE 'North' END AS company
    FROM orders
""")
def status_mapping(spark: SparkSession, sf: str) -> DataFrame:
    territory = (
        F.when(F.col("o_orderstatus") == "P", "Untagged")
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when(F.col("o_orderpriority") == "3-MEDIUM", "")
        .otherwise("North")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        map_values("o_orderstatus", {"F": "Finished", "O": "Active"}).alias("status"),
        label_by_like("o_orderpriority", [("%URGENT%", "FAST"), ("2%", "QUICK")], "NORMAL").alias("system_label"),
        first_tagged(territory, "o_orderpriority").alias("company"),
    )


@query("closed_months", sql="""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS invoice_year,
           strftime(o_orderdate, '%b') AS invoice_month, o_totalprice
    FROM orders WHERE date_trunc('month', o_orderdate) < DATE '1999-03-01'
""")
def closed_months(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("invoice_year"),
        month_text(F.year("o_orderdate"), F.month("o_orderdate")).alias("invoice_month"), "o_totalprice",
    )
    return closed_months_only(rows, date(1999, 3, 17), "invoice_year", "invoice_month")


# Some nations have no report name and some are not listed at all, so that the exceptions
# are of both kinds.
PARTIAL_LOOKUP = """
    SELECT n_nationkey, n_name,
           CASE WHEN n_regionkey = 1 THEN NULL WHEN n_regionkey = 2 THEN '' ELSE concat('Report ', n_name) END AS report_name
    FROM nation WHERE n_regionkey <> 0
"""
MASTER_SQL = f"""
    WITH partial AS ({PARTIAL_LOOKUP})
    SELECT c_custkey, c_name, p.report_name,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) + coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 10 END, 0) AS DOUBLE) AS amount
    FROM customer LEFT JOIN partial p ON c_nationkey = n_nationkey
    WHERE upper(c_mktsegment) NOT LIKE '%MACHIN%'
"""


def master_rows(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").filter("n_regionkey <> 0")
    report = (
        F.when(F.col("n_regionkey") == 1, F.lit(None)).when(F.col("n_regionkey") == 2, "")
        .otherwise(F.concat(F.lit("Report "), "n_name"))
    )
    expenses = F.when(F.col("c_mktsegment") != "BUILDING", F.lit(10).cast("decimal(18,2)"))
    customers = table(spark, sf, "customer").filter(unlike("c_mktsegment", "%machin%"))
    amounts = customers.select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("string").alias("nation_key"),
        number(F.col("c_acctbal").cast("decimal(18,2)") + F.coalesce(expenses, F.lit(0).cast("decimal(18,2)")), "amount"),
    )
    lookup = nation.select(F.col("n_nationkey").cast("string").alias("lookup_key"), report.alias("report_name"), "n_name")
    return lookup_by_key(amounts, lookup, "nation_key", "lookup_key", ["report_name", "n_name"])


@query("split_matched", sql=f"SELECT * FROM ({MASTER_SQL}) WHERE NOT (report_name IS NULL OR report_name = '')")
def matched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return split_matched(master_rows(spark, sf), "report_name")[0].drop("nation_key", "n_name")


@query("split_exceptions", sql=f"""
    SELECT c_custkey, c_name, amount FROM ({MASTER_SQL}) WHERE report_name IS NULL OR report_name = ''
""")
def exception_rows(spark: SparkSession, sf: str) -> DataFrame:
    return split_matched(master_rows(spark, sf), "report_name")[1].drop("nation_key", "n_name", "report_name")


@query("lookup_display_name", sql="""
    WITH companies AS (
        SELECT n_nationkey AS id, concat('Unit 7: ', n_name) AS property_name, concat('PBI ', n_name) AS report_name,
               concat('Region ', CAST(n_regionkey AS VARCHAR), ' - lead') AS manager FROM nation
        UNION ALL
        SELECT n_nationkey + 100, concat('Kiosk 31: (', n_name, ')'), concat('PBI2 ', n_name),
               concat('Region ', CAST(n_regionkey AS VARCHAR), ' - lead') FROM nation WHERE n_regionkey = 3
    ), cleaned AS (
        SELECT *, upper(trim(trim(regexp_replace(regexp_replace(property_name, '(?:Unit|Kiosk) [0-9]+: ', '', 'g'), '[()-]', '', 'g')))) AS k
        FROM companies
    ), once AS (
        SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY k ORDER BY id DESC NULLS FIRST) = 1
    )
    SELECT c_custkey, o.report_name, trim(split_part(o.manager, '-', 1)) AS region
    FROM customer LEFT JOIN once o
      ON upper(trim(concat(' nation_', CAST(c_nationkey AS VARCHAR), ' '))) = o.k
""")
def lookup_display_name(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    manager = F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"), F.lit(" - lead")).alias("manager")
    companies = nation.select(
        F.col("n_nationkey").alias("id"), F.concat(F.lit("Unit 7: "), "n_name").alias("property_name"),
        F.concat(F.lit("PBI "), "n_name").alias("report_name"), manager,
    ).unionByName(
        nation.filter("n_regionkey = 3").select(
            (F.col("n_nationkey") + 100).alias("id"), F.concat(F.lit("Kiosk 31: ("), "n_name", F.lit(")")).alias("property_name"),
            F.concat(F.lit("PBI2 "), "n_name").alias("report_name"), manager,
        )
    )
    office = F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string"), F.lit(" "))
    customers = table(spark, sf, "customer").select("c_custkey", office.alias("office"))
    found = lookup_by_key(
        customers, companies, F.upper(F.trim("office")), F.upper(F.trim(clean_name("property_name", STRIP))),
        ["report_name", "manager"], [F.col("id").desc_nulls_first()],
    )
    return found.select("c_custkey", "report_name", first_part("manager").alias("region"))


@query("code_map_fallback", sql="""
    WITH codes(code, label) AS (
        SELECT DISTINCT o_orderpriority, concat('mapped ', o_orderpriority) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority < '3'
    )
    SELECT o_orderkey, coalesce(label, o_orderpriority) AS o_orderpriority
    FROM orders LEFT JOIN codes ON o_orderpriority = code
""")
def code_map_fallback(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    codes = (
        orders.filter("o_orderstatus = 'P' AND o_orderpriority < '3'")
        .select(F.col("o_orderpriority").alias("code"), F.concat(F.lit("mapped "), "o_orderpriority").alias("label"))
        .distinct()
    )
    return map_codes(orders.select("o_orderkey", "o_orderpriority"), codes, "o_orderpriority", "code", "label")
