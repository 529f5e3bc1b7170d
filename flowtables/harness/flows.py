"""Contact and hire jobs run end to end over the driver tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables import schemas
from flowtables.functions.dates import month_text
from flowtables.harness.billing import CUTOVER, NAMES, REVENUE_SQL, companies, headers, items, report_result, snapshots
from flowtables.harness.registry import money, ntz, own_database, query, table
from flowtables.operators.aggregates import CENTS
from flowtables.plans import contacts, hires, revenue
from flowtables.plans.rules import ContactsConfig, HiresConfig, NameRules, Region, RevenueConfig
from flowtables.session import scratch_path
from flowtables.sinks.exports import export_csv
from flowtables.sinks.tables import ensure_table, replace_table
from flowtables.sources.files import json_schema, read_array_lines

# Two hourly runs, one in winter and one in British summer time.
FIRST = datetime(2024, 1, 10, 9, 55)
SECOND = datetime(2024, 6, 10, 9, 55)


def _expect(message: str, *parts: str) -> None:
    """Jobs report failures as text; a query must not go on after one."""
    if "ERROR" in message or not all(p in message for p in parts):
        raise RuntimeError(message)


def contact_objects(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.concat(F.lit(" NATION_"), F.col("c_nationkey").cast("string"), F.lit(" & Co"))
    millis = F.concat((F.lit(1_600_000_000) + F.col("c_custkey")).cast("string"), F.lit("000"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("hs_object_id"), F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("p-"), F.col("c_custkey").cast("string")).alias("portal_id"), F.col("c_name").alias("lastname"),
        nation.alias("office_location"), millis.alias("createdate"), F.lit("2024-01-05T10:00:00Z").alias("lastmodifieddate"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Care Receiver").when(F.col("c_mktsegment") == "MACHINERY", "Customer Family")
        .otherwise("Lead").alias("contact_type"),
        F.lit("5/1/1950").alias("date_of_birth"), "c_acctbal",
    )


def company_rows(spark: SparkSession, sf: str, regions: int) -> DataFrame:
    nation = table(spark, sf, "nation").filter(F.col("n_regionkey") < regions)
    return nation.select(
        F.col("n_nationkey").cast("string").alias("ID"), F.concat(F.lit("Unit 7: ("), "n_name", F.lit(" & Co)")).alias("PROPERTY_NAME"),
        F.when(F.col("n_regionkey") < 2, "FILE").otherwise("TABLE").alias("PROPERTY_ROSTER_SYSTEM"),
        F.lit("FALSE").alias("IS_DELETED"), F.lit("Franchisee").alias("PROPERTY_TYPE"),
    )


OUTBOUND = schemas.struct_of(
    "\n".join(f"{c} {'date' if c == 'DATE_OF_BIRTH' else 'string'}" for c in contacts.OUTBOUND_FIELDS)
    + "\nLAST_UPDATE_TIMESTAMP timestamp_ntz\nPROCESSED_TIMESTAMP timestamp_ntz\nFAILURE_REASON string"
)


def run_contacts(spark: SparkSession, sf: str) -> str:
    """Two runs of ingesting and sending; the second brings all contacts and all companies."""
    db, inbox = own_database(spark, "contacts"), scratch_path(spark, "contacts-in")
    cfg = ContactsConfig(
        names=NameRules(strip_patterns=("(?:Unit|Kiosk) [0-9]+: ",)), inbox=inbox, file_glob="*.txt", file_part="part-",
        whole_file_arrays=False, outbox=scratch_path(spark, "contacts-out"), ledger=f"{db}.ledger", contacts=f"{db}.contacts",
        companies=f"{db}.company", log=f"{db}.log", outbound=f"{db}.outbound",
    )
    ensure_table(spark, cfg.outbound, OUTBOUND)
    objects = contact_objects(spark, sf)
    for as_of, rows, regions in ((FIRST, objects.filter("c_acctbal > 0"), 4), (SECOND, objects, 5)):
        replace_table(company_rows(spark, sf, regions), cfg.companies)
        lines = rows.drop("c_acctbal")
        lines.select(F.concat(F.lit("["), F.to_json(F.struct(*lines.columns)), F.lit("]"))).write.mode("append").text(inbox)
        _expect(contacts.ingest(spark, cfg, as_of), "Inserted")
        _expect(contacts.ingest(spark, cfg, as_of), "Files=0")
        _expect(contacts.send_csv(spark, cfg, as_of), "Sent")
        _expect(contacts.send_table(spark, cfg, as_of), "Sent")
        _expect(contacts.send_csv(spark, cfg, as_of), "Pending=0")
    return cfg.contacts


@query("contacts_flow", sql="""
    WITH c AS (
        SELECT CAST(c_custkey AS VARCHAR) AS hs_object_id, CASE WHEN n_regionkey < 2 THEN 'FILE' ELSE 'TABLE' END AS roster_system,
               c_acctbal > 0 AS early, n_regionkey < 4 AND c_acctbal > 0 AS early_mapped, c_mktsegment IN ('BUILDING', 'MACHINERY') AS sendable,
               make_timestamp((1600000000 + c_custkey) * 1000000) AS createdate
        FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT hs_object_id, roster_system, createdate,
           CASE WHEN early THEN TIMESTAMP '2024-01-10 09:55:00' ELSE TIMESTAMP '2024-06-10 09:55:00' END AS created_at,
           CASE WHEN NOT sendable THEN NULL
                WHEN early_mapped THEN TIMESTAMP '2024-01-10 09:55:00'
                WHEN roster_system = 'FILE' THEN TIMESTAMP '2024-06-10 10:55:00'
                ELSE TIMESTAMP '2024-06-10 09:55:00' END AS sent_timestamp
    FROM c
""")
def contacts_flow(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["HS_OBJECT_ID", "ROSTER_SYSTEM", "CREATEDATE", "CREATED_AT", "SENT_TIMESTAMP"]
    return spark.table(run_contacts(spark, sf)).select(*[F.col(c).alias(c.lower()) for c in wanted])


@query("contact_acks_flow", sql="""
    SELECT CAST(c_custkey AS VARCHAR) AS hs_object_id, c_mktsegment AS contact_type,
           CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2024-01-10 09:55:00' ELSE TIMESTAMP '2024-06-10 09:55:00' END AS processed_timestamp,
           CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2024-01-10 09:55:00' ELSE TIMESTAMP '2024-06-10 09:55:00' END AS created_at
    FROM customer
""")
def contact_acks_flow(spark: SparkSession, sf: str) -> DataFrame:
    db = own_database(spark, "acks")
    cfg = ContactsConfig(log=f"{db}.log", acks=f"{db}.acks", inbound_acks=f"{db}.inbound_acks")
    early = F.col("c_acctbal") > 0
    acks = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("HS_OBJECT_ID"), F.col("c_mktsegment").alias("CONTACT_TYPE"),
        F.when(early, ntz(str(FIRST))).otherwise(ntz(str(SECOND))).alias("PROCESSED_TIMESTAMP"),
        *[F.lit("").alias(c) for c in ("OFFICE_LOCATION", "FIRSTNAME", "LASTNAME", "FAILURE_REASON")],
    )
    old = acks.withColumn("PROCESSED_TIMESTAMP", ntz("2021-03-01 00:00:00"))
    # Every acknowledgement is delivered twice, and an old year must not come in.
    for as_of in (FIRST, SECOND):
        arrived = acks.filter(F.col("PROCESSED_TIMESTAMP") <= ntz(str(as_of)))
        replace_table(arrived.unionAll(arrived).unionAll(old), cfg.inbound_acks)
        _expect(contacts.pull_acks(spark, cfg, as_of), "After")
        _expect(contacts.pull_acks(spark, cfg, as_of), "New=0")
    wanted = ["HS_OBJECT_ID", "CONTACT_TYPE", "PROCESSED_TIMESTAMP", "CREATED_AT"]
    return spark.table(cfg.acks).select(*[F.col(c).alias(c.lower()) for c in wanted])


def updates_config(spark: SparkSession, sf: str, label: str) -> ContactsConfig:
    db = own_database(spark, label)
    cfg = ContactsConfig(
        contacts=f"{db}.contacts", log=f"{db}.log", outbox=scratch_path(spark, "updates-out"), updates_inbox=scratch_path(spark, "updates-in"),
        updates_checkpoint=scratch_path(spark, "updates-checkpoint"), updates_files=f"{db}.updates_files", status_map=f"{db}.status_map",
        updates_shared="ft_updates_shared", updates_table=f"{db}.updates_table",
    )
    portals = contact_objects(spark, sf).select(F.col("id").alias("ID"), F.col("portal_id").alias("PORTAL_ID"))
    replace_table(portals, cfg.contacts)
    return cfg


@query("updates_from_files_flow", sql="""
    WITH landed AS (
        SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS hs_object_id, o_orderpriority AS p,
               CASE o_orderstatus WHEN 'F' THEN 'Archived' WHEN 'O' THEN 'Pending' ELSE 'Other' END AS s
        FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'),
    stored AS (
        SELECT hs_object_id, CASE s WHEN 'Archived' THEN 'Finished' WHEN 'Pending' THEN 'Inactive' ELSE s END AS customer_status,
               CASE WHEN p < '3' THEN concat('mapped ', p) ELSE p END AS customer_status_2,
               md5(concat(hs_object_id, '||', '|', s, '|', p, '|||||||||')) AS row_hash
        FROM landed)
    SELECT hs_object_id, customer_status, customer_status_2, row_hash, concat('p-', hs_object_id) AS portal_id, TIMESTAMP '2024-01-10 09:55:00' AS sent_timestamp
    FROM stored
""")
def updates_from_files_flow(spark: SparkSession, sf: str) -> DataFrame:
    cfg = updates_config(spark, sf, "updates")
    orders = table(spark, sf, "orders")
    codes = orders.filter("o_orderpriority < '3'").select(F.col("o_orderpriority").alias("SOURCE_STATUS")).distinct()
    replace_table(codes.withColumn("TARGET_STATUS", F.concat(F.lit("mapped "), "SOURCE_STATUS")), cfg.status_map)
    # Partial low-priority orders come without an id and must not be stored.
    blank = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    values = {
        "HS_OBJECT_ID": F.when(~blank, F.col("o_custkey").cast("string")),
        "CUSTOMER_STATUS": F.when(F.col("o_orderstatus") == "F", "Archived").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Other"),
        "CUSTOMER_STATUS_2": F.col("o_orderpriority"),
    }
    feed = orders.select(*[values.get(c, F.lit(None).cast("string")).alias(c) for c in schemas.STATUS_UPDATE_FIELDS])
    for as_of, count in ((FIRST, "Sent="), (SECOND, "Inserted=0")):
        feed.write.mode("append").options(header=True, nullValue="", escape='"').csv(cfg.updates_inbox)
        _expect(contacts.updates_from_files(spark, cfg, as_of), count)
    name = f"{cfg.outbox}/CUSTOMER_UPDATE_{cfg.updates_files}_20240110_095500.json"
    sent = read_array_lines(spark, name, json_schema(["HS_OBJECT_ID", "CUSTOMER_STATUS", "CUSTOMER_STATUS_2", "PORTAL_ID"]))
    stored = spark.table(cfg.updates_files).select("HS_OBJECT_ID", "CUSTOMER_STATUS", "CUSTOMER_STATUS_2", "ROW_HASH", "SENT_TIMESTAMP")
    # Every stored row was sent once, with the portal of its contact.
    joined = stored.join(sent, ["HS_OBJECT_ID", "CUSTOMER_STATUS", "CUSTOMER_STATUS_2"])
    return joined.toDF(*[c.lower() for c in joined.columns])


@query("updates_from_table_flow", sql="""
    SELECT CAST(user_id AS VARCHAR) AS hs_object_id, CASE event_type WHEN 'click' THEN 'Active' WHEN 'view' THEN 'Finished' ELSE event_type END AS customer_status,
           CASE WHEN event_type = 'error' THEN 'Covid-19' ELSE 'Other' END AS customer_status_2, ts AS last_update_timestamp,
           CASE WHEN ts < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-10 09:55:00' ELSE TIMESTAMP '2024-06-10 10:55:00' END AS sent_timestamp
    FROM events
""")
def updates_from_table_flow(spark: SparkSession, sf: str) -> DataFrame:
    cfg = updates_config(spark, sf, "shared")
    kind = F.col("event_type")
    shared = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("HS_OBJECT_ID"), F.lit("office").alias("OFFICE_LOCATION"),
        F.when(kind == "click", "ACTIVE").when(kind == "view", "FINISHED").otherwise(kind).alias("CUSTOMER_STATUS"),
        F.when(kind == "error", "Hospital COVID-19 suspected").otherwise("Other").alias("CUSTOMER_STATUS_2"),
        F.col("ts").alias("LAST_UPDATE_TIMESTAMP"),
    )
    for as_of, rows in ((FIRST, shared.filter(F.col("LAST_UPDATE_TIMESTAMP") < ntz("2024-01-16 00:00:00"))), (SECOND, shared)):
        rows.createOrReplaceTempView(cfg.updates_shared)
        _expect(contacts.updates_from_table(spark, cfg, as_of), "Sent=")
    _expect(contacts.updates_from_table(spark, cfg, SECOND), "New=0")
    spark.catalog.dropTempView(cfg.updates_shared)
    stored = spark.table(cfg.updates_table).withColumnRenamed("SENT_TO_HS_TIMESTAMP", "SENT_TIMESTAMP")
    wanted = ["HS_OBJECT_ID", "CUSTOMER_STATUS", "CUSTOMER_STATUS_2", "LAST_UPDATE_TIMESTAMP", "SENT_TIMESTAMP"]
    return stored.select(*[F.col(c).alias(c.lower()) for c in wanted])


@query("hires_flow", sql="""
    WITH source AS (
        SELECT concat('First ', CAST(o_custkey AS VARCHAR)) AS name_first, concat('Last ', c_name) AS name_last,
               CASE WHEN o_orderstatus = 'P' THEN concat('unknown ', CAST(o_orderdate AS VARCHAR))
                    ELSE concat(CAST(day(o_orderdate) AS VARCHAR), '/', CAST(month(o_orderdate) AS VARCHAR), '/', CAST(year(o_orderdate) AS VARCHAR), ' 9:05') END AS status_date,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS email, c_nationkey
        FROM orders JOIN customer ON o_custkey = c_custkey),
    once AS (
        SELECT * FROM source QUALIFY row_number() OVER (PARTITION BY status_date, name_first, name_last ORDER BY coalesce(email, '') DESC, email NULLS LAST) = 1)
    SELECT name_first, status_date, email, CASE WHEN n_regionkey < 2 THEN 'FILE' ELSE 'TABLE' END AS roster_system,
           try_strptime(status_date, '%d/%m/%Y %H:%M') AS status_ts,
           CASE WHEN n_regionkey < 4 THEN TIMESTAMP '2024-01-10 09:55:00' ELSE TIMESTAMP '2024-06-10 10:55:00' END AS sent_timestamp
    FROM once JOIN nation ON c_nationkey = n_nationkey
    WHERE try_strptime(status_date, '%d/%m/%Y %H:%M') IS NOT NULL
""")
def hires_flow(spark: SparkSession, sf: str) -> DataFrame:
    db = own_database(spark, "hires")
    cfg = HiresConfig(
        source=f"{db}.hired", target=f"{db}.hired_target", tracking=f"{db}.tracking", roster=f"{db}.roster", log=f"{db}.log",
        outbox=scratch_path(spark, "hires-out"), outbound=f"{db}.outbound",
    )
    ensure_table(spark, cfg.outbound, schemas.struct_of("\n".join(f"{c} string" for c in hires.SENT_FIELDS) + "\nSENT_TIMESTAMP timestamp_ntz"))
    day = F.concat_ws("/", F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate"))
    people = table(spark, sf, "orders").join(table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    values = {
        "CANDIDATE_NAME_TITLE": F.lit("Mx"),
        "CANDIDATE_PROTECTED_NAME_FIRST": F.concat(F.lit("First "), F.col("o_custkey").cast("string")),
        "CANDIDATE_PROTECTED_NAME_LAST": F.concat(F.lit("Last "), "c_name"),
        "CANDIDATE_PROTECTED_EMAIL": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        "HIERARCHY_NAME": F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string")),
        "DATE_IN_STATUS_3": F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("unknown "), F.col("o_orderdate").cast("string")))
        .otherwise(F.concat(day, F.lit(" 9:05"))),
    }
    replace_table(people.select(*[values.get(c, F.lit(None)).cast("string").alias(c) for c in schemas.HIRED_FIELDS]), cfg.source)
    nation = table(spark, sf, "nation")
    for as_of, regions in ((FIRST, 4), (SECOND, 5)):
        roster = nation.filter(F.col("n_regionkey") < regions).select(
            F.col("n_name").alias("COMPANY_NAME"), F.when(F.col("n_regionkey") < 2, "FILE").otherwise("TABLE").alias("ROSTER_SYSTEM")
        )
        replace_table(roster, cfg.roster)
        _expect(hires.process(spark, cfg, as_of), "processed")
        _expect(hires.send_csv(spark, cfg, as_of))
        _expect(hires.send_table(spark, cfg, as_of))
    wanted = {
        "name_first": "CANDIDATE_PROTECTED_NAME_FIRST", "status_date": "DATE_IN_STATUS_3", "email": "CANDIDATE_PROTECTED_EMAIL",
        "roster_system": "ROSTER_SYSTEM", "status_ts": "DATE_IN_STATUS_3_TS", "sent_timestamp": "SENT_TIMESTAMP",
    }
    return spark.table(cfg.target).select(*[F.col(old).alias(new) for new, old in wanted.items()])



# ------------------------------------------------------------------ revenue

REVENUE_RUNS = (datetime(2001, 5, 15, 8), datetime(2001, 6, 15, 8))


@query("revenue_jobs_flow", sql=f"""WITH {REVENUE_SQL}
    SELECT company_name, nullif(report_name, '') AS report_name, roster_system, invoice_year, invoice_month, care_type, funder_type, category,
           amount, hours, region, status, report_name IS NULL OR report_name = '' AS exception
    FROM master
""")
def revenue_jobs_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Two monthly runs of the whole chain, then loads that are skipped and a load merged again: what the report tables hold."""
    db, folder = own_database(spark, "revenue"), scratch_path(spark, "revenue")
    names = ("header_table", "item_table", "line_detail", "line_index", "line_summary", "snapshot_detail", "snapshot_summary", "snapshot_state",
             "snapshot_applied", "hours_summary", "companies", "revenue", "report", "exceptions")
    cfg = RevenueConfig(
        names=NAMES, regions=(Region("A", "LINES"),), landing=folder, amount_type=CENTS, cutover_year=CUTOVER, default_system="SNAPS",
        legacy_dated=(f"{db}.legacy",), snapshot_source=f"{db}.shared_", snapshot_prefix=f"{db}.snap_", visit_source=f"{db}.sharedvisit_",
        visit_prefix=f"{db}.visit_", **{n: f"{db}.{n}" for n in names},
    )
    orders = table(spark, sf, "orders")
    replace_table(companies(spark, sf), cfg.companies)
    replace_table(
        orders.select(
            F.col("o_orderpriority").alias("COMPANY_NAME"), F.lit("LEGACY").alias("ROSTER_SYSTEM"), F.year("o_orderdate").alias("INVOICE_YEAR"),
            month_text(F.year("o_orderdate"), F.month("o_orderdate")).alias("INVOICE_MONTH"), F.lit("legacy").alias("CARE_TYPE"),
            money("o_totalprice").alias("TOT_AMT_INVOICED"),
        ),
        f"{db}.legacy",
    )
    visits = table(spark, sf, "events").select(
        F.col("user_id").cast("decimal(38,0)").alias("OFFICE_ID"), F.col("ts").cast("date").alias("PERIOD_END"),
        *[F.col("value").cast("decimal(18,4)").alias(c) for c in ("CUSTOMERS", "PERIOD_VISITS", "CHARGED_HOURS")], F.col("event_id").alias("n"),
    )
    # Every other invoice comes with the second month, dated in any month of all years.
    for odd, as_of in enumerate(REVENUE_RUNS):
        month = date(as_of.year, as_of.month - 1, 1)
        for kind, rows, schema in (("header", headers(spark, sf), schemas.INVOICE_HEADER), ("item", items(spark, sf), schemas.INVOICE_ITEM)):
            own = schemas.pad_to(rows.filter(F.col("invoiceid") % 2 == odd), schema)
            export_csv(own, folder, f"A_{kind}_{month:%Y_%m}.csv", single_file=False, null_value="NULL", compression="gzip")
        replace_table(snapshots(spark, sf).filter(F.col("INV_NO").cast("bigint") % 2 == odd), f"{db}.shared_{month.year}_{month.month}")
        replace_table(visits.filter(F.col("n") % 2 == odd).drop("n"), f"{db}.sharedvisit_{month.year}_{month.month}")
        for message in revenue.run_month(spark, cfg, as_of):
            _expect(message)
    _expect(revenue.load_files(spark, cfg, REVENUE_RUNS[0]), "SKIPPED")
    _expect(revenue.refine_lines(spark, cfg, "A", date(2001, 4, 1), merge=True), "SUCCESS")
    good = report_result(spark.table(cfg.report)).withColumn("exception", F.lit(False))
    bad = report_result(spark.table(cfg.exceptions)).withColumn("exception", F.lit(True))
    return good.unionByName(bad, allowMissingColumns=True)
