"""Revenue: raw files and snapshots, refined, conformed to one shape, reported."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables import schemas
from flowtables.functions.dates import closed_months_only, filter_period, month_start, month_text, period_key, shift_month
from flowtables.functions.text import clean_name, first_part, join_key, plain_key
from flowtables.functions.values import first_tagged, label_by_like
from flowtables.operators.aggregates import (
    WHOLE_UNITS, detail_aggregate, hours_summary, month_variance, monthly_summary, summarise_billing,
)
from flowtables.operators.conform import conform_union
from flowtables.operators.filters import cutover, differs_or_null, flagged, split_matched, unlike
from flowtables.operators.joins import lookup_by_key
from flowtables.operators.merge import merge_upsert
from flowtables.operators.windows import keep_latest, keep_latest_per_month, latest_first, movement
from flowtables.plans.invoice_index import InvoiceIndex, months_of
from flowtables.plans.movement_state import MovementState
from flowtables.plans.rules import BILLED_TYPES, EXCLUDED_MANUAL_CODE, REPORT_COMPANIES, NameRules, RevenueConfig
from flowtables.session import short_methods, shuffles_removed, staging
from flowtables.sinks.tables import (
    LoadResult, balanced, change_table, count_rows, done, dynamic_overwrite, ensure_table, in_table_order, only_partitions, replace_period, replace_table,
)
from flowtables.sources.files import read_typed_csv
from flowtables.sources.tables import load_all, period_tables, snapshot_period, status_line, union_periods

HEADER_COLUMNS = ("branchid", "branchname", "jobtypename", "manualinvoice", "workgroupid", "vat", "split")
LINE_DETAIL_COLUMNS = """
    ROSTER_SYSTEM BRANCHID BRANCHNAME INVOICE_YEAR INVOICE_MONTH CATEGORY_OF_CARE FUNDER_TYPE INVOICEID
    MANUALINVOICE WORKGROUPID DISCOUNTPERCENT VAT SPLIT TYPE TOT_AMT_BILLING TOT_CNT_HOURS
""".split()
SUMMARY_KEYS = ("ROSTER_SYSTEM", "BRANCHID", "INVOICE_YEAR", "INVOICE_MONTH", "CATEGORY_OF_CARE", "FUNDER_TYPE")
MONTH = ["INVOICE_YEAR", "INVOICE_MONTH"]
SUMMARY_PARTITIONS = ["ROSTER_SYSTEM", "INVOICE_YEAR", "INVOICE_MONTH"]
LINE_DETAIL = schemas.struct_of("""
    ROSTER_SYSTEM string
    BRANCHID decimal(38,0)
    BRANCHNAME string
    CATEGORY_OF_CARE string
    FUNDER_TYPE string
    INVOICEID decimal(38,0)
    MANUALINVOICE decimal(38,0)
    WORKGROUPID string
    DISCOUNTPERCENT string
    VAT decimal(38,0)
    SPLIT decimal(38,0)
    TYPE string
    TOT_AMT_BILLING decimal(38,2)
    TOT_CNT_HOURS decimal(38,2)
    INVOICE_YEAR int
    INVOICE_MONTH int
""")
LINE_SUMMARY = schemas.struct_of("""
    BRANCHID decimal(38,0)
    BRANCHNAME string
    TERRITORY string
    CATEGORY_OF_CARE string
    FUNDER_TYPE string
    CARE_TYPE string
    TOT_AMT_INVOICED decimal(38,2)
    TOT_AMT_EXPENSES decimal(38,2)
    TOT_CNT_HOURS decimal(38,2)
    ROSTER_SYSTEM string
    INVOICE_YEAR int
    INVOICE_MONTH int
""")


#: What an invoice of the snapshots is known by.
SNAPSHOT_KEYS = ["OFFICE_ID", "INV_NO", "CARE_TYPE", "FUNDER_TYPE"]


# ---------------------------------------------------------------- transformations


def line_detail(
    headers: DataFrame,
    items: DataFrame,
    system: str,
    names: NameRules = NameRules(),
    amount_type: str = WHOLE_UNITS,
) -> DataFrame:
    """Latest header of each invoice joined to its live, billed items, summed per item group."""
    dated = headers.select("invoiceid", *HEADER_COLUMNS, F.coalesce("updated", "created").alias("effective"))
    latest = keep_latest(dated.filter(F.col("invoiceid").isNotNull()), ["invoiceid"], [latest_first("effective")])
    # Names and dates are worked out per header, before its lines multiply them.
    described = latest.select(
        F.col("invoiceid").alias("INVOICEID"),
        F.col("branchid").alias("BRANCHID"),
        clean_name("branchname", names.strip_patterns, names.drop_words).alias("BRANCHNAME"),
        F.year("effective").alias("INVOICE_YEAR"),
        F.month("effective").alias("INVOICE_MONTH"),
        F.col("jobtypename").alias("FUNDER_TYPE"),
        F.col("manualinvoice").alias("MANUALINVOICE"),
        F.col("workgroupid").alias("WORKGROUPID"),
        F.col("vat").cast(WHOLE_UNITS).alias("VAT"),
        F.col("split").cast(WHOLE_UNITS).alias("SPLIT"),
    )
    billed = items.filter(F.col("type").isin(*BILLED_TYPES) & F.col("deleted").isNull()).select(
        F.col("invoiceid").alias("INVOICEID"),
        F.col("jobtypegroupname").alias("CATEGORY_OF_CARE"),
        F.col("discountpercent").alias("DISCOUNTPERCENT"),
        F.col("type").alias("TYPE"),
        "billing",
        "invoicehrs",
    )
    joined = detail_aggregate(
        described, billed, "INVOICEID", ["CATEGORY_OF_CARE", "DISCOUNTPERCENT", "TYPE"],
        {"TOT_AMT_BILLING": "billing", "TOT_CNT_HOURS": "invoicehrs"}, amount_type,
    )
    return joined.withColumn("ROSTER_SYSTEM", F.lit(system)).select(*LINE_DETAIL_COLUMNS)


def line_summary(detail: DataFrame, amount_type: str = WHOLE_UNITS) -> DataFrame:
    """Billing per branch, month, care category and funder.

    Grouped by branch id: two spellings of one branch are one row, under the larger name,
    so the summary never has two rows for one merge key.
    """
    counted = detail.filter(differs_or_null("MANUALINVOICE", EXCLUDED_MANUAL_CODE) & F.col("BRANCHID").isNotNull())
    summary = summarise_billing(counted, SUMMARY_KEYS, "BRANCHNAME", amount_type)
    return summary.select(
        "ROSTER_SYSTEM", "BRANCHID", "BRANCHNAME", "INVOICE_YEAR", "INVOICE_MONTH",
        F.lit("").alias("TERRITORY"), "CATEGORY_OF_CARE", "FUNDER_TYPE", F.lit("").alias("CARE_TYPE"),
        "TOT_AMT_INVOICED", "TOT_AMT_EXPENSES", "TOT_CNT_HOURS",
    )


def snapshot_detail(
    invoices: DataFrame,
    names: NameRules = NameRules(),
    system_rules: Sequence[tuple[str, str]] = (),
    default_system: str = "SNAPSHOT",
    amount_type: str = WHOLE_UNITS,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Monthly movement of each invoice across its snapshots.

    Names are cleaned after the latest snapshot per month is chosen, on fewer rows. With ``stage``
    these are staged, so that the shuffle that chose them is gone before the one of the movement.
    """
    monthly = keep_latest_per_month(sent_invoices(invoices), SNAPSHOT_KEYS, "SENT")
    if stage is not None:
        monthly = stage(monthly, "monthly")
    monthly = monthly.withColumn("SENT_MONTH", F.trunc("SENT", "MM"))
    moved = movement(monthly, SNAPSHOT_KEYS, "SENT_MONTH", "TOTAL_INVOICED", "MOVED")
    return described_movement(moved, names, system_rules, default_system, amount_type)


def sent_invoices(invoices: DataFrame) -> DataFrame:
    """Invoices with a total, and when they were sent."""
    return invoices.filter(F.col("TOTAL_INVOICED").isNotNull()).select(
        *SNAPSHOT_KEYS, "OFFICE_NAME", "TERRITORY", "TOTAL_INVOICED", F.coalesce("INVOICE_SENT_DATE", "INVOICE_DATE").alias("SENT")
    )


def described_movement(
    moved: DataFrame, names: NameRules, system_rules: Sequence[tuple[str, str]], default_system: str, amount_type: str
) -> DataFrame:
    """The columns of the movement detail."""
    return moved.select(
        label_by_like("OFFICE_NAME", system_rules, default_system).alias("ROSTER_SYSTEM"),
        "OFFICE_ID",
        clean_name("OFFICE_NAME", names.strip_patterns).alias("OFFICE_NAME"),
        clean_name("TERRITORY", names.strip_patterns).alias("TERRITORY"),
        F.year("SENT_MONTH").alias("INVOICE_YEAR"),
        F.month("SENT_MONTH").alias("INVOICE_MONTH"),
        "CARE_TYPE", "FUNDER_TYPE", "INV_NO",
        F.col("MOVED").cast(amount_type).alias("TOT_AMT_INVOICED"),
    )


def snapshot_summary(detail: DataFrame) -> DataFrame:
    """Movement per company, month, care and funder type in whole units."""
    named = detail.withColumn("COMPANY_NAME", first_tagged("TERRITORY", "OFFICE_NAME"))
    dims = ["COMPANY_NAME", "ROSTER_SYSTEM", "CARE_TYPE", "FUNDER_TYPE"]
    return monthly_summary(named, dims, "INVOICE_YEAR", "INVOICE_MONTH", "TOT_AMT_INVOICED")


def line_branch(summary: DataFrame) -> DataFrame:
    """Line summary in the conformed columns."""
    funder = F.coalesce("FUNDER_TYPE", F.lit("XXX"))
    return summary.select(
        F.col("BRANCHNAME").alias("COMPANY_NAME"), "ROSTER_SYSTEM", "INVOICE_YEAR",
        month_text("INVOICE_YEAR", "INVOICE_MONTH").alias("INVOICE_MONTH"),
        funder.alias("CARE_TYPE"), funder.alias("FUNDER_TYPE"), "CATEGORY_OF_CARE", "TOT_AMT_INVOICED",
        F.col("TOT_CNT_HOURS").alias("TOT_SUM_HOURS"), "TOT_AMT_EXPENSES",
    )


def report_companies(companies: DataFrame) -> DataFrame:
    return companies.filter(flagged(REPORT_COMPANIES))


def all_revenue(branches: Sequence[DataFrame], companies: DataFrame, names: NameRules = NameRules()) -> DataFrame:
    """Every source in one shape, with the report name of its company."""
    shown = clean_name("PROPERTY_NAME", names.strip_patterns)
    return lookup_by_key(
        conform_union(branches, schemas.REVENUE),
        report_companies(companies),
        plain_key("COMPANY_NAME"),
        plain_key(shown),
        {"PROPERTY_POWER_BI_NAME": "BRANCH_NAME_PBI"},
        [latest_first("ID")],
    ).select("BRANCH_NAME_PBI", *schemas.REVENUE.names)


def report_master(
    revenue: DataFrame,
    companies: DataFrame,
    as_of: date,
    names: NameRules = NameRules(),
    excluded_name: str = "%TRAINING%",
) -> DataFrame:
    """Closed months with company facts looked up on the hard name key."""
    closed = closed_months_only(revenue, as_of).filter(unlike("COMPANY_NAME", excluded_name))
    facts = report_companies(companies).select(
        "PROPERTY_NAME", "PROPERTY_STATUS",
        F.trim("PROPERTY_NAME").alias("LOOKUP_OFFICE_NAME"),
        F.trim("PROPERTY_POWER_BI_NAME").alias("REPORT_NAME"),
        F.col("PROPERTY_FRANCHISEE_1").alias("FRANCHISE_OWNERS"),
        first_part("PROPERTY_BDM", "-").alias("BD_REGION"),
        F.col("PROPERTY_STATUS").alias("STATUS"),
        F.col("PROPERTY_ROSTER_SYSTEM").alias("LOOKUP_ROSTER_SYSTEM"),
    )
    looked_up = ["LOOKUP_OFFICE_NAME", "REPORT_NAME", "FRANCHISE_OWNERS", "BD_REGION", "STATUS", "LOOKUP_ROSTER_SYSTEM"]
    joined = lookup_by_key(
        closed.withColumn("COMPANY_NAME", F.trim("COMPANY_NAME")),
        facts,
        join_key("COMPANY_NAME", names.key_drop_words),
        join_key("PROPERTY_NAME", names.key_drop_words),
        looked_up,
        [latest_first("PROPERTY_STATUS")],
    )
    return joined.select(
        "COMPANY_NAME", F.col("COMPANY_NAME").alias("SOURCE_OFFICE"), "LOOKUP_OFFICE_NAME", "REPORT_NAME",
        "ROSTER_SYSTEM", "INVOICE_YEAR", "INVOICE_MONTH", "CARE_TYPE", "FUNDER_TYPE", "CATEGORY_OF_CARE",
        (F.col("TOT_AMT_INVOICED") + F.coalesce("TOT_AMT_EXPENSES", F.lit(0).cast("decimal(38,2)")))
        .cast("decimal(38,2)").alias("TOT_AMT_INVOICED"),
        "TOT_SUM_MSF", "TOT_SUM_HOURS", "TOT_CNT_CUSTOMERS", "TOT_CNT_CARERS", "TOT_AMT_EXPENSES",
        "FRANCHISE_OWNERS", "BD_REGION", "STATUS", "LOOKUP_ROSTER_SYSTEM",
    )


def report_and_exceptions(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    matched, missing = split_matched(master, "REPORT_NAME")
    return matched.drop("LOOKUP_OFFICE_NAME"), missing.drop("LOOKUP_OFFICE_NAME", "REPORT_NAME")


# ---------------------------------------------------------------- jobs


def _variance_text(df: DataFrame, day: date, month_as_text: bool = False) -> str:
    return month_variance(df, day, "TOT_AMT_INVOICED", month_as_text).first().MESSAGE


def load_file_once(spark: SparkSession, path: str, schema, table: str, region: str, period: str) -> LoadResult:
    """Load one monthly file into its (region, period) partition unless it is there."""
    label = f"{table} {region} {period}"
    ensure_table(spark, table, schemas.T.StructType([*schema.fields, *_region_period().fields]), ["region", "period"])
    here = (F.col("region") == region) & (F.col("period") == period)
    if not spark.table(table).filter(here).isEmpty():
        return LoadResult(label, "SKIPPED", 0, f"SKIPPED: {label} already exists")
    rows = read_typed_csv(spark, path, schema).withColumn("region", F.lit(region)).withColumn("period", F.lit(period))
    with short_methods(spark):
        return done(label, replace_period(rows, table, {"region": region, "period": period}).rows)


def _region_period():
    return schemas.struct_of("region string\nperiod string")


def load_files(spark: SparkSession, cfg: RevenueConfig, as_of: date) -> str:
    """Last month's header and item files of every region."""
    period = period_key(as_of)
    kinds = {"header": (schemas.INVOICE_HEADER, cfg.header_table), "item": (schemas.INVOICE_ITEM, cfg.item_table)}

    def loader(region: str, kind: str):
        schema, table = kinds[kind]
        path = f"{cfg.landing}/{cfg.file_name.format(region=region, kind=kind, period=period)}"
        return lambda: load_file_once(spark, path, schema, table, region, period)

    loads = {f"{r.code}/{k}": loader(r.code, k) for r in cfg.regions for k in kinds}
    return status_line(load_all(loads))


def load_shared(spark: SparkSession, cfg: RevenueConfig, as_of: date) -> str:
    """Copy last month's shared tables, once each."""
    loads = {
        "invoice": lambda: snapshot_period(spark, cfg.snapshot_source, cfg.snapshot_prefix, as_of),
        "visit": lambda: snapshot_period(spark, cfg.visit_source, cfg.visit_prefix, as_of),
    }
    return status_line(load_all(loads))


def refine_lines(spark: SparkSession, cfg: RevenueConfig, region: str, month: date, merge: bool = False) -> str:
    """Detail of one region and load, and the summaries of all months that the load touches.

    The detail keeps every row of the file under its load period, whatever month its invoice
    is dated in, so no row is lost and a rerun replaces exactly its own rows.  A month's
    summary is built from all loads, each invoice by its last delivery.  It is complete, so it
    replaces its partition, and groups that vanished from the detail vanish here too.
    ``merge`` keeps such groups by upserting instead.
    """
    month = month_start(month)
    label = next(r.label for r in cfg.regions if r.code == region)
    period = f"{month.year}_{month.month:02d}"
    here = (F.col("region") == region) & (F.col("period") == period)
    load = {"ROSTER_SYSTEM": label, "LOAD_PERIOD": period}
    wide = schemas.T.StructType([*LINE_DETAIL.fields, *schemas.struct_of("LOAD_PERIOD string").fields])
    ensure_table(spark, cfg.line_detail, wide, list(load))
    ensure_table(spark, cfg.line_summary, LINE_SUMMARY, SUMMARY_PARTITIONS)

    index, rows = InvoiceIndex(spark, cfg.line_index, cfg.line_detail, label), 0
    with staging(spark) as stage:
        headers, items = (spark.table(name).filter(here) for name in (cfg.header_table, cfg.item_table))
        detail = stage(line_detail(headers, items, label, cfg.names, cfg.amount_type).withColumn("LOAD_PERIOD", F.lit(period)), "detail")
        before = stage(index.load(period), "before")
        replace_period(detail, cfg.line_detail, load)
        index.replace(period, detail)
        invoices = stage(before.select("INVOICEID").unionByName(detail.select("INVOICEID")).distinct(), "invoices")
        touched = {month} | months_of(before) | months_of(index.of(invoices))
        deliveries = stage(index.deliveries(touched), "deliveries")
        summaries = stage(line_summary(index.standing(touched, deliveries), cfg.amount_type), "summaries")
        if merge:
            rows = _merge_summary(spark, cfg, summaries).rows
        else:
            rows = _write_partitions(spark, summaries, cfg.line_summary, SUMMARY_PARTITIONS)
            for day in sorted(touched - months_of(summaries)):  # months that lost all their rows
                in_month = {"ROSTER_SYSTEM": label, "INVOICE_YEAR": day.year, "INVOICE_MONTH": day.month}
                replace_period(filter_period(summaries, day), cfg.line_summary, in_month)
    system_rows = spark.table(cfg.line_summary).filter(F.col("ROSTER_SYSTEM") == label)
    return f"SUCCESS: {label} {period} ({rows} rows) | {_variance_text(system_rows, month)}"


def _merge_summary(spark: SparkSession, cfg: RevenueConfig, summary: DataFrame) -> LoadResult:
    keys = [*SUMMARY_PARTITIONS, "BRANCHID", "CATEGORY_OF_CARE", "FUNDER_TYPE"]
    amounts = ["BRANCHNAME", "TOT_AMT_INVOICED", "TOT_AMT_EXPENSES", "TOT_CNT_HOURS"]
    return change_table(
        spark, cfg.line_summary, summary,
        lambda old: merge_upsert(old, summary, keys, amounts, blank_null=["CATEGORY_OF_CARE", "FUNDER_TYPE"]),
    )


def _snapshot_state(cfg: RevenueConfig) -> MovementState:
    return MovementState(cfg.snapshot_state, f"{cfg.snapshot_state}_last", tuple(SNAPSHOT_KEYS), "SENT", "TOTAL_INVOICED")


def refine_snapshots(spark: SparkSession, cfg: RevenueConfig, as_of: date, rebuild: bool = False) -> str:
    """Movement detail, its summary, and the hours summary.

    Snapshots that were not applied yet are taken into the state; only months that they touch
    are written again. ``rebuild`` starts from all snapshots, as is needed when rows of an
    applied snapshot were taken back.
    """
    state, tables = _snapshot_state(cfg), period_tables(spark, cfg.snapshot_prefix)
    ensure_table(spark, cfg.snapshot_applied, schemas.struct_of("SNAPSHOT string"))
    applied = set() if rebuild else {r.SNAPSHOT for r in spark.table(cfg.snapshot_applied).collect()}
    names = [n for n in tables if n.rpartition(".")[2] not in applied]
    if not applied:
        for name in (state.rows, state.last, cfg.snapshot_detail, cfg.snapshot_summary):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    detail_rows = summary_rows = 0
    months = state.advance(spark, sent_invoices(reduce(DataFrame.unionByName, [spark.table(n) for n in names]))) if names else []
    if months or not applied:
        described = described_movement(state.moved(spark, months, "MOVED"), cfg.names, cfg.system_rules, cfg.default_system, cfg.amount_type)
        with shuffles_removed(spark), short_methods(spark):
            detail_rows = _write_partitions(spark, described, cfg.snapshot_detail, MONTH)
            # Those partitions hold just these rows, so the summary reads them instead of working them out again.
            written = [{"INVOICE_YEAR": m and m.year, "INVOICE_MONTH": m and m.month} for m in months]
            detail = only_partitions(spark.table(cfg.snapshot_detail), written, MONTH).select(*described.columns)
            summary_rows = _write_partitions(spark, snapshot_summary(detail), cfg.snapshot_summary, MONTH)
    hours_result = replace_table(hours_summary(union_periods(spark, cfg.visit_prefix)), cfg.hours_summary)
    known = spark.createDataFrame([(n.rpartition(".")[2],) for n in tables], "SNAPSHOT string")
    replace_table(known, cfg.snapshot_applied)
    variance = _variance_text(spark.table(cfg.snapshot_summary), shift_month(as_of, -1), True)
    return (
        f"SUCCESS: detail ({detail_rows} rows) | invoice ({summary_rows} rows) | "
        f"hours ({hours_result.rows} rows) | {variance}"
    )


def _write_partitions(spark: SparkSession, rows: DataFrame, name: str, cols: Sequence[str]) -> int:
    """Replace the partitions that ``rows`` have, and no others, in one commit."""
    ensure_table(spark, name, rows.schema, cols)
    counted, count = count_rows(in_table_order(rows, name))
    with dynamic_overwrite(spark):
        balanced(counted, cols).write.mode("overwrite").insertInto(name)
    return count()


def conform(spark: SparkSession, cfg: RevenueConfig, as_of: date) -> str:
    """Merge all refined sources into one table; dated legacy sources end where lines begin."""
    lines = line_branch(spark.table(cfg.line_summary))
    branches = []
    for name in cfg.legacy_dated:
        branches.append(cutover(spark.table(name), lines, cfg.cutover_year)[0])
    branches.append(lines.filter(F.col("INVOICE_YEAR") >= cfg.cutover_year))
    branches.append(spark.table(cfg.snapshot_summary))
    branches += [spark.table(name).drop("CATEGORY_OF_CARE") for name in cfg.legacy_static]
    result = replace_table(all_revenue(branches, spark.table(cfg.companies), cfg.names), cfg.revenue)
    variance = _variance_text(spark.table(cfg.revenue), shift_month(as_of, -1), True)
    return f"SUCCESS: merge complete ({result.rows} rows) | {variance}"


def semantic(spark: SparkSession, cfg: RevenueConfig, as_of: date) -> str:
    """Report rows and exception rows: together, exactly the closed months."""
    with staging(spark) as stage:  # on shared storage, so that a lost executor costs nothing
        master = stage(report_master(spark.table(cfg.revenue), spark.table(cfg.companies), as_of, cfg.names, cfg.excluded_name), "master")
        matched, missing = report_and_exceptions(master)
        good, bad = replace_table(matched, cfg.report), replace_table(missing, cfg.exceptions)
    return f"SUCCESS: report ({good.rows} rows) | exceptions ({bad.rows} rows)"


def run_month(spark: SparkSession, cfg: RevenueConfig, as_of: datetime) -> list[str]:
    """The whole chain for the month before ``as_of``."""
    month = shift_month(as_of, -1)
    return [
        load_files(spark, cfg, as_of),
        load_shared(spark, cfg, as_of),
        *[refine_lines(spark, cfg, r.code, month) for r in cfg.regions],
        refine_snapshots(spark, cfg, as_of),
        conform(spark, cfg, as_of),
        semantic(spark, cfg, as_of.date() if isinstance(as_of, datetime) else as_of),
    ]
