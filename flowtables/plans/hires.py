"""Hired people: deduplicated, matched to a roster system, upserted, sent on."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowtables import schemas
from flowtables.functions.dates import day_first_timestamp, file_stamp, local_time, ntz
from flowtables.functions.text import blank_if_null, plain_key
from flowtables.operators.conform import append_by_name
from flowtables.operators.delta import conform_names, retry_unmapped, tracked_delta
from flowtables.operators.filters import pending
from flowtables.operators.joins import lookup_by_key
from flowtables.operators.merge import merge_upsert
from flowtables.operators.windows import keep_latest, latest_first
from flowtables.plans.outbox import flush
from flowtables.plans.rules import HiresConfig
from flowtables.session import staging
from flowtables.sinks.exports import export_csv
from flowtables.sinks.tables import append_outbound, append_table, audited, change_table, ensure_table, rewrite_if_nonempty

# The target is partitioned by the month of the status date, which is part of the merge
# key: a match or an insert always falls in the partition of its own date.  Two people may share
# name and minute, so the title belongs to the key; a missing part equals a missing part.
STATUS_MONTH = "STATUS_MONTH"
MERGE_KEYS = ["CANDIDATE_NAME_TITLE", "CANDIDATE_PROTECTED_NAME_FIRST", "CANDIDATE_PROTECTED_NAME_LAST", "DATE_IN_STATUS_3"]

# Columns of the exported file and of the outbound table, in order.
SENT_FIELDS = {
    "TITLE": "CANDIDATE_NAME_TITLE",
    "NAME_FIRST": "CANDIDATE_PROTECTED_NAME_FIRST",
    "NAME_LAST": "CANDIDATE_PROTECTED_NAME_LAST",
    "DOB": "CANDIDATE_DOB",
    "ADDRESS_FULL": "CANDIDATE_ADDRESS_FULL_COUNTRY",
    "POSTCODE": "CANDIDATE_PROTECTED_POSTCODE",
    "AREA": "QUESTIONBANK_1205_ANSWER",
    "EMAIL": "CANDIDATE_PROTECTED_EMAIL",
    "TELEPHONE": "CANDIDATE_PROTECTED_TELEPHONE",
    "MOBILE": "CANDIDATE_PROTECTED_MOBILE",
    "NATIONALITY": "CANDIDATE_NATIONALITY",
    "GENDER": "QUESTIONBANK_462_ANSWER",
    "POSITION": "QUESTIONBANK_1030_ANSWER",
    "NI_NUMBER": "QUESTIONBANK_604_ANSWER",
    "TRANSPORT_TYPE": "QUESTIONBANK_1204_ANSWER",
    "OFFICE_LOCATION": "HIERARCHY_NAME",
}


# ---------------------------------------------------------------- transformations


def unique_hires(hired: DataFrame) -> DataFrame:
    """One row per person and status date, preferring one with an e-mail address."""
    return keep_latest(hired, MERGE_KEYS, [latest_first(blank_if_null("CANDIDATE_PROTECTED_EMAIL"))])


def hire_delta(hired: DataFrame, tracking: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Hires after the last successful run; a late one at the same minute is not lost."""
    return tracked_delta(
        hired, tracking, day_first_timestamp("DATE_IN_STATUS_3"), "DATE_IN_STATUS_3_TS", target, MERGE_KEYS
    )


def roster_of(rows: DataFrame, roster: DataFrame) -> DataFrame:
    return lookup_by_key(
        rows, roster, plain_key("HIERARCHY_NAME"), plain_key("COMPANY_NAME"), ["ROSTER_SYSTEM"],
        [F.col("ROSTER_SYSTEM").asc_nulls_last()],
    )


def retried_hires(target: DataFrame, roster: DataFrame) -> DataFrame:
    """Earlier unmapped hires that the roster now knows."""
    return retry_unmapped(
        target.select(*schemas.HIRED_TARGET.names), roster, plain_key("HIERARCHY_NAME"), plain_key("COMPANY_NAME")
    ).drop("PROCESSED_TIMESTAMP")


def upsert_set(delta: DataFrame, retried: DataFrame, roster: DataFrame, as_of: datetime) -> DataFrame:
    """New and retried hires, one row per merge key."""
    new = roster_of(delta, roster).withColumn("SENT_TIMESTAMP", schemas.null_of("timestamp_ntz"))
    both = append_by_name(new.select(*retried.columns), retried)
    stamped = both.withColumn("PROCESSED_TIMESTAMP", ntz(as_of.replace(tzinfo=None)))
    keyed = stamped.withColumns({f"__key{i}": blank_if_null(k) for i, k in enumerate(MERGE_KEYS)})
    names = [f"__key{i}" for i in range(len(MERGE_KEYS))]
    return keep_latest(keyed, names, [F.col("ROSTER_SYSTEM").asc_nulls_last()]).drop(*names)


def merge_hires(target: DataFrame, changes: DataFrame) -> DataFrame:
    return merge_upsert(target, changes, MERGE_KEYS, ["ROSTER_SYSTEM", "PROCESSED_TIMESTAMP"], blank_null=MERGE_KEYS)


def sent_columns(rows: DataFrame) -> DataFrame:
    return conform_names(rows, SENT_FIELDS)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(STATUS_MONTH, F.date_format("DATE_IN_STATUS_3_TS", "yyyy-MM"))


# ---------------------------------------------------------------- jobs


def process(spark: SparkSession, cfg: HiresConfig, as_of: datetime) -> str:
    def job() -> tuple[str, str | None]:
        ensure_table(spark, cfg.tracking, schemas.TRACKING)
        wide = T.StructType([*schemas.HIRED_TARGET.fields, T.StructField(STATUS_MONTH, T.StringType())])
        ensure_table(spark, cfg.target, wide, [STATUS_MONTH])
        rewrite_if_nonempty(unique_hires(spark.table(cfg.source)), cfg.source)

        target = spark.table(cfg.target)
        with staging(spark) as stage:
            delta = stage(hire_delta(spark.table(cfg.source), spark.table(cfg.tracking), target), "hires")
            again = stage(retried_hires(target, spark.table(cfg.roster)), "retries")
            changes = stage(_with_month(upsert_set(delta, again, spark.table(cfg.roster), as_of)), "upserts")
            totals = delta.agg(F.count("*").alias("n"), F.max("DATE_IN_STATUS_3_TS").alias("latest")).first()
            new, retried = totals.n, again.count()
            change_table(spark, cfg.target, changes, lambda rows: merge_hires(rows, changes))
        if new:
            append_table(_tracking_row(spark, ntz(totals.latest), "SUCCESS", new, as_of), cfg.tracking)
        if retried > 0:
            append_table(_tracking_row(spark, ntz(as_of.replace(tzinfo=None)), "RETRY", retried, as_of), cfg.tracking)
        return f"HIRES: New: {new}, Retry: {retried}, Total: {new + retried} processed.", None

    return audited(spark, cfg.log, "hires_process", as_of, job, "HIRES")


def _tracking_row(spark: SparkSession, mark: Column, status: str, rows: int, as_of: datetime) -> DataFrame:
    now = ntz(as_of.replace(tzinfo=None))
    return spark.range(1).select(
        F.lit(uuid.uuid4().hex).alias("TRACKING_ID"), mark.alias("MAX_DATE"), F.lit(status).alias("STATUS"),
        F.lit(rows).cast("bigint").alias("RECORDS_PROCESSED"),
        now.alias("CREATED_TIMESTAMP"), now.alias("UPDATED_TIMESTAMP"),
    )


def send_csv(spark: SparkSession, cfg: HiresConfig, as_of: datetime) -> str:
    name = f"CARERS_HIRED_{file_stamp(as_of)}.csv"
    return audited(
        spark, cfg.log, "hires_send_csv", as_of,
        lambda: flush(
            spark, cfg.target, lambda rows: pending(rows, cfg.file_system),
            lambda batch: export_csv(sent_columns(batch), cfg.outbox, name, cfg.single_file).path,
            [*MERGE_KEYS, "ROSTER_SYSTEM"], local_time(as_of), "HIRES to file",
        ),
        "HIRES to file",
    )


def send_table(spark: SparkSession, cfg: HiresConfig, as_of: datetime) -> str:
    stamp = local_time(as_of)

    def write(batch: DataFrame) -> None:
        mapping = {new: F.col(old).cast("string") for new, old in SENT_FIELDS.items()}
        append_outbound(batch, cfg.outbound, {**mapping, "SENT_TIMESTAMP": ntz(stamp)})

    return audited(
        spark, cfg.log, "hires_send_table", as_of,
        lambda: flush(
            spark, cfg.target, lambda rows: pending(rows, cfg.table_system), write, [*MERGE_KEYS, "ROSTER_SYSTEM"], stamp, "HIRES to table"
        ),
        "HIRES to table",
    )
