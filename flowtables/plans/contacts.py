"""Contacts: JSON files in, two ways out, acknowledgements and status updates back."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowtables import schemas
from flowtables.functions.dates import day_first_date, file_stamp, local_time, ntz
from flowtables.functions.text import clean_name, compact_key, is_filled, row_hash
from flowtables.functions.values import map_values
from flowtables.operators.aggregates import counts
from flowtables.operators.delta import after_watermark, hash_delta, high_watermark, mark_processed, new_files, retry_unmapped
from flowtables.operators.filters import flagged, pending
from flowtables.operators.joins import enrich, lookup_by_key, map_codes, new_rows
from flowtables.operators.merge import missing_rows, update_from
from flowtables.operators.windows import keep_latest
from flowtables.plans.outbox import flush
from flowtables.plans.rules import (
    FILE_STATUS, LIVE_COMPANIES, SENT_CONTACT_TYPES, TABLE_STATUS, TABLE_STATUS_2, ContactsConfig, NameRules,
)
from flowtables.session import staging
from flowtables.sinks.exports import export_csv, export_json_array
from flowtables.sinks.tables import LoadResult, append_outbound, append_table, audited, change_table, ensure_table, replace_table
from flowtables.sources.files import json_schema, list_files, paths_of, project_json, read_json_array, read_typed_csv, unreadable_json
from flowtables.streaming.ingest import for_new_files

# Mutable tables are partitioned by the month a row came in, so that stamping or completing
# recent rows rewrites recent months only.
LOAD_MONTH = "LOAD_MONTH"

# What tells sent rows from unsent ones. Several rows may lack an id, so the columns that
# choose a batch belong to the key: a row of another system is never stamped with it.
SENT_KEYS = ["HS_OBJECT_ID", "CREATED_AT", "ROSTER_SYSTEM", "CONTACT_TYPE"]

# Columns of the exported contact file and of the outbound table, in order.
CSV_FIELDS = """
    hs_object_id firstname lastname salutation customer_status customer_status_2
    customer_status_other date_of_birth address city zip country email mobilephone phone
    contact_type care_receiver_id family_member_ids marital_status office_location
    service_type service_type_2 lastmodifieddate
""".split()
OUTBOUND_FIELDS = """
    HS_OBJECT_ID CONTACT_TYPE OFFICE_LOCATION SERVICE_TYPE SERVICE_TYPE_2 CUSTOMER_TYPE
    CUSTOMER_STATUS CUSTOMER_STATUS_2 CUSTOMER_STATUS_OTHER DATE_OF_BIRTH SALUTATION
    FIRSTNAME LASTNAME ADDRESS CITY COUNTRY ZIP MOBILEPHONE PHONE EMAIL MARITAL_STATUS
    CARE_RECEIVER_ID FAMILY_MEMBER_IDS
""".split()


def with_month(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(LOAD_MONTH, T.StringType())])


def month_of(as_of: datetime) -> str:
    return f"{as_of.year}-{as_of.month:02d}"


# ---------------------------------------------------------------- transformations


def one_per_contact(rows: DataFrame) -> DataFrame:
    """The last modified row of each contact in a batch; rows without an id all stay."""
    known = F.when(is_filled("HS_OBJECT_ID"), F.col("HS_OBJECT_ID"))
    return keep_latest(rows, [known], [F.col("LASTMODIFIEDDATE").desc_nulls_last()], keep_null_keys=True)


def company_systems(companies: DataFrame, names: NameRules = NameRules()) -> DataFrame:
    """Soft key and roster system of each live company."""
    shown = clean_name("PROPERTY_NAME", names.strip_patterns)
    live = companies.filter(flagged(LIVE_COMPANIES))
    return live.select(compact_key(shown).alias("OFFICE_KEY"), F.col("PROPERTY_ROSTER_SYSTEM").alias("ROSTER_SYSTEM"))


def map_to_system(contacts: DataFrame, systems: DataFrame) -> DataFrame:
    """Roster system by office; a name listed with two systems takes the smaller one."""
    rows = contacts.drop("ROSTER_SYSTEM")
    return lookup_by_key(
        rows, systems, compact_key("OFFICE_LOCATION"), "OFFICE_KEY", ["ROSTER_SYSTEM"], [F.col("ROSTER_SYSTEM").asc_nulls_last()]
    )


def complete_systems(contacts: DataFrame, systems: DataFrame, delivered: DataFrame) -> DataFrame:
    """Contacts without a system get the one of their office, else of their new delivery.

    A blank id says nothing about who a contact is, so it never finds a delivery.
    """
    own = map_to_system(contacts.withColumnRenamed("ROSTER_SYSTEM", "__stored"), systems)
    mapped = own.withColumn("ROSTER_SYSTEM", F.coalesce("__stored", "ROSTER_SYSTEM")).select(*contacts.columns)
    known = delivered.filter(is_filled("HS_OBJECT_ID")).select("HS_OBJECT_ID", "ROSTER_SYSTEM")
    return update_from(mapped, known, "HS_OBJECT_ID", ["ROSTER_SYSTEM"], F.col("ROSTER_SYSTEM").isNull())


def contact_csv(rows: DataFrame) -> DataFrame:
    fixed: dict[str, Column] = {"customer_status": F.lit("Active")}
    return rows.select(*[fixed.get(c, F.col(c)).cast("string").alias(c) for c in CSV_FIELDS])


def outbound_mapping(stamp: datetime) -> dict[str, str | Column]:
    mapping: dict[str, str | Column] = {c: c for c in OUTBOUND_FIELDS}
    mapping["DATE_OF_BIRTH"] = day_first_date("DATE_OF_BIRTH")
    mapping["LAST_UPDATE_TIMESTAMP"] = "LASTMODIFIEDDATE"
    mapping["PROCESSED_TIMESTAMP"] = ntz(stamp)
    mapping["FAILURE_REASON"] = schemas.null_of("string")
    return mapping


def recent_acks(acks: DataFrame, as_of: datetime, grace_days: int = 31) -> DataFrame:
    """Acknowledgements of this year, and of the last weeks of the year before in January."""
    start = min(datetime(as_of.year, 1, 1), as_of.replace(tzinfo=None) - timedelta(days=grace_days))
    end = datetime(as_of.year + 1, 1, 1)
    kept = acks.filter((F.col("PROCESSED_TIMESTAMP") >= ntz(start)) & (F.col("PROCESSED_TIMESTAMP") < ntz(end)))
    return kept.withColumn("HS_OBJECT_ID", F.col("HS_OBJECT_ID").cast("string"))


def file_updates(landed: DataFrame, status_map: DataFrame) -> DataFrame:
    """Landed rows with an id, fingerprinted as they came and then translated."""
    hashed = landed.filter(is_filled("HS_OBJECT_ID")).withColumn("ROW_HASH", row_hash(schemas.STATUS_UPDATE_FIELDS))
    mapped = map_codes(hashed, status_map, "CUSTOMER_STATUS_2", "SOURCE_STATUS", "TARGET_STATUS")
    return mapped.withColumn("CUSTOMER_STATUS", map_values("CUSTOMER_STATUS", FILE_STATUS))


def table_updates(shared: DataFrame) -> DataFrame:
    return shared.withColumn("CUSTOMER_STATUS", map_values("CUSTOMER_STATUS", TABLE_STATUS)).withColumn(
        "CUSTOMER_STATUS_2", map_values("CUSTOMER_STATUS_2", TABLE_STATUS_2)
    )


def update_objects(updates: DataFrame, contacts: DataFrame) -> DataFrame:
    """Objects for the update file: the status fields and the portal of the contact."""
    portals = contacts.select("ID", "PORTAL_ID")
    filled = updates.filter(is_filled("HS_OBJECT_ID"))
    return enrich(filled, portals, ("HS_OBJECT_ID", "ID"), ["PORTAL_ID"]).select(*schemas.STATUS_UPDATE_FIELDS, "PORTAL_ID")


# ---------------------------------------------------------------- jobs


def ingest(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Load new contact files, map them to systems, complete earlier rows, insert new ones.

    An id that is stored already is not inserted again; that includes the blank id.
    """

    def job() -> tuple[str, str | None]:
        ensure_table(spark, cfg.ledger, schemas.FILE_LEDGER)
        ensure_table(spark, cfg.contacts, with_month(schemas.CONTACTS), [LOAD_MONTH])
        files = list_files(spark, cfg.inbox, cfg.file_glob)
        fresh = files.join(new_files(files, spark.table(cfg.ledger), cfg.file_part), "file_name", "left_semi")
        paths = paths_of(fresh)
        if not paths:
            return "NEW: Files=0 | No new files to process", None

        names = ", ".join(sorted(p.rsplit("/", 1)[-1] for p in paths))
        with staging(spark) as stage:
            return _store(spark, cfg, as_of, paths, fresh, stage), names

    return audited(spark, cfg.log, "contacts_ingest", as_of, job, "NEW")


def _store(
    spark: SparkSession,
    cfg: ContactsConfig,
    as_of: datetime,
    paths: list[str],
    fresh: DataFrame,
    stage: Callable[[DataFrame, str], DataFrame],
) -> str:
    fields = schemas.CONTACT_TEXT_FIELDS, schemas.CONTACT_TIME_FIELDS
    schema = json_schema(*fields)
    raw = read_json_array(spark, paths, schema, multi_line=cfg.whole_file_arrays)
    broken = [r.file_name for r in unreadable_json(spark, paths, schema, cfg.whole_file_arrays).collect()]
    delta = stage(project_json(raw, *fields), "delta")
    systems = company_systems(spark.table(cfg.companies), cfg.names)
    mapped = stage(
        map_to_system(one_per_contact(delta), systems)
        .withColumn("SENT_TIMESTAMP", schemas.null_of("timestamp_ntz"))
        .withColumn("CREATED_AT", ntz(as_of.replace(tzinfo=None)))
        .withColumn(LOAD_MONTH, F.lit(month_of(as_of))),
        "mapped",
    )
    contacts = spark.table(cfg.contacts)
    # The months in which a waiting row can be completed; only those are rewritten.
    completed = stage(
        retry_unmapped(contacts, systems, compact_key("OFFICE_LOCATION"), "OFFICE_KEY").select(LOAD_MONTH)
        .unionByName(_newly_mapped(contacts, mapped)).distinct(),
        "months",
    )
    waiting = F.col("ROSTER_SYSTEM").isNull()
    before = contacts.filter(waiting).count()
    change_table(spark, cfg.contacts, completed, lambda old: complete_systems(old, systems, mapped))
    updated = before - spark.table(cfg.contacts).filter(waiting).count()
    inserted = append_table(new_rows(mapped, spark.table(cfg.contacts), ["HS_OBJECT_ID"]), cfg.contacts).rows
    # A damaged file stays out of the ledger: its other contacts arrive once it is mended.
    whole = fresh.select("file_name").filter(~F.col("file_name").isin(broken)).distinct()
    append_table(mark_processed(spark.table(cfg.ledger), whole, as_of), cfg.ledger)
    totals = counts(spark.table(cfg.contacts), {"UNMAPPED": waiting}).first()
    message = (
        f"NEW: Files={len(paths)} | JSON={delta.count()} | Inserted={inserted} | "
        f"Updated={updated} | Unmapped={totals.UNMAPPED}"
    )
    return message + (f" | Unreadable={', '.join(sorted(broken))}" if broken else "")


def _newly_mapped(contacts: DataFrame, mapped: DataFrame) -> DataFrame:
    """Months of the unmapped contacts that a new file delivers again, now with a system."""
    waiting = contacts.filter(F.col("ROSTER_SYSTEM").isNull() & is_filled("HS_OBJECT_ID")).select("HS_OBJECT_ID", LOAD_MONTH)
    known = mapped.filter(F.col("ROSTER_SYSTEM").isNotNull()).select(F.col("HS_OBJECT_ID"), "ROSTER_SYSTEM")
    found = enrich(waiting, known, ("HS_OBJECT_ID", "HS_OBJECT_ID"), ["ROSTER_SYSTEM"])
    return found.filter(F.col("ROSTER_SYSTEM").isNotNull()).select(LOAD_MONTH)


def load_status_map(spark: SparkSession, cfg: ContactsConfig, path: str) -> LoadResult:
    """Load the small status mapping from its CSV file."""
    return replace_table(read_typed_csv(spark, path, schemas.STATUS_MAP), cfg.status_map)


def send_csv(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Unsent contacts of the file system: one CSV batch, then stamped."""
    name = f"Contacts_New_{file_stamp(as_of)}.csv"
    return audited(
        spark, cfg.log, "contacts_send_csv", as_of,
        lambda: flush(
            spark, cfg.contacts,
            lambda rows: pending(rows, cfg.file_system, SENT_CONTACT_TYPES),
            lambda batch: export_csv(contact_csv(batch), cfg.outbox, name, cfg.single_file).path,
            SENT_KEYS, local_time(as_of), "NEW to file",
        ),
        "NEW to file",
    )


def send_table(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Unsent contacts of the table system: appended to the outbound table, then stamped."""
    stamp = as_of.replace(tzinfo=None)

    def write(batch: DataFrame) -> None:
        append_outbound(batch, cfg.outbound, outbound_mapping(stamp))

    return audited(
        spark, cfg.log, "contacts_send_table", as_of,
        lambda: flush(
            spark, cfg.contacts,
            lambda rows: pending(rows, cfg.table_system, SENT_CONTACT_TYPES),
            write, SENT_KEYS, stamp, "NEW to table",
        ),
        "NEW to table",
    )


def pull_acks(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Append acknowledgements not stored yet; nothing stored is rewritten."""

    def job() -> tuple[str, str | None]:
        ensure_table(spark, cfg.acks, schemas.CONTACT_ACKS)
        stored = spark.table(cfg.acks)
        before = stored.count()
        cols = schemas.CONTACT_ACKS.names[:-1]
        fresh = missing_rows(stored, recent_acks(spark.table(cfg.inbound_acks), as_of).select(*cols), ["HS_OBJECT_ID", "PROCESSED_TIMESTAMP"])
        new = append_table(fresh.withColumn("CREATED_AT", ntz(as_of.replace(tzinfo=None))), cfg.acks).rows
        return f"ACK: Before={before} | After={before + new} | New={new}", None

    return audited(spark, cfg.log, "contacts_pull_acks", as_of, job, "ACK")


def updates_from_files(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Arriving status files: deduplicated by fingerprint, translated, exported, stamped.

    The stream checkpoint stands in for the landing table: a batch that fails is handed
    over again, and its fingerprints keep it from being stored twice.
    """

    def job() -> tuple[str, str | None]:
        ensure_table(spark, cfg.updates_files, with_month(schemas.UPDATES_FROM_FILES), [LOAD_MONTH])
        seen = {"landed": 0, "valid": 0, "inserted": 0, "rejected": 0}

        def work(landed: DataFrame, _: int) -> None:
            tally = counts(landed, {"VALID": is_filled("HS_OBJECT_ID")}).first()
            updates = file_updates(landed, spark.table(cfg.status_map))
            fresh = hash_delta(updates, spark.table(cfg.updates_files), schemas.STATUS_UPDATE_FIELDS)
            stamped = fresh.withColumn("CREATED_AT", ntz(local_time(as_of))).withColumn(LOAD_MONTH, F.lit(month_of(as_of)))
            seen["landed"] += tally.TOTAL
            seen["valid"] += tally.VALID
            seen["inserted"] += append_table(stamped, cfg.updates_files).rows

        def reject(lines: int) -> None:
            seen["rejected"] += lines

        for_new_files(spark, cfg.updates_inbox, schemas.STATUS_UPDATE, cfg.updates_checkpoint, work, reject)
        message, files = _send_updates(spark, cfg, cfg.updates_files, "SENT_TIMESTAMP", ["ROW_HASH"], as_of)
        head = f"STG={seen['landed']} (valid={seen['valid']}) | Inserted={seen['inserted']} | Dupes={seen['valid'] - seen['inserted']}"
        if seen["rejected"]:
            head += f" | Rejected={seen['rejected']}"
        return f"UPD from files: {head} | {message}", files

    return audited(spark, cfg.log, "contacts_updates_files", as_of, job, "UPD from files")


def updates_from_table(spark: SparkSession, cfg: ContactsConfig, as_of: datetime) -> str:
    """Changed rows of a shared table since the last watermark, exported and stamped."""

    def job() -> tuple[str, str | None]:
        ensure_table(spark, cfg.updates_table, with_month(schemas.UPDATES_FROM_TABLE), [LOAD_MONTH])
        stored = spark.table(cfg.updates_table)
        mark = high_watermark(stored, "LAST_UPDATE_TIMESTAMP")
        fresh = after_watermark(spark.table(cfg.updates_shared), "LAST_UPDATE_TIMESTAMP", mark, stored, ["HS_OBJECT_ID"])
        new = append_table(table_updates(fresh).withColumn(LOAD_MONTH, F.lit(month_of(as_of))), cfg.updates_table).rows
        keys = ["HS_OBJECT_ID", "LAST_UPDATE_TIMESTAMP"]
        message, files = _send_updates(spark, cfg, cfg.updates_table, "SENT_TO_HS_TIMESTAMP", keys, as_of)
        return f"UPD from table: New={new} | {message}", files

    return audited(spark, cfg.log, "contacts_updates_table", as_of, job, "UPD from table")


def _send_updates(
    spark: SparkSession, cfg: ContactsConfig, table: str, stamp_col: str, keys: list[str], as_of: datetime
) -> tuple[str, str | None]:
    name = f"CUSTOMER_UPDATE_{table}_{file_stamp(as_of)}.json"
    return flush(
        spark, table,
        lambda rows: pending(rows, stamp_col=stamp_col).filter(is_filled("HS_OBJECT_ID")),
        lambda batch: export_json_array(update_objects(batch, spark.table(cfg.contacts)), cfg.outbox, name, cfg.single_file).path,
        keys, local_time(as_of), "UPD", stamp_col,
    )

