"""Jobs end to end on small synthetic feeds: corrected defects and invariants."""

import csv
import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtables import schemas
from flowtables.plans.invoice_index import InvoiceIndex
from flowtables.plans import contacts, hires, revenue
from flowtables.plans.rules import ContactsConfig, HiresConfig, NameRules, Region, RevenueConfig
from flowtables.sinks.tables import replace_table

NAMES = NameRules(strip_patterns=("(?:Unit|Kiosk) [0-9]+: ",), drop_words=(" /archived",), key_drop_words=("UNIT 7:",))


def write_csv(path, schema, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schema.names)
        for record in records:
            out.writerow([record.get(n, "") for n in schema.names])


def frame(spark, schema, records):
    def fit(field, value):
        return Decimal(value) if value is not None and field.dataType.typeName() == "decimal" else value

    return spark.createDataFrame([tuple(fit(f, r.get(f.name)) for f in schema) for r in records], schema)


# ------------------------------------------------------------------ revenue


@pytest.fixture()
def month(spark, db, folder):
    """February 2026 with one region: repeated headers, two spellings of a branch, out-of-month rows."""
    headers = [
        dict(invoiceid=1, branchid=10, branchname="Unit 7: (North)", created="2026-02-01 00:00:00", updated="2026-02-03 00:00:00", jobtypename="Private", vat=20),
        dict(invoiceid=1, branchid=10, branchname="Unit 7: (North)", created="2026-02-01 00:00:00", updated="2026-02-02 00:00:00", jobtypename="Old", vat=20),
        dict(invoiceid=2, branchid=10, branchname="Kiosk 31: Northern", created="2026-02-05 00:00:00", jobtypename="Private", split="50.0"),
        dict(invoiceid=3, branchid=10, branchname="Unit 7: (North)", created="2026-02-01 00:00:00", updated="2026-03-02 00:00:00", jobtypename="Private"),
        dict(invoiceid=4, branchid=11, branchname="Unknown &amp; Co", created="2026-02-07 00:00:00", manualinvoice=2, jobtypename="Private"),
        dict(invoiceid=5, branchid=11, branchname="Unknown &amp; Co", created="2026-02-07 00:00:00", vat=99),
        dict(invoiceid=6, branchid=12, branchname="Training Centre", created="2026-02-07 00:00:00", vat=99),
    ]
    items = [
        dict(id=1, invoiceid=1, type="timesheet", billing="100.00", invoicehrs="2.5", discountpercent="10", jobtypegroupname="Care"),
        dict(id=2, invoiceid=1, type="timesheet", billing="50.00", invoicehrs="1", discountpercent="10", jobtypegroupname="Care"),
        dict(id=3, invoiceid=1, type="expense", billing="10.00", invoicehrs="0", jobtypegroupname="Care"),
        dict(id=4, invoiceid=1, type="timesheet", billing="999.00", invoicehrs="9", deleted="2026-02-02", jobtypegroupname="Care"),
        dict(id=5, invoiceid=1, type="note", billing="999.00", invoicehrs="9", jobtypegroupname="Care"),
        dict(id=6, invoiceid=2, type="cancelled", billing="200.00", invoicehrs="4", discountpercent="150", jobtypegroupname="Care"),
        dict(id=7, invoiceid=3, type="timesheet", billing="777.00", invoicehrs="7", jobtypegroupname="Care"),
        dict(id=8, invoiceid=4, type="timesheet", billing="888.00", invoicehrs="8", jobtypegroupname="Care"),
        dict(id=9, invoiceid=5, type="timesheet", billing="30.00", invoicehrs="1", jobtypegroupname="Care"),
        dict(id=10, invoiceid=6, type="timesheet", billing="5.00", invoicehrs="1", jobtypegroupname="Care"),
    ]
    write_csv(f"{folder}/land/A_header_2026_02.csv", schemas.INVOICE_HEADER, headers)
    write_csv(f"{folder}/land/A_item_2026_02.csv", schemas.INVOICE_ITEM, items)
    snaps = [
        dict(OFFICE_ID=1, OFFICE_NAME="Unit 7: East", TERRITORY="Untagged", INV_NO="s1", INVOICE_DATE=date(2026, 1, 5), TOTAL_INVOICED=Decimal(100)),
        dict(OFFICE_ID=1, OFFICE_NAME="Unit 7: East", TERRITORY="Untagged", INV_NO="s1", INVOICE_DATE=date(2026, 1, 5), INVOICE_SENT_DATE=date(2026, 1, 9), TOTAL_INVOICED=Decimal(120)),
        dict(OFFICE_ID=1, OFFICE_NAME="Unit 7: East", TERRITORY="Untagged", INV_NO="s1", INVOICE_DATE=date(2026, 1, 5), INVOICE_SENT_DATE=date(2026, 2, 9), TOTAL_INVOICED=Decimal(90)),
        dict(OFFICE_ID=2, OFFICE_NAME="West (Isles) office", TERRITORY="Unit 7: West", INV_NO="s2", INVOICE_DATE=date(2026, 2, 5), TOTAL_INVOICED=Decimal(40)),
        dict(OFFICE_ID=2, OFFICE_NAME="West (Isles) office", TERRITORY="Unit 7: West", INV_NO="s3", INVOICE_DATE=date(2026, 2, 5)),
    ]
    for key, rows in (("2026_1", snaps[:2]), ("2026_2", snaps[2:])):
        replace_table(frame(spark, schemas.INVOICE_SNAPSHOT, rows), f"shared_invoice_{key}")
    visits = [dict(OFFICE_ID=1, PERIOD_END=date(2026, 2, d), CUSTOMERS=Decimal(c), PERIOD_VISITS=Decimal(3), CHARGED_HOURS=Decimal("1.5")) for d, c in ((7, 10), (14, 13))]
    replace_table(frame(spark, schemas.PERIOD_VISIT, visits), "shared_visit_2026_1")
    replace_table(frame(spark, schemas.PERIOD_VISIT, visits), "shared_visit_2026_2")
    company = "ID PROPERTY_NAME PROPERTY_POWER_BI_NAME PROPERTY_POWER_BI_REPORT PROPERTY_TYPE PROPERTY_STATUS PROPERTY_ROSTER_SYSTEM PROPERTY_BDM PROPERTY_FRANCHISEE_1 IS_DELETED".split()
    yes = dict(PROPERTY_POWER_BI_REPORT="Yes", PROPERTY_TYPE="Franchisee", IS_DELETED="FALSE", PROPERTY_STATUS="Open")
    companies = [
        dict(ID="1", PROPERTY_NAME="Unit 7: Northern", PROPERTY_POWER_BI_NAME="PBI North", PROPERTY_BDM="N - lead", **yes),
        dict(ID="2", PROPERTY_NAME="Kiosk 31: (Northern)", PROPERTY_POWER_BI_NAME="PBI North 2", PROPERTY_BDM="N2 - lead", **yes),  # cleans to the same name
        dict(ID="3", PROPERTY_NAME="Unit 7: East", PROPERTY_POWER_BI_NAME="", **yes),
        dict(ID="4", PROPERTY_NAME="West", PROPERTY_POWER_BI_NAME="PBI West", **{**yes, "IS_DELETED": "TRUE"}),
        dict(ID="5", PROPERTY_NAME="Unit 7:", PROPERTY_POWER_BI_NAME="PBI blank key", **yes),
    ]
    schema = schemas.struct_of("\n".join(f"{c} string" for c in company))
    replace_table(frame(spark, schema, companies), "company")
    legacy = [
        dict(COMPANY_NAME="Northern", ROSTER_SYSTEM="SYS-A", INVOICE_YEAR=y, INVOICE_MONTH="Dec", TOT_AMT_INVOICED=Decimal(7), CATEGORY_OF_CARE="c") for y in (2025, 2026)
    ]
    replace_table(frame(spark, schemas.REVENUE, legacy), "legacy_dated")
    replace_table(frame(spark, schemas.REVENUE, legacy).limit(1), "legacy_static")
    return RevenueConfig(
        names=NAMES, regions=(Region("A", "SYS-A"),), landing=f"{folder}/land", legacy_dated=("legacy_dated",), legacy_static=("legacy_static",),
        system_rules=(("%Isles%", "SNAP-ISLES"),), default_system="SNAP",
    )


def test_revenue_month(spark, month):
    as_of = datetime(2026, 3, 1, 8)
    revenue.load_shared(spark, month, datetime(2026, 2, 1, 8))
    messages = revenue.run_month(spark, month, as_of)
    assert all("SUCCESS" in m for m in messages), messages

    summary = {r.BRANCHID: r for r in spark.table(month.line_summary).filter("INVOICE_MONTH = 2").collect()}
    # Invoice 1: 150 less 10 percent; invoice 2: half of 200, the discount is out of range;
    # VAT 20 on the first spelling alone. Invoice 3 is dated in March, invoice 4 is excluded.
    north = summary[10]
    assert (north.TOT_AMT_INVOICED, north.TOT_AMT_EXPENSES, north.TOT_CNT_HOURS) == (262, 12, 8)
    assert north.BRANCHNAME == "Northern" and len(summary) == 3
    assert summary[11].TOT_AMT_INVOICED == 30
    assert {(r.INVOICE_YEAR, r.INVOICE_MONTH, r.LOAD_PERIOD) for r in spark.table(month.line_detail).collect()} == {(2026, 2, "2026_02"), (2026, 3, "2026_02")}
    march = spark.table(month.line_summary).filter("INVOICE_MONTH = 3").collect()
    assert [(r.BRANCHID, r.TOT_AMT_INVOICED) for r in march] == [(10, 777)]

    moved = {(r.INV_NO, r.INVOICE_MONTH): r for r in spark.table(month.snapshot_detail).collect()}
    assert {k: int(r.TOT_AMT_INVOICED) for k, r in moved.items()} == {("s1", 1): 120, ("s1", 2): -30, ("s2", 2): 40}
    assert moved[("s2", 2)].ROSTER_SYSTEM == "SNAP-ISLES" and moved[("s1", 1)].OFFICE_NAME == "East"
    assert {r.COMPANY_NAME for r in spark.table(month.snapshot_summary).collect()} == {"East", "West"}
    hours = spark.table(month.hours_summary).first()
    assert (hours.TOT_CNT_CUSTOMERS, hours.TOT_CNT_VISITS, hours.TOT_CNT_HOURS) == (12, 12, 6)

    merged = spark.table(month.revenue)
    # 1 legacy row before the cut-over + 4 line rows + 3 snapshot rows + 1 static row: the
    # company found under two spellings doubles none of them.
    assert merged.count() == 9
    assert {r.BRANCH_NAME_PBI for r in merged.filter("COMPANY_NAME = 'Northern'").collect()} == {"PBI North 2"}

    report, exceptions = spark.table(month.report), spark.table(month.exceptions)
    assert report.count() + exceptions.count() == merged.filter("COMPANY_NAME not like 'Training%' and INVOICE_MONTH <> 'Mar'").count() == 7
    north = report.filter("INVOICE_YEAR = 2026").first()
    assert north.REPORT_NAME == "PBI North" and north.BD_REGION == "N" and north.TOT_AMT_INVOICED == 274
    assert {r.COMPANY_NAME for r in exceptions.collect()} == {"Unknown & Co", "East", "West"}
    assert "REPORT_NAME" not in exceptions.columns and "LOOKUP_OFFICE_NAME" not in report.columns
    total = sum(r.TOT_AMT_INVOICED for df in (report, exceptions) for r in df.collect())
    assert total == 7 + 7 + 274 + 30 + 120 - 30 + 40


def test_invoices_dated_in_other_months_are_in_exactly_one(spark, month, folder):
    """Two file months, each with invoices dated in the other; one invoice is sent in both."""
    line = dict(branchid=20, branchname="Unit 7: South", jobtypename="Private")
    headers = [dict(invoiceid=20, created="2026-03-03 00:00:00", **line), dict(invoiceid=21, created="2026-02-20 00:00:00", **line), dict(invoiceid=3, created="2026-02-01 00:00:00", updated="2026-03-05 00:00:00", **line)]
    items = [dict(id=30 + i, invoiceid=h["invoiceid"], type="timesheet", billing=f"{10 ** i}.00", invoicehrs="1", jobtypegroupname="Care") for i, h in enumerate(headers)]
    write_csv(f"{folder}/land/A_header_2026_03.csv", schemas.INVOICE_HEADER, headers)
    write_csv(f"{folder}/land/A_item_2026_03.csv", schemas.INVOICE_ITEM, items)
    for as_of, day in ((date(2026, 3, 1), date(2026, 2, 1)), (date(2026, 4, 1), date(2026, 3, 1))):
        revenue.load_files(spark, month, as_of)
        revenue.refine_lines(spark, month, "A", day)

    def totals():
        return {(r.BRANCHID, r.INVOICE_MONTH): r.TOT_AMT_INVOICED for r in spark.table(month.line_summary).filter("BRANCHID in (10, 20)").collect()}

    # Invoice 21 reaches February by the March file; invoice 3 counts as the March file has it.
    want = {(10, 2): 262, (20, 3): 101, (20, 2): 10}
    assert totals() == want
    for day in (date(2026, 2, 1), date(2026, 3, 1)):
        revenue.refine_lines(spark, month, "A", day)
        assert totals() == want


def test_a_load_reads_the_loads_that_hold_its_months(spark, month, folder):
    """The index leads to the partitions of the detail; others are not read, also after a correction."""
    for m in (3, 4, 5):
        header = [dict(invoiceid=100 * m + i, branchid=m, branchname="B", jobtypename="Private", created=f"2026-{m:02d}-03 00:00:00") for i in range(3)]
        item = [dict(id=i, invoiceid=h["invoiceid"], type="timesheet", billing="10.00", invoicehrs="1", jobtypegroupname="Care") for i, h in enumerate(header)]
        if m == 5:  # an April invoice comes again, now dated in May
            header.append(dict(header[0], invoiceid=400))
            item.append(dict(item[0], id=9, invoiceid=400))
        write_csv(f"{folder}/land/A_header_2026_{m:02d}.csv", schemas.INVOICE_HEADER, header)
        write_csv(f"{folder}/land/A_item_2026_{m:02d}.csv", schemas.INVOICE_ITEM, item)
        revenue.load_files(spark, month, date(2026, m + 1, 1))
        revenue.refine_lines(spark, month, "A", date(2026, m, 1))
    label = next(r.label for r in month.regions if r.code == "A")
    index = InvoiceIndex(spark, month.line_index, month.line_detail, label)
    may, april = [date(2026, 5, 1)], [date(2026, 4, 1)]
    live = index.live(may)
    assert sorted((int(r.INVOICEID), r.LOAD_PERIOD) for r in live.collect()) == [(400, "2026_05"), (500, "2026_05"), (501, "2026_05"), (502, "2026_05")]
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = index.current(may, live)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    detail_scan = next(line for line in plan.splitlines() if "FileScan" in line and "BRANCHNAME" in line)
    assert "LOAD_PERIOD" in detail_scan.split("PartitionFilters")[1] and "2026_05" in detail_scan and "2026_04" not in detail_scan
    assert "PushedFilters" in detail_scan and "EqualTo(INVOICE_MONTH,5)" in detail_scan
    # The superseded April row is left out where it was.
    assert sorted(int(r.INVOICEID) for r in index.current(april, index.live(april)).collect()) == [401, 402]
    totals = {(r.BRANCHID, r.INVOICE_MONTH): r.TOT_AMT_INVOICED for r in spark.table(month.line_summary).filter("BRANCHID in (3, 4, 5)").collect()}
    assert totals == {(3, 3): 30, (4, 4): 20, (5, 5): 40}
    # Detail that was stored before there was an index is taken into it.
    spark.sql(f"DROP TABLE {month.line_index}")
    again = InvoiceIndex(spark, month.line_index, month.line_detail, label)
    assert sorted(again.live(may).collect()) == sorted(live.collect())


def test_movement_by_state_equals_a_rebuild(spark, db):
    """Three months, one that corrects an older month, undated rows, and a snapshot applied twice."""
    fields = [f for f in schemas.INVOICE_SNAPSHOT if f.name in ("OFFICE_ID", "OFFICE_NAME", "TERRITORY", "INV_NO", "CARE_TYPE", "FUNDER_TYPE", "INVOICE_DATE", "INVOICE_SENT_DATE", "TOTAL_INVOICED")]
    shape = schemas.T.StructType(fields)

    def row(inv, day, total, sent=None, office=1, care="home"):
        return {"OFFICE_ID": Decimal(office), "OFFICE_NAME": "East", "TERRITORY": "T", "INV_NO": inv, "CARE_TYPE": care, "FUNDER_TYPE": None, "INVOICE_DATE": day, "INVOICE_SENT_DATE": sent, "TOTAL_INVOICED": None if total is None else Decimal(total)}

    def d(m, day=5):
        return date(2026, m, day)

    months = {
        "2026_1": [row("a", d(1), 100), row("b", d(1), 50), row("b", d(1, 9), 55), row("n", d(1), 7, care=None), row("u", None, 3)],
        "2026_2": [row("a", d(2), 130), row("c", d(2), 10), row("b", d(1, 9), 55), row("n", d(2), 9, care=None), row("z", d(2), None)],
        "2026_3": [row("a", d(3), 90), row("b", d(3), 60), row("u", d(3), 4), row("m", d(2), 1), row("m", d(3), 5)],
        # January of a and b is corrected, and c gets a month before its first.
        "2026_4": [row("a", d(1, 20), 111), row("b", d(1, 30), 40), row("c", d(1), 2), row("c", d(4), 12), row("n", d(2), 9, care=None)],
        "2026_5": [row("a", d(5), 95), row("q", d(5), 1)],
    }
    cfg = RevenueConfig(snapshot_prefix=f"{db}.snap_", snapshot_detail=f"{db}.moved", snapshot_summary=f"{db}.summed", snapshot_state=f"{db}.state", snapshot_applied=f"{db}.applied", visit_prefix=f"{db}.visit_", hours_summary=f"{db}.hours", amount_type="decimal(18,2)")
    spark.createDataFrame([], schemas.PERIOD_VISIT).write.saveAsTable(f"{db}.visit_2026_1")
    rows = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    for name, own in months.items():
        spark.createDataFrame(own, shape).write.saveAsTable(f"{db}.snap_{name}")
        before = {f for f in spark.table(cfg.snapshot_detail).inputFiles()} if name != "2026_1" else set()
        assert revenue.refine_snapshots(spark, cfg, date(2026, 6, 1)).startswith("SUCCESS")
        whole = revenue.snapshot_detail(revenue.union_periods(spark, cfg.snapshot_prefix), cfg.names, cfg.system_rules, cfg.default_system, cfg.amount_type)
        assert rows(spark.table(cfg.snapshot_detail)) == rows(whole), name
        assert rows(spark.table(cfg.snapshot_summary)) == rows(revenue.snapshot_summary(whole)), name
        if name == "2026_5":  # one new month: nothing else was written
            assert before <= set(spark.table(cfg.snapshot_detail).inputFiles())
    state = revenue._snapshot_state(cfg)
    held = rows(spark.table(cfg.snapshot_state))
    state.advance(spark, revenue.sent_invoices(spark.table(f"{db}.snap_2026_4")))
    assert rows(spark.table(cfg.snapshot_state)) == held
    revenue.refine_snapshots(spark, cfg, date(2026, 6, 1), rebuild=True)
    assert rows(spark.table(cfg.snapshot_detail)) == rows(whole) and rows(spark.table(cfg.snapshot_state)) == held


def test_revenue_rerun_changes_nothing(spark, month):
    as_of = datetime(2026, 3, 1, 8)
    revenue.load_shared(spark, month, datetime(2026, 2, 1, 8))
    names = [month.line_detail, month.line_summary, month.snapshot_detail, month.revenue, month.report, month.exceptions]

    def state():
        return [sorted(map(repr, spark.table(n).collect())) for n in names]

    revenue.run_month(spark, month, as_of)
    first = state()
    messages = revenue.run_month(spark, month, as_of)
    assert messages[0].count("SKIPPED") == 2 and messages[1].count("SKIPPED") == 2
    assert state() == first
    revenue.refine_lines(spark, month, "A", date(2026, 2, 1), merge=True)
    assert state() == first


def test_merge_keeps_vanished_groups_and_replace_drops_them(spark, month):
    revenue.load_files(spark, month, date(2026, 3, 1))
    revenue.refine_lines(spark, month, "A", date(2026, 2, 1))
    gone = spark.table(month.line_summary).limit(1).withColumn("CATEGORY_OF_CARE", F.lit("gone"))
    gone.write.insertInto(month.line_summary)
    revenue.refine_lines(spark, month, "A", date(2026, 2, 1), merge=True)
    assert spark.table(month.line_summary).filter("CATEGORY_OF_CARE = 'gone'").count() == 1
    revenue.refine_lines(spark, month, "A", date(2026, 2, 1))
    assert spark.table(month.line_summary).filter("CATEGORY_OF_CARE = 'gone'").count() == 0


# ------------------------------------------------------------------ contacts


@pytest.fixture()
def contact_cfg(spark, db, folder):
    cfg = ContactsConfig(
        names=NAMES, inbox=f"{folder}/in", outbox=f"{folder}/out", updates_inbox=f"{folder}/upd", updates_checkpoint=f"{folder}/cp",
    )
    os.makedirs(cfg.inbox)
    os.makedirs(cfg.updates_inbox)
    set_companies(spark, [("Unit 7: North & South", "FILE"), ("Unit 7: East", "TABLE")])
    return cfg


def set_companies(spark, pairs):
    rows = [(str(i), n, s, "FALSE", "Franchisee") for i, (n, s) in enumerate(pairs)]
    replace_table(spark.createDataFrame(rows, "ID string, PROPERTY_NAME string, PROPERTY_ROSTER_SYSTEM string, IS_DELETED string, PROPERTY_TYPE string"), "company")


def drop_contacts(cfg, name, objects):
    with open(f"{cfg.inbox}/{name}", "w") as f:
        f.write(json.dumps(objects) if not isinstance(objects, str) else objects)


def person(i, office, modified="2024-01-01", **extra):
    return dict(hs_object_id=i, id=i, office_location=office, contact_type="Care Receiver", lastmodifieddate=modified, **extra)


def test_contact_ingest(spark, contact_cfg):
    cfg, as_of = contact_cfg, datetime(2024, 6, 10, 9, 55)
    drop_contacts(cfg, "contacts_1.json", [person("1", " North & South "), person("2", "Later"), person(3, "East", phone=None)])
    drop_contacts(cfg, "contacts_2.json", [person("1", "East", "2024-02-01"), person("", "East"), person("", "North & South")])
    drop_contacts(cfg, "contacts_3.json", "[]")
    drop_contacts(cfg, "contacts_4.json", '[{"hs_object_id": "9", "office_location": "East {\\"x\\"}"}, {"hs_object_id": "10"')
    drop_contacts(cfg, "ignored.json", [person("8", "East")])
    message = contacts.ingest(spark, cfg, as_of)
    assert message == "NEW: Files=4 | JSON=7 | Inserted=6 | Updated=0 | Unmapped=2 | Unreadable=contacts_4.json"
    rows = {r.HS_OBJECT_ID: r for r in spark.table(cfg.contacts).collect()}
    # Delivered twice in one batch: stored once, as modified last. Rows without an id all stay.
    assert rows["1"].ROSTER_SYSTEM == "TABLE" and rows["3"].PHONE == "" and rows["2"].ROSTER_SYSTEM is None
    assert spark.table(cfg.contacts).filter("HS_OBJECT_ID = ''").count() == 2
    # The good element of the damaged file is stored once; the file waits until it is mended.
    assert contacts.ingest(spark, cfg, as_of) == "NEW: Files=1 | JSON=1 | Inserted=0 | Updated=0 | Unmapped=2 | Unreadable=contacts_4.json"
    drop_contacts(cfg, "contacts_4.json", [person("9", "East"), person("10", "East")])
    assert contacts.ingest(spark, cfg, as_of) == "NEW: Files=1 | JSON=2 | Inserted=1 | Updated=1 | Unmapped=1"
    assert contacts.ingest(spark, cfg, as_of).startswith("NEW: Files=0")

    set_companies(spark, [("Unit 7: North & South", "FILE"), ("Unit 7: East", "TABLE"), ("Later", "FILE"), ("Kiosk 31: (Later)", "TABLE")])
    drop_contacts(cfg, "contacts_5.json", [person("3", "East"), person("4", "East")])
    assert contacts.ingest(spark, cfg, datetime(2024, 7, 1)) == "NEW: Files=1 | JSON=2 | Inserted=1 | Updated=1 | Unmapped=0"
    rows = {r.HS_OBJECT_ID: r for r in spark.table(cfg.contacts).collect()}
    assert rows["2"].ROSTER_SYSTEM == "FILE" and rows["2"].LOAD_MONTH == "2024-06" and rows["4"].LOAD_MONTH == "2024-07"
    log = spark.table(cfg.log).filter("TASK_NAME = 'contacts_ingest'").collect()
    assert len(log) == 5 and all(r.STATUS == "SUCCESS" for r in log)
    assert max(r.PROCESSED_FILES or "" for r in log) == "contacts_5.json"


def test_contacts_are_sent_exactly_once(spark, contact_cfg):
    cfg, as_of = contact_cfg, datetime(2024, 6, 10, 9, 55)
    drop_contacts(cfg, "contacts_1.json", [person("1", "North & South"), person("2", "East", date_of_birth="5/1/1950"), dict(person("3", "East"), contact_type="Lead"), person("", "East"), person("", "Later")])
    contacts.ingest(spark, cfg, as_of)
    outbound = schemas.struct_of(
        "\n".join(f"{c} {'date' if c == 'DATE_OF_BIRTH' else 'string'}" for c in contacts.OUTBOUND_FIELDS)
        + "\nLAST_UPDATE_TIMESTAMP timestamp_ntz\nPROCESSED_TIMESTAMP timestamp_ntz\nFAILURE_REASON string"
    )
    replace_table(spark.createDataFrame([], outbound), cfg.outbound)
    assert "Sent=1 in Contacts_New_20240610_105500.csv" in contacts.send_csv(spark, cfg, as_of)
    with open(f"{cfg.outbox}/Contacts_New_20240610_105500.csv", newline="") as f:
        lines = list(csv.DictReader(f))
    assert [(r["hs_object_id"], r["customer_status"]) for r in lines] == [("1", "Active")]
    assert list(lines[0]) == contacts.CSV_FIELDS
    # Rows without an id: sending one system stamps neither the other system nor the unmapped row.
    assert spark.table(cfg.contacts).filter("HS_OBJECT_ID = '' and SENT_TIMESTAMP is null").count() == 2
    assert "Sent=2" in contacts.send_table(spark, cfg, as_of)
    assert spark.table(cfg.contacts).filter("HS_OBJECT_ID = '' and SENT_TIMESTAMP is null and ROSTER_SYSTEM is null").count() == 1
    assert contacts.send_csv(spark, cfg, as_of).endswith("Pending=0") and contacts.send_table(spark, cfg, as_of).endswith("Pending=0")
    sent = spark.table(cfg.outbound).filter("HS_OBJECT_ID <> ''").collect()
    assert [(r.HS_OBJECT_ID, r.DATE_OF_BIRTH, r.PROCESSED_TIMESTAMP) for r in sent] == [("2", date(1950, 1, 5), as_of)]
    stamps = {r.HS_OBJECT_ID: r.SENT_TIMESTAMP for r in spark.table(cfg.contacts).filter("HS_OBJECT_ID <> ''").collect()}
    assert stamps == {"1": datetime(2024, 6, 10, 10, 55), "2": as_of, "3": None}


def test_acks_survive_the_new_year(spark, contact_cfg):
    acks = [("1", datetime(2024, 12, 30)), ("1", datetime(2024, 12, 30)), ("2", datetime(2025, 1, 3)), ("3", datetime(2024, 3, 1))]
    rows = [(i, "t", "o", "f", "l", t, None) for i, t in acks]
    replace_table(spark.createDataFrame(rows, "HS_OBJECT_ID string, CONTACT_TYPE string, OFFICE_LOCATION string, FIRSTNAME string, LASTNAME string, PROCESSED_TIMESTAMP timestamp_ntz, FAILURE_REASON string"), "inbound_acks")
    as_of = datetime(2025, 1, 5)
    assert contacts.pull_acks(spark, contact_cfg, as_of) == "ACK: Before=0 | After=2 | New=2"
    assert contacts.pull_acks(spark, contact_cfg, as_of) == "ACK: Before=2 | After=2 | New=0"


def test_updates_from_files(spark, contact_cfg):
    cfg = contact_cfg
    replace_table(spark.createDataFrame([("7", "p7")], "ID string, PORTAL_ID string"), cfg.contacts)
    write_csv(f"{cfg.outbox}/map.csv", schemas.STATUS_MAP, [dict(SOURCE_STATUS="Paused", TARGET_STATUS="On hold")])
    assert contacts.load_status_map(spark, cfg, f"{cfg.outbox}/map.csv").rows == 1
    one = dict(HS_OBJECT_ID="7", CUSTOMER_STATUS="Archived", CUSTOMER_STATUS_2="Paused", CITY="")
    write_csv(f"{cfg.updates_inbox}/a.csv", schemas.STATUS_UPDATE, [one, one, dict(one, HS_OBJECT_ID=""), dict(one, HS_OBJECT_ID="8", CUSTOMER_STATUS_2="Other")])
    message = contacts.updates_from_files(spark, cfg, datetime(2024, 1, 10, 9))
    assert "STG=4 (valid=3) | Inserted=2 | Dupes=1" in message and "Sent=2" in message
    objects = json.load(open(f"{cfg.outbox}/CUSTOMER_UPDATE_updates_files_20240110_090000.json"))
    by_id = {o["HS_OBJECT_ID"]: o for o in objects}
    assert by_id["7"]["CUSTOMER_STATUS"] == "Finished" and by_id["7"]["CUSTOMER_STATUS_2"] == "On hold" and by_id["7"]["PORTAL_ID"] == "p7"
    assert by_id["7"]["CITY"] == "" and "PORTAL_ID" not in by_id["8"]
    write_csv(f"{cfg.updates_inbox}/b.csv", schemas.STATUS_UPDATE, [one])
    assert "Inserted=0 | Dupes=1 | UPD: Pending=0" in contacts.updates_from_files(spark, cfg, datetime(2024, 1, 11, 9))
    # A malformed file beside a good one: its lines are set aside, and later runs go on.
    write_csv(f"{cfg.updates_inbox}/c.csv", schemas.STATUS_UPDATE, [dict(one, HS_OBJECT_ID="9")])
    with open(f"{cfg.updates_inbox}/bad.csv", "w") as f:
        f.write(",".join(schemas.STATUS_UPDATE.names) + '\nonly,"three\nfields"\n')
    message = contacts.updates_from_files(spark, cfg, datetime(2024, 1, 12, 9))
    assert "STG=1 (valid=1) | Inserted=1 | Dupes=0 | Rejected=2" in message, message
    assert spark.read.parquet(f"{cfg.updates_checkpoint}_rejected").count() == 2
    write_csv(f"{cfg.updates_inbox}/d.csv", schemas.STATUS_UPDATE, [dict(one, HS_OBJECT_ID="10")])
    message = contacts.updates_from_files(spark, cfg, datetime(2024, 1, 13, 9))
    assert "Inserted=1" in message and "Rejected" not in message


def test_updates_from_table(spark, contact_cfg):
    cfg = contact_cfg
    replace_table(spark.createDataFrame([("1", "p1")], "ID string, PORTAL_ID string"), cfg.contacts)
    t = datetime(2024, 1, 1)

    def share(*rows):
        replace_table(spark.createDataFrame(list(rows), "HS_OBJECT_ID string, CUSTOMER_STATUS string, CUSTOMER_STATUS_2 string, LAST_UPDATE_TIMESTAMP timestamp_ntz"), cfg.updates_shared)

    share(("1", "ASSESSMENT COMPLETED", "Other care service", t), ("", "ACTIVE", None, t))
    assert "New=2 | UPD: Pending=1 | Sent=1" in contacts.updates_from_table(spark, cfg, datetime(2024, 1, 2))
    share(("1", "ACTIVE", None, t), ("2", "ACTIVE", None, t))  # a late row at the maximum
    assert "New=1 | UPD: Pending=1" in contacts.updates_from_table(spark, cfg, datetime(2024, 1, 3))
    stored = {r.HS_OBJECT_ID: r for r in spark.table(cfg.updates_table).collect()}
    assert (stored["1"].CUSTOMER_STATUS, stored["1"].CUSTOMER_STATUS_2) == ("Active", "Alternative provider")
    assert stored[""].SENT_TO_HS_TIMESTAMP is None


def test_failures_are_logged_not_raised(spark, contact_cfg):
    cfg = ContactsConfig(inbox=contact_cfg.inbox + "/missing")
    assert contacts.ingest(spark, cfg, datetime(2024, 1, 1)).startswith("NEW ERROR")
    assert spark.table(cfg.log).first().STATUS == "FAILURE"


# ------------------------------------------------------------------ hires


def test_hires(spark, db, folder):
    cfg = HiresConfig(outbox=f"{folder}/out")

    def hire(first, day, office, email=None, last="L"):
        return dict(CANDIDATE_NAME_TITLE="Mx", CANDIDATE_PROTECTED_NAME_FIRST=first, CANDIDATE_PROTECTED_NAME_LAST=last,
                    CANDIDATE_PROTECTED_EMAIL=email, DATE_IN_STATUS_3=day, HIERARCHY_NAME=office, CANDIDATE_DOB="01/01/1990")

    def roster(*pairs):
        replace_table(spark.createDataFrame(list(pairs), "COMPANY_NAME string, ROSTER_SYSTEM string"), cfg.roster)

    people = [
        hire("A", "1/2/2024 9:05", " north ", "a@example.org"), hire("A", "1/2/2024 9:05", " north "),
        hire("B", "02/02/2024 10:00", "East"), hire("C", "soon", "North"), hire(None, "03/02/2024 10:00", "North", "x"), hire(None, "03/02/2024 10:00", "North", "y", last=None),
    ]
    replace_table(frame(spark, schemas.HIRED, people), cfg.source)
    replace_table(spark.createDataFrame([], schemas.struct_of("\n".join(f"{c} string" for c in hires.SENT_FIELDS) + "\nSENT_TIMESTAMP timestamp_ntz")), cfg.outbound)
    roster(("NORTH", "FILE"), (" north", "FILE"))
    assert hires.process(spark, cfg, datetime(2024, 2, 5)) == "HIRES: New: 4, Retry: 0, Total: 4 processed."
    assert spark.table(cfg.source).count() == 5
    target = {(r.CANDIDATE_PROTECTED_NAME_FIRST, r.CANDIDATE_PROTECTED_EMAIL): r for r in spark.table(cfg.target).collect()}
    assert target[("A", "a@example.org")].ROSTER_SYSTEM == "FILE" and target[("B", None)].ROSTER_SYSTEM is None
    assert target[("A", "a@example.org")].STATUS_MONTH == "2024-02" and len(target) == 4

    roster(("NORTH", "FILE"), ("East", "TABLE"))
    late = people + [hire("D", "03/02/2024 10:00", "East")]  # a late one at the last minute taken
    replace_table(frame(spark, schemas.HIRED, late), cfg.source)
    message = hires.process(spark, cfg, datetime(2024, 2, 6))
    assert message.startswith("HIRES: New: ") and "Retry: 1" in message
    rows = {r.CANDIDATE_PROTECTED_NAME_FIRST: r for r in spark.table(cfg.target).filter("CANDIDATE_PROTECTED_NAME_FIRST is not null").collect()}
    # Appended by name: every column of the retried row is still its own.
    assert rows["B"].ROSTER_SYSTEM == "TABLE" and rows["B"].HIERARCHY_NAME == "East" and rows["B"].CANDIDATE_DOB == "01/01/1990"
    assert rows["D"].ROSTER_SYSTEM == "TABLE"
    assert [r.STATUS for r in spark.table(cfg.tracking).orderBy("CREATED_TIMESTAMP", "STATUS").collect()] == ["SUCCESS", "RETRY", "SUCCESS"]

    assert "Sent=" in hires.send_csv(spark, cfg, datetime(2024, 2, 6)) and "Sent=2" in hires.send_table(spark, cfg, datetime(2024, 2, 6))
    assert {r.NAME_FIRST for r in spark.table(cfg.outbound).collect()} == {"B", "D"}
    assert spark.table(cfg.target).filter("SENT_TIMESTAMP is null").count() == 0
    with open(f"{cfg.outbox}/CARERS_HIRED_20240206_000000.csv", newline="") as f:
        assert list(csv.DictReader(f).fieldnames) == list(hires.SENT_FIELDS)


def test_hires_of_one_name_and_nameless_hires(spark, db, folder):
    """Same name and minute under two titles: both stay; a nameless hire is stored once however often it runs."""
    cfg = HiresConfig(outbox=f"{folder}/out")

    def hire(title, first):
        return dict(CANDIDATE_NAME_TITLE=title, CANDIDATE_PROTECTED_NAME_FIRST=first, CANDIDATE_PROTECTED_NAME_LAST="L", DATE_IN_STATUS_3="03/02/2024 10:00", HIERARCHY_NAME="North")

    replace_table(frame(spark, schemas.HIRED, [hire("Mx", "A"), hire("Dr", "A"), hire(None, "A"), hire("Mx", None)]), cfg.source)
    replace_table(spark.createDataFrame([("NORTH", "FILE")], "COMPANY_NAME string, ROSTER_SYSTEM string"), cfg.roster)
    assert hires.process(spark, cfg, datetime(2024, 2, 5)) == "HIRES: New: 4, Retry: 0, Total: 4 processed."
    for day in (6, 7):
        assert hires.process(spark, cfg, datetime(2024, 2, day)) == "HIRES: New: 0, Retry: 0, Total: 0 processed."
    assert spark.table(cfg.target).count() == 4 and spark.table(cfg.tracking).count() == 1
