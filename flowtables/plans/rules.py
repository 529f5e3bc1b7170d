"""What differs between installations, and the value lists that do not."""

from __future__ import annotations

from dataclasses import dataclass, field

# Item types that are billed, and the manual-invoice code that is not.
BILLED_TYPES = ("timesheet", "expense", "cancelled")
EXCLUDED_MANUAL_CODE = 2

# Contact types that are sent on.
SENT_CONTACT_TYPES = ("Customer Family", "Care Receiver")

# Status words of the file feed and of the table feed.
FILE_STATUS = {"Active": "Active", "Pending": "Inactive", "Archived": "Finished"}
TABLE_STATUS = {
    "ACTIVE": "Active",
    "INACTIVE": "Inactive",
    "FINISHED": "Finished",
    "ASSESSMENT COMPLETED": "Active",
}
TABLE_STATUS_2 = {
    "Hospital COVID-19 suspected": "Covid-19",
    "Deceased COVID-19 suspected": "Deceased",
    "Other care service": "Alternative provider",
}

# Company rows that count for reports.
REPORT_COMPANIES = {"IS_DELETED": "FALSE", "PROPERTY_TYPE": "Franchisee", "PROPERTY_POWER_BI_REPORT": "Yes"}
LIVE_COMPANIES = {"IS_DELETED": "FALSE", "PROPERTY_TYPE": "Franchisee"}


@dataclass(frozen=True)
class NameRules:
    """Brand words and patterns to strip from names; none by default."""

    strip_patterns: tuple[str, ...] = ()
    drop_words: tuple[str, ...] = ()
    key_drop_words: tuple[str, ...] = ()


@dataclass(frozen=True)
class Region:
    """One source region: its code in file names and its system label."""

    code: str
    label: str


@dataclass(frozen=True)
class RevenueConfig:
    """Table and file names of the revenue flow."""

    names: NameRules = field(default_factory=NameRules)
    regions: tuple[Region, ...] = ()
    landing: str = ""
    file_name: str = "{region}_{kind}_{period}.csv"
    header_table: str = "invoice_header"
    item_table: str = "invoice_item"
    snapshot_source: str = "shared_invoice_"
    snapshot_prefix: str = "invoice_snapshot_"
    visit_source: str = "shared_visit_"
    visit_prefix: str = "period_visit_"
    line_detail: str = "invoice_line_detail"
    line_index: str = "invoice_line_index"
    line_summary: str = "invoice_line_summary"
    snapshot_detail: str = "snapshot_detail"
    snapshot_state: str = "snapshot_state"
    snapshot_applied: str = "snapshot_applied"
    snapshot_summary: str = "snapshot_summary"
    hours_summary: str = "hours_summary"
    legacy_dated: tuple[str, ...] = ()
    legacy_static: tuple[str, ...] = ()
    companies: str = "company"
    revenue: str = "revenue_all"
    report: str = "revenue_report"
    exceptions: str = "revenue_exception"
    system_rules: tuple[tuple[str, str], ...] = ()
    default_system: str = "SNAPSHOT"
    cutover_year: int = 2026
    amount_type: str = "decimal(38,0)"
    excluded_name: str = "%TRAINING%"


@dataclass(frozen=True)
class ContactsConfig:
    """Table, folder and system names of the contact flow."""

    names: NameRules = field(default_factory=NameRules)
    inbox: str = ""
    file_glob: str = "*.json"
    file_part: str = "contacts_"
    whole_file_arrays: bool = True
    ledger: str = "processed_files"
    contacts: str = "contacts"
    companies: str = "company"
    log: str = "audit_log"
    file_system: str = "FILE"
    table_system: str = "TABLE"
    outbox: str = ""
    single_file: bool = True
    outbound: str = "outbound_contacts"
    acks: str = "contact_acks"
    inbound_acks: str = "inbound_acks"
    updates_inbox: str = ""
    updates_checkpoint: str = ""
    updates_files: str = "updates_files"
    status_map: str = "status_map"
    updates_shared: str = "updates_shared"
    updates_table: str = "updates_table"


@dataclass(frozen=True)
class HiresConfig:
    """Table, folder and system names of the hire flow."""

    source: str = "hired"
    target: str = "hired_target"
    tracking: str = "hired_tracking"
    roster: str = "roster_lookup"
    log: str = "audit_log"
    file_system: str = "FILE"
    table_system: str = "TABLE"
    outbox: str = ""
    single_file: bool = True
    outbound: str = "outbound_hired"
