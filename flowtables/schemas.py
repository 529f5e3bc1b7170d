"""Fixed schemas of the inputs and outputs, and conforming a frame to one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
}


def struct_of(text: str) -> T.StructType:
    """Build a schema from ``name type`` lines."""
    fields = []
    for line in filter(None, (part.strip() for part in text.strip().splitlines())):
        name, kind = line.split(None, 1)
        scaled = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
        dtype = T.DecimalType(*map(int, scaled.groups())) if scaled else _TYPES[kind]
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


# The 26 columns of an invoice header file, in file order.
INVOICE_HEADER = struct_of("""
    invoiceid decimal(38,0)
    companyid decimal(38,0)
    locationid decimal(38,0)
    created timestamp_ntz
    updated timestamp_ntz
    branchid decimal(38,0)
    branchname string
    clientid decimal(38,0)
    invoicenum decimal(38,0)
    split decimal(38,14)
    splittype string
    splitvalue string
    invoicetype string
    jobtypeid string
    jobtypename string
    manualinvoice decimal(38,0)
    areaid decimal(38,0)
    areaname string
    workgroupid string
    workgroupname string
    invoicetemplateid decimal(38,0)
    invoicenumber string
    paymentdue string
    periodstart date
    periodfinish date
    vat decimal(38,0)
""")

# The 72 columns of an invoice item file, in file order.
INVOICE_ITEM = struct_of("""
    id decimal(38,0)
    type string
    subtype string
    created timestamp_ntz
    createdby decimal(38,0)
    deleted string
    deletedby string
    invoiceid decimal(38,0)
    timesheetid decimal(38,0)
    expenseid string
    companyid decimal(38,0)
    locationid decimal(38,0)
    logdate date
    clientid decimal(38,0)
    carerid decimal(38,0)
    areaid decimal(38,0)
    payabletime string
    jobtypeid decimal(38,0)
    billing decimal(38,5)
    billingdecimals decimal(38,5)
    billingallocatedlimited string
    billingcalled string
    billingrate string
    billingscaleid decimal(38,0)
    billingscalename string
    pay decimal(38,4)
    paycalled string
    payrate string
    payscaleid decimal(38,0)
    payscalename string
    invoiceshortdate string
    invoiceweekdate string
    invoicetimeactual string
    invoicetimesched string
    invoicecarername string
    jobtypename string
    invoicejobtypename string
    invoicepo string
    invoicecarerposition string
    invoicehrs decimal(38,6)
    invoiceallocatedlimitedhrs string
    discountpercent string
    discounttotal string
    invoicesplitarray string
    invoicesplitarraypay string
    invoiceadminsignid string
    invoiceadminsignname string
    invoicecarersign string
    invoicetravelmetric string
    invoicetraveldistance decimal(38,2)
    invoicetraveldeduction string
    invoicetravelrate string
    invoicetravelvalue string
    expensedescription string
    wtramountvalue decimal(38,2)
    wtramountpercent decimal(38,2)
    comissionvalue decimal(38,0)
    comissiontotal decimal(38,0)
    employersnivalue string
    employersnipercent string
    preview decimal(38,0)
    invoicebreakminutes string
    invoicebreakpaid string
    numberinvoicepage string
    billingfiscalmonth string
    billingweekending date
    earnedfiscalmonth string
    earnedfiscalweek date
    jobtypegroupid decimal(38,0)
    jobtypegroupname string
    jobtypegroupcode string
    manualinvoice string
""")

INVOICE_SNAPSHOT = struct_of("""
    OFFICE_ID decimal(38,0)
    OFFICE_NAME string
    TERRITORY string
    INV_NO string
    CARE_TYPE string
    FUNDER_TYPE string
    INVOICE_DATE date
    INVOICE_SENT_DATE date
    TOTAL_INVOICED decimal(38,2)
""")

PERIOD_VISIT = struct_of("""
    OFFICE_ID decimal(38,0)
    PERIOD_END date
    CUSTOMERS decimal(18,4)
    PERIOD_VISITS decimal(18,4)
    CHARGED_HOURS decimal(18,4)
""")

# The conformed revenue shape: every source is brought to these 13 columns.
REVENUE = struct_of("""
    COMPANY_NAME string
    ROSTER_SYSTEM string
    INVOICE_YEAR int
    INVOICE_MONTH string
    CARE_TYPE string
    FUNDER_TYPE string
    CATEGORY_OF_CARE string
    TOT_AMT_INVOICED decimal(38,2)
    TOT_SUM_MSF decimal(38,2)
    TOT_SUM_HOURS decimal(38,2)
    TOT_CNT_CUSTOMERS decimal(38,2)
    TOT_CNT_CARERS decimal(38,2)
    TOT_AMT_EXPENSES decimal(38,2)
""")

# The text and timestamp fields of one contact object.
CONTACT_TEXT_FIELDS = """
    address care_receiver_id city contact_type country customer_status
    customer_status_2 customer_status_other customer_type date_of_birth email
    family_member_ids firstname hs_object_id
    hs_time_to_move_from_opportunity_to_customer id lastname marital_status
    mobilephone office_location phone portal_id relationship_to_customer__dependant_
    roster_account_number roster_provider salutation service_type service_type_2
    service_type_2_other source source_2 state won_reason zip
""".split()
CONTACT_TIME_FIELDS = "createdate hs_sa_first_engagement_date lastmodifieddate".split()
CONTACT_FIELDS = sorted(CONTACT_TEXT_FIELDS + CONTACT_TIME_FIELDS)

CONTACTS = struct_of(
    "ROSTER_SYSTEM string\n"
    + "\n".join(
        f"{name.upper()} {'timestamp_ntz' if name in CONTACT_TIME_FIELDS else 'string'}"
        for name in CONTACT_FIELDS
    )
    + "\nSENT_TIMESTAMP timestamp_ntz\nCREATED_AT timestamp_ntz"
)

CONTACT_ACKS = struct_of("""
    HS_OBJECT_ID string
    CONTACT_TYPE string
    OFFICE_LOCATION string
    FIRSTNAME string
    LASTNAME string
    PROCESSED_TIMESTAMP timestamp_ntz
    FAILURE_REASON string
    CREATED_AT timestamp_ntz
""")

STATUS_UPDATE_FIELDS = """
    HS_OBJECT_ID FIRSTNAME SURNAME CUSTOMER_STATUS CUSTOMER_STATUS_2
    CUSTOMER_STATUS_OTHER ADDRESS CITY ZIP COUNTRY EMAIL MOBILEPHONE PHONE CONTACT_TYPE
""".split()
STATUS_UPDATE = struct_of("\n".join(f"{name} string" for name in STATUS_UPDATE_FIELDS))
UPDATES_FROM_FILES = struct_of(
    "\n".join(f"{name} string" for name in [*STATUS_UPDATE_FIELDS, "ROW_HASH"])
    + "\nCREATED_AT timestamp_ntz\nSENT_TIMESTAMP timestamp_ntz"
)
UPDATES_FROM_TABLE = struct_of(
    "HS_OBJECT_ID string\nOFFICE_LOCATION string\n"
    + "\n".join(f"{name} string" for name in STATUS_UPDATE_FIELDS[1:])
    + "\nLAST_UPDATE_TIMESTAMP timestamp_ntz\nSENT_TO_HS_TIMESTAMP timestamp_ntz"
)

# The columns of a hired person, in file order.
HIRED_FIELDS = """
    CANDIDATE_NAME_TITLE CANDIDATE_PROTECTED_NAME_FIRST CANDIDATE_PROTECTED_NAME_LAST
    CANDIDATE_PROTECTED_EMAIL CANDIDATE_PROTECTED_TELEPHONE CANDIDATE_PROTECTED_MOBILE
    CANDIDATE_ADDRESS_FULL_COUNTRY CANDIDATE_PROTECTED_POSTCODE CANDIDATE_DOB
    CANDIDATE_NATIONALITY QUESTIONBANK_462_ANSWER QUESTIONBANK_604_ANSWER
    QUESTIONBANK_1030_ANSWER QUESTIONBANK_1204_ANSWER QUESTIONBANK_1205_ANSWER
    HIERARCHY_NAME _HIERARCHY_PATH DATE_IN_STATUS_3
""".split()
HIRED = struct_of("\n".join(f"{name} string" for name in HIRED_FIELDS))
HIRED_TARGET = struct_of(
    "ROSTER_SYSTEM string\n"
    + "\n".join(f"{name} string" for name in HIRED_FIELDS)
    + "\nDATE_IN_STATUS_3_TS timestamp_ntz"
    + "\nPROCESSED_TIMESTAMP timestamp_ntz\nSENT_TIMESTAMP timestamp_ntz"
)

AUDIT_LOG = struct_of("""
    LOG_TIMESTAMP timestamp_ntz
    TASK_NAME string
    RETURN_MESSAGE string
    PROCESSED_FILES string
    STATUS string
""")
STATUS_MAP = struct_of("""
    SOURCE_STATUS string
    TARGET_STATUS string
""")
FILE_LEDGER = struct_of("""
    file_name string
    processed_at timestamp_ntz
""")
TRACKING = struct_of("""
    TRACKING_ID string
    MAX_DATE timestamp_ntz
    STATUS string
    RECORDS_PROCESSED bigint
    CREATED_TIMESTAMP timestamp_ntz
    UPDATED_TIMESTAMP timestamp_ntz
""")


def null_of(dtype: T.DataType | str) -> Column:
    """A NULL with a type, so that a union or a table never gets a void column."""
    return F.lit(None).cast(dtype)


def cast_text(value: str, field: T.StructField) -> str:
    """SQL text casting ``value`` to the type and name of a field.

    Wide files have 72 columns; a list of texts builds such a projection in one call.
    """
    return f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`"


def conform(df: DataFrame, schema: T.StructType, positional: bool = False) -> DataFrame:
    """Cast ``df`` to ``schema`` by name, or by position when ``positional``.

    Casts are ANSI casts: the first value that does not fit stops the query.
    """
    if positional:
        if len(df.columns) != len(schema):
            raise ValueError(f"expected {len(schema)} columns, found {len(df.columns)}")
        df = df.toDF(*schema.names)
    return df.selectExpr(*[cast_text(f"`{f.name}`", f) for f in schema])


def pad_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``; columns it lacks become typed NULLs."""
    have = {name.lower() for name in df.columns}
    return df.selectExpr(*[cast_text(f"`{f.name}`" if f.name.lower() in have else "NULL", f) for f in schema])
