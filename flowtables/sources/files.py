"""Delimited and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowtables.functions.dates import safe_timestamp
from flowtables.functions.text import blank_if_null, last_part
from flowtables.schemas import cast_text

# Texts that stand for NULL in an invoice file.
NULL_TOKENS = ("", "NULL", "null")
_CORRUPT = "__corrupt"
# A complete object of plain values inside a text: braces, with quoted texts skipped over.
_OBJECT = r'\{(?:[^{}"\\]++|"(?:[^"\\]++|\\.)*+")*+\}'


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def read_typed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Positional CSV with one header line, trimmed, NULL tokens resolved, typed.

    A row with the wrong number of fields, or a value that does not fit its type, stops the
    load.  Fields are read as text first, because a NULL token has to be recognised in
    numeric and date columns too.  Files stay splittable unless ``multi_line`` is asked for.
    """
    # Most fields of a wide file are one token, of which the parser makes no text; blanks have to be NULL with it.
    parsed = next(filter(None, null_tokens), "") if "" in null_tokens else ""
    raw = (
        spark.read.schema(text_schema(schema))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", parsed)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("multiLine", multi_line)
        .csv(path)
    )
    tokens = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in null_tokens)

    def resolved(name: str) -> str:
        text = f"trim(`{name}`)"
        return f"CASE WHEN {text} NOT IN ({tokens}) THEN {text} END"

    return raw.selectExpr(*[cast_text(resolved(f.name) if tokens else f"trim(`{f.name}`)", f) for f in schema])


def keep_blank(df: DataFrame) -> DataFrame:
    """Every text field as read, an empty one as ``''``: the landing rule, without trimming."""
    return df.select(*[blank_if_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def landing_options() -> dict[str, str]:
    """CSV options of a record of the landing feed: optional quotes, nothing trimmed."""
    return {
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
    }


def landing_schema(schema: T.StructType) -> T.StructType:
    """Text fields of a landing record, and the whole text of one that does not fit them."""
    return T.StructType([*text_schema(schema).fields, T.StructField(_CORRUPT, T.StringType())])


def parsed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields of ``records`` (record, fits); one that doesn't fit keeps its whole text beside what could be read of it."""
    wide = landing_schema(schema)
    one = F.from_csv("record", ", ".join(f"`{n}` string" for n in wide.names), landing_options())
    bad = F.when(~F.col("fits") | F.col(f"r.{_CORRUPT}").isNotNull(), F.col("record"))
    return records.select(one.alias("r"), "record", "fits").select(*[F.col(f"r.`{n}`").alias(n) for n in wide.names[:-1]], bad.alias(_CORRUPT))


def landed_rows(rows: DataFrame) -> DataFrame:
    """Rows that fit, every field as read; the landing rule."""
    return keep_blank(rows.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT))


def rejected_lines(rows: DataFrame) -> DataFrame:
    """Records that don't fit, as ``line`` beside what was read of their fields."""
    return rows.filter(F.col(_CORRUPT).isNotNull()).withColumnRenamed(_CORRUPT, "line")


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Paths and base names under a folder, without reading file contents."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", last_part("path").alias("file_name"))


def paths_of(files: DataFrame) -> list[str]:
    """Paths as a list for one read call.

    It is no longer than the file listing Spark's own readers hold on the driver.
    """
    return sorted(row.path for row in files.select("path").distinct().collect())


def read_json_array(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    with_file: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """One row per element of the outer array of each file.

    Empty arrays and explicit nulls give no row.  Of an array that breaks off or is damaged the
    complete elements are taken, if they are objects of plain values; ``unreadable_json`` names
    its file.  All files are one parallel read, one task per file.  Without
    ``multi_line`` every line is an array of its own and large files are split over tasks.
    """
    rows = _json(spark, paths, schema, multi_line)
    names = [f"`{name}`" for name in schema.names]
    name_of_file = [F.col("_metadata.file_name").alias("file_name")] if with_file else []
    one = F.array(F.struct(*names))
    elements = F.when(F.col(_CORRUPT).isNull(), one).otherwise(_salvaged(schema))
    kept = rows.select(F.explode(elements).alias("__e"), *name_of_file)
    filled = F.coalesce(*[F.col(f"__e.{name}").cast("string") for name in names]).isNotNull()
    return kept.filter(filled).select(*[F.col(f"__e.{name}") for name in names], *[F.col("file_name") for _ in name_of_file])


def read_array_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """One row per element of arrays that stand one element a line, as ``export_json_array`` writes them, or of its parts.

    The brackets and commas of the array stand before or behind the objects, so lines are read
    by themselves and a large file is split over tasks; ``read_json_array`` reads an array of
    any layout, in one task per file.  Rows without any value are left out, as there.
    """
    lines = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    parsed = lines.select(F.from_json(F.btrim("value", F.lit("[], \t\r")), schema).alias("__e"))
    filled = F.coalesce(*[F.col(f"__e.`{n}`") for n in schema.names]).isNotNull()
    return parsed.filter(filled).select(*[F.col(f"__e.`{n}`") for n in schema.names])


def _salvaged(schema: T.StructType) -> Column:
    """Elements of a text the file reader gave up on: as an array, or else the complete objects in it.

    The reader refuses an array that holds an explicit null; its other elements are good.
    """
    objects = F.regexp_extract_all(F.col(_CORRUPT), F.lit(_OBJECT), F.lit(0))
    return F.coalesce(_whole_array(schema), F.transform(objects, lambda text: F.from_json(text, schema)))


def _whole_array(schema: T.StructType) -> Column:
    return F.from_json(F.col(_CORRUPT), T.ArrayType(schema))


def unreadable_json(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Names of the files of which ``read_json_array`` takes complete elements only."""
    # Spark refuses a query on the corrupt-record column alone, so one more is read with it.
    bad = F.col(_CORRUPT).isNotNull() & F.col(f"`{schema.names[0]}`").isNull() & _whole_array(schema).isNull()
    return _json(spark, paths, schema, multi_line).filter(bad).select(F.col("_metadata.file_name").alias("file_name")).distinct()


def _json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = True) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return (
        spark.read.schema(wide)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(paths if isinstance(paths, str) else list(paths))
    )


def json_schema(text_fields: Sequence[str], time_fields: Sequence[str] = ()) -> T.StructType:
    """All fields as text: typed later, field by field, without losing a row."""
    return T.StructType([T.StructField(name, T.StringType()) for name in [*text_fields, *time_fields]])


def project_json(df: DataFrame, text_fields: Sequence[str], time_fields: Sequence[str]) -> DataFrame:
    """Upper-case columns: text with NULL as ``''``, times parsed safely."""
    return df.select(
        *[blank_if_null(F.col(name).cast("string")).alias(name.upper()) for name in text_fields],
        *[safe_timestamp(F.col(name).cast("string")).alias(name.upper()) for name in time_fields],
    )


def project_variant(
    df: DataFrame,
    json_col: str,
    text_fields: Sequence[str],
    time_fields: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """The same projection from one JSON text column; unparsable text gives empty fields."""
    parsed = df.withColumn("__v", F.try_parse_json(json_col))

    def field(name: str):
        return F.try_variant_get("__v", f"$.{name}", "string")

    return parsed.select(
        *keep,
        *[blank_if_null(field(name)).alias(name.upper()) for name in text_fields],
        *[safe_timestamp(field(name)).alias(name.upper()) for name in time_fields],
    )
