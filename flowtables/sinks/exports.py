"""CSV and JSON files for other parties.

The layout is the caller's choice and never depends on the size of the batch: one file, or a
folder of parts.  All tasks write in either, and nothing is left out.  One file is put together
from finished parts: by the file system itself where it can concatenate (no byte moves), else as
one stream of bytes; no task gathers rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowtables.session import remove_path, scratch_path

_CSV = {"quoteAll": "true", "quote": '"', "escape": '"', "emptyValue": "", "compression": "none"}
#: Rows of one compressed part, which a reader can't split.
_PACKED_ROWS = 200_000
#: Rows of a task are numbered from 0 in these bits; its own number is above them.
_ROW_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Export:
    """Where an export went: one file, or a folder of parts."""

    path: str
    single: bool


def export_csv(
    df: DataFrame,
    folder: str,
    name: str,
    single_file: bool = True,
    null_value: str = "\\N",
    compression: str = "none",
) -> Export:
    """Header, every field quoted, NULL as an explicit token so that it differs from ``''``.

    Parts may be compressed, for wide rows that are mostly tokens; they are cut by rows then.
    """
    if single_file and compression != "none":
        raise ValueError("only parts can be compressed")
    spark = df.sparkSession
    texts = df.selectExpr(*[f"CAST(`{c}` AS string) AS `{c}`" for c in df.columns])
    options = {**_CSV, "nullValue": null_value, "compression": compression}
    if not single_file:
        if compression != "none":
            options["maxRecordsPerFile"] = _PACKED_ROWS
        texts.write.mode("overwrite").options(header="true", **options).csv(f"{folder}/{name}")
        return Export(f"{folder}/{name}", False)
    header = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns) + "\n"
    staging = scratch_path(spark, "export")
    try:
        texts.write.options(header="false", maxRecordsPerFile="0", **options).csv(staging)
        return Export(_assemble(spark, staging, folder, name, header), True)
    finally:
        remove_path(spark, staging)


def export_json_array(
    df: DataFrame,
    folder: str,
    name: str,
    single_file: bool = True,
) -> Export:
    """One array of objects, keys with NULL left out; without ``single_file`` JSON Lines parts."""
    objects = df.select(F.to_json(F.struct(*df.columns)).alias("line"))
    if not single_file:
        objects.write.mode("overwrite").text(f"{folder}/{name}")
        return Export(f"{folder}/{name}", False)
    spark = df.sparkSession
    staging = scratch_path(spark, "export")
    try:
        array_lines(objects).write.option("maxRecordsPerFile", 0).text(staging)
        return Export(_assemble(spark, staging, folder, name, "[", ",", "]\n"), True)
    finally:
        remove_path(spark, staging)


def array_lines(objects: DataFrame, col: str = "line") -> DataFrame:
    """Lines in ascending order, each but a task's first with the comma that parts it from the one before.

    What stands before a task's first line depends on the tasks before it, so it is added when
    the parts are joined.  Equal lines may be in several tasks; the joined bytes are the same
    however the lines were cut.
    """
    ordered = objects.select(col, F.monotonically_increasing_id().alias("__n")).orderBy(col, "__n").select(col)
    numbered = ordered.withColumn("__row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    return numbered.select(F.concat(F.when(F.col("__row") == 0, "").otherwise(","), col).alias(col))


def _assemble(spark: SparkSession, staging: str, folder: str, name: str, head: str, between: str = "", tail: str = "") -> str:
    """One file of ``head``, the parts of ``staging`` with ``between`` between them, and ``tail``.

    It is built under a hidden name beside the target and then renamed, so that a receiver never
    sees half a file and a crash leaves an earlier try as it was.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    source, goal, whole = path(staging), path(f"{folder}/{name}"), path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    fs, source_fs = goal.getFileSystem(conf), source.getFileSystem(conf)
    found = [s for s in source_fs.listStatus(source) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
    parts = sorted((s.getPath() for s in found), key=lambda p: int(p.getName().split("-")[1].split(".")[0]))
    fs.mkdirs(goal.getParent())
    try:
        if fs.getUri().equals(source_fs.getUri()) and fs.hasPathCapability(goal.getParent(), "fs.capability.paths.concat"):
            _concatenate(spark, fs, whole, parts, head, between, tail)
        else:
            _stream(spark, fs, source_fs, whole, parts, head, between, tail)
        if fs.exists(goal):
            fs.delete(goal, True)
        if not fs.rename(whole, goal):
            raise RuntimeError(f"could not place {folder}/{name}")
    finally:
        fs.delete(whole, True)
    return f"{folder}/{name}"


def _concatenate(spark: SparkSession, fs, whole, parts: list, head: str, between: str, tail: str) -> None:
    """The file system joins the parts by their blocks; only the bytes around them are written."""
    _close(fs.create(whole), head)
    for i, part in enumerate(parts):
        after = between if i + 1 < len(parts) else tail
        if after:
            _close(fs.append(part), after)
    if parts:
        listed = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            listed[i] = part
        fs.concat(whole, listed)
    elif tail:
        _close(fs.append(whole), tail)


def _stream(spark: SparkSession, fs, source_fs, whole, parts: list, head: str, between: str, tail: str) -> None:
    """Copy the bytes of the parts behind one another, a megabyte at a time, where the store can't concatenate."""
    out = fs.create(whole)
    try:
        out.write(bytearray(head.encode()))
        for i, part in enumerate(parts):
            if i and between:
                out.write(bytearray(between.encode()))
            data = source_fs.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
            finally:
                data.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()


def _close(out, text: str) -> None:
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
