"""Records of delimited files whose quoted fields may hold line breaks.

Lines can't tell where a record begins: that depends on all quotes before. Files are read as
lines in chunks that any number of tasks share, and the quotes in front of a line are a prefix
sum, over the chunks of a file and over the lines of a chunk. A line with an even number of
quotes before it begins a record.

That holds as long as quotes are in order. A file in which a record of several lines turns
out not to fit its fields, or which ends inside quotes, is read again by ``_by_rules``, from the
same lines: record by record, so that a stray or unclosed quote costs the line it stands in and
no more. Where everything fits, both ways give the same records.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

#: Bytes of a record; what is longer is taken for a quote that was not closed.
RECORD_BYTES = 16 << 20
LINES = T.StructType([T.StructField("value", T.StringType()), T.StructField("file", T.StringType()), T.StructField("chunk", T.LongType())])
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[ \t]*+|[^",\n][^,\n]*+|)'
#: A line that isn't blank holds a character beyond the controls and the space.
_FILLED = r"[^\x00-\x20]"
_RECORDS = "record string, fits boolean"


def fits(width: int) -> str:
    """Pattern of a whole record of ``width`` fields, in the terms that Java and Python share."""
    return rf"^{_FIELD}(?:,{_FIELD}){{{width - 1}}}\r?$"


def numbered(lines: DataFrame) -> DataFrame:
    """Lines (value, file, chunk) with ``at``, which ascends within a chunk; to be written before it is used."""
    return lines.withColumn("at", F.monotonically_increasing_id())


def _quotes(c: str = "value") -> Column:
    return F.length(c) - F.length(F.replace(F.col(c), F.lit('"'), F.lit("")))


def _odd(c: str = "value") -> Column:
    return _quotes(c) % 2 == 1


def split_records(lines: DataFrame, width: int) -> DataFrame:
    """One row per record of the files of ``lines`` (value, file, chunk, at): record and fits.

    ``fits`` tells a record of ``width`` well-formed fields from a line that was set aside.
    The first record of a file, its header, and blank lines between records give no row. A
    line break inside quotes stays as it is in the file.
    """
    odd = lines.where(_odd()).select("file")

    def single(plain: DataFrame) -> DataFrame:
        return _without_header(plain.where(F.col("value").rlike(_FILLED))).select(_bare("value").alias("record"), F.col("value").rlike(fits(width)).alias("fits"))

    if odd.isEmpty():  # every line is a record
        return single(lines)
    mixed = F.broadcast(odd.distinct())  # no more than the files that were listed
    several, damaged = _by_quotes(lines.join(mixed, "file", "left_semi"), width)
    return single(lines.join(mixed, "file", "left_anti")).unionByName(several).unionByName(_by_rules(lines.join(F.broadcast(damaged), "file", "left_semi"), width))


def _bare(c: str) -> Column:
    return F.regexp_replace(c, "\r$", "")


def _without_header(records: DataFrame) -> DataFrame:
    first = records.groupBy("file").agg(F.min(F.struct("chunk", "at")).alias("head"))
    return records.join(F.broadcast(first), "file").where(F.struct("chunk", "at") > F.col("head")).drop("head")


def _by_quotes(lines: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Records by prefix sums of quotes, and the files (file) in which that doesn't hold."""
    chunk, file = Window.partitionBy("file", "chunk").orderBy("at"), Window.partitionBy("file").orderBy("chunk")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    own = lines.withColumn("quotes", _quotes())
    sums = own.groupBy("file", "chunk").agg(F.sum("quotes").alias("quotes"))
    ahead = sums.select("file", "chunk", F.coalesce(F.sum("quotes").over(before(file)), F.lit(0)).alias("ahead"))
    placed = own.join(ahead, ["file", "chunk"]).withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("quotes").over(before(chunk)), F.lit(0)))
    marked = placed.withColumn("begin", F.when(F.col("ahead") % 2 == 0, F.struct("chunk", "at")))
    marked = marked.withColumn("begin", F.last("begin", True).over(chunk.rowsBetween(Window.unboundedPreceding, 0)))
    # Lines before the first beginning of a chunk belong to the last one of the chunks before.
    lasts = marked.groupBy("file", "chunk").agg(F.max("begin").alias("begin"))
    carried = lasts.select("file", "chunk", F.last("begin", True).over(before(file)).alias("carried"))
    known = marked.join(carried, ["file", "chunk"]).withColumn("begin", F.coalesce("begin", "carried"))
    # Sizes first: what one stray quote would join is never gathered.
    sizes = known.groupBy("file", "begin").agg(F.sum(F.length("value") + 1).alias("size"), F.sum("quotes").alias("quotes"))
    odd = sizes.where((F.col("size") > RECORD_BYTES) | (F.col("quotes") % 2 == 1)).select("file").distinct()
    calm = known.join(F.broadcast(odd), "file", "left_anti")
    joined = calm.groupBy("file", "begin").agg(F.array_sort(F.collect_list(F.struct("chunk", "at", "value"))).alias("rows"))
    whole = joined.select("file", F.col("begin.chunk").alias("chunk"), F.col("begin.at").alias("at"), F.size("rows").alias("lines"), F.array_join(F.transform("rows", lambda r: r["value"]), "\n").alias("value"))
    whole = whole.where(F.col("value").rlike(_FILLED)).withColumn("fits", F.col("value").rlike(fits(width)))
    wrong = whole.where("lines > 1 AND NOT fits").select("file").distinct().unionByName(odd).distinct()
    kept = _without_header(whole.join(F.broadcast(wrong), "file", "left_anti"))
    return kept.select(_bare("value").alias("record"), "fits"), wrong


def _by_rules(lines: DataFrame, width: int) -> DataFrame:
    """Records of damaged files, one after the other; a task holds a record at most, and reads on behind its first line if it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, reader = None, None
        for batch in batches:
            out: list[tuple[str, bool]] = []
            for name, value in zip(batch["file"].to_pylist(), batch["value"].to_pylist()):
                if name != file:
                    out += reader.end() if reader else []
                    file, reader = name, RuleReader(width)
                out += reader.line(value)
            yield _records(out)
        if reader:
            yield _records(reader.end())

    ordered = lines.repartition("file").sortWithinPartitions("file", "chunk", "at").select("file", "value")
    return ordered.mapInArrow(run, _RECORDS)


def _records(rows: list[tuple[str, bool]]) -> pa.RecordBatch:
    records, good = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(records, pa.string()), pa.array(good, pa.bool_())], names=["record", "fits"])


class RuleReader:
    """Takes the lines of a file in order and gives its records, and lines that belong to none."""

    def __init__(self, width: int):
        self.whole, self.filled = re.compile(fits(width)), re.compile(_FILLED)
        self.opens = re.compile(rf'(?:{_FIELD},)*+"{_INSIDE}')
        self.goes_on = re.compile(_INSIDE)
        self.closes = re.compile(rf'{_INSIDE}"[ \t]*+(?:,{_FIELD})*+\r?')
        self.reopens = re.compile(rf'{_INSIDE}"[ \t]*+(?:,{_FIELD})*?,"{_INSIDE}')
        self.open: list[str] = []
        self.size, self.header = 0, True

    def line(self, value: str) -> list[tuple[str, bool]]:
        out: list[tuple[str, bool]] = []
        todo = deque([value])
        while todo:
            value = todo.popleft()
            if self.open:
                self.open.append(value)
                self.size += len(value) + 1
                if '"' not in value or self.goes_on.fullmatch(value) or self.reopens.fullmatch(value):
                    if self.size <= RECORD_BYTES:
                        continue
                elif self.closes.fullmatch(value) and self.whole.match(record := "\n".join(self.open)):
                    out += self._done(record, True)
                    self.open = []
                    continue
                out += self._failed(todo)
            elif not self.filled.search(value):
                continue
            elif self.whole.match(value):
                out += self._done(value, True)
            elif self.opens.fullmatch(value):
                self.open, self.size = [value], len(value) + 1
            else:
                out += self._done(value, False)
        return out

    def end(self) -> list[tuple[str, bool]]:
        """What is left at the end of the file; a record that is open then failed."""
        out: list[tuple[str, bool]] = []
        while self.open:
            todo: deque = deque()
            out += self._failed(todo)
            while todo:
                out += self.line(todo.popleft())
        return out

    def _failed(self, todo: deque) -> list[tuple[str, bool]]:
        first, *rest = self.open
        todo.extendleft(reversed(rest))
        self.open = []
        return self._done(first, False)

    def _done(self, record: str, good: bool) -> list[tuple[str, bool]]:
        if self.header:
            self.header = False
            return []
        return [(record.removesuffix("\r"), good)]
