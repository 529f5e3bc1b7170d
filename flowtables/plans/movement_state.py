"""Month-on-month movement kept up by what arrives, instead of rebuilt from all snapshots.

The state has one row per key and month: its latest row, and the value of the key's month
before, partitioned by month. A second table has the last month of every key. A snapshot
whose months are each key's last one or later needs the partitions of its own months and the
last values, and nothing else of the history. Where it corrects an older month of a key, the
months of that key are read, and the one behind the correction changes with it.

Merging is by the same order that picks the latest row of a rebuild, so both give the same
rows, in whatever portions and however often snapshots are applied.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from flowtables.operators.joins import fits_broadcast
from flowtables.operators.windows import keep_latest, latest_first
from flowtables.session import staging
from flowtables.sinks.tables import dynamic_overwrite, ensure_table, in_table_order, only_partitions, replace_table, touched_partitions

_MONTH, _BEFORE, _NEWEST = "STATE_MONTH", "STATE_BEFORE", "STATE_NEWEST"
#: Stands for rows without a date, which come behind all others.
_UNDATED = date(9999, 12, 1)


def _as_planned(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class MovementState:
    """Tables of the state, and what the rows are keyed, dated and valued by."""

    rows: str
    last: str
    keys: tuple[str, ...]
    stamp: str
    value: str

    def _same(self, left: str, right: str, more: Sequence[str] = ()) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in [*self.keys, *more]])

    def _latest(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        ties = [c for c in columns if c not in self.keys]
        return keep_latest(rows, [*self.keys, _MONTH], [latest_first(self.stamp)], ties)

    def advance(self, spark: SparkSession, arrived: DataFrame) -> list[date | None]:
        """Take in the rows of ``arrived``; returns the months (null: undated) whose rows changed or may have."""
        columns = arrived.columns
        dated = arrived.withColumn(_MONTH, F.coalesce(F.trunc(self.stamp, "MM"), F.lit(_UNDATED)))
        value = arrived.schema[self.value].dataType
        wide = T.StructType([*arrived.schema.fields, T.StructField(_BEFORE, value), T.StructField(_MONTH, T.DateType())])
        ensure_table(spark, self.rows, wide, [_MONTH])
        fields = [*[arrived.schema[k] for k in self.keys], T.StructField("LAST_MONTH", T.DateType()), T.StructField("LAST_VALUE", value), T.StructField("LAST_BEFORE", value)]
        ensure_table(spark, self.last, T.StructType(fields))
        with staging(spark) as stage:
            new = stage(self._latest(dated, columns), "arrived")
            months = touched_partitions(new, [_MONTH])
            if not months:
                return []
            # Only keys with a last month have stored rows; the others need nothing of the history.
            arrived_keys = new.select(*self.keys).distinct().alias("n")
            met = stage(spark.table(self.last).alias("l").join(arrived_keys, self._same("l", "n"), "left_semi"), "met")
            side = F.broadcast if fits_broadcast(met) else _as_planned
            known = side(met.select(*self.keys).alias("k"))
            old = only_partitions(spark.table(self.rows), months, [_MONTH]).alias("m")
            old = stage(old.join(known, self._same("m", "k"), "left_semi").select(*columns, _MONTH), "stored")
            over = new.alias("n").join(side(met.alias("l")), self._same("n", "l"))
            late = stage(over.filter(F.col(f"n.{_MONTH}") < F.col("LAST_MONTH")).select(*[F.col(f"n.{k}").alias(k) for k in self.keys]).distinct(), "corrected")
            corrected = not late.isEmpty()
            mine = new if old.isEmpty() else stage(self._latest(new.unionByName(old), columns), "merged")
            order = Window.partitionBy(*self.keys).orderBy(_MONTH)
            before, newest = F.lag(self.value).over(order), F.lead(_MONTH).over(order).isNull()
            plain = mine.alias("m").join(late.alias("c"), self._same("m", "c"), "left_anti") if corrected else mine
            # The first of a key's months follows the last one stored, or is that one; months before it stay as they are.
            based = plain.alias("m").join(side(met.alias("l")), self._same("m", "l"), "left")
            based = based.filter(F.col("LAST_MONTH").isNull() | (F.col(_MONTH) >= F.col("LAST_MONTH")))
            base = F.when(F.col("LAST_MONTH") == F.col(_MONTH), F.col("LAST_BEFORE")).otherwise(F.col("LAST_VALUE"))
            moved = based.select(*[F.col(f"m.{c}").alias(c) for c in [*columns, _MONTH]], base.alias("base"))
            first = F.row_number().over(order) == 1
            moved = moved.withColumns({_BEFORE: F.when(first, F.col("base")).otherwise(before), _NEWEST: newest}).drop("base")
            if corrected:  # months of corrected keys, with what is merged in place of what was stored
                stored = spark.table(self.rows).alias("m").join(late.alias("c"), self._same("m", "c"), "left_semi").select(*columns, _MONTH)
                kept = stored.alias("m").join(mine.alias("n"), self._same("m", "n", [_MONTH]), "left_anti")
                whole = kept.unionByName(mine.alias("m").join(late.alias("c"), self._same("m", "c"), "left_semi"))
                moved = moved.unionByName(whole.withColumns({_BEFORE: before, _NEWEST: newest}))
            moved = stage(moved, "moved")
            touched = touched_partitions(moved.select(_MONTH).unionByName(new.select(_MONTH)), [_MONTH])
            replaced = stage(moved.select(*self.keys, _MONTH).alias("m").join(known, self._same("m", "k"), "left_semi"), "replaced")
            gone = (F.broadcast if fits_broadcast(replaced) else _as_planned)(replaced.alias("n"))
            rest = only_partitions(spark.table(self.rows), touched, [_MONTH]).alias("m").join(gone, self._same("m", "n", [_MONTH]), "left_anti")
            after = stage(rest.unionByName(moved.select(*rest.columns)), "after")
            with dynamic_overwrite(spark):
                in_table_order(after, self.rows).write.mode("overwrite").insertInto(self.rows)
            ends = moved.filter(_NEWEST).select(*self.keys, F.col(_MONTH).alias("LAST_MONTH"), F.col(self.value).alias("LAST_VALUE"), F.col(_BEFORE).alias("LAST_BEFORE"))
            others = spark.table(self.last).alias("l").join(known, self._same("l", "k"), "left_anti")
            replace_table(others.unionByName(ends), self.last)
        return [None if r[_MONTH] == _UNDATED else r[_MONTH] for r in touched]

    def moved(self, spark: SparkSession, months: Sequence[date | None], out: str) -> DataFrame:
        """Rows of these months with ``SENT_MONTH`` and the change of the value as ``out``."""
        rows = only_partitions(spark.table(self.rows), [{_MONTH: m or _UNDATED} for m in months], [_MONTH])
        change = F.col(self.value) - F.coalesce(_BEFORE, F.lit(0).cast(rows.schema[self.value].dataType))
        month = F.when(F.col(_MONTH) != F.lit(_UNDATED), F.col(_MONTH)).alias("SENT_MONTH")
        return rows.select("*", month, change.alias(out)).drop(_MONTH, _BEFORE)
