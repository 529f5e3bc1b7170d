"""Which load delivered an invoice, and into which month: an index beside the invoice detail.

The index has one narrow row per invoice and load and is partitioned like the detail. From it
a load learns which months it touches, and a month which loads hold its rows and which of
them a later load superseded, so that the detail itself is read in those partitions only.
Rows are sorted by invoice within a load; a range of invoice numbers skips most of its row groups.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowtables.operators.joins import fits_broadcast
from flowtables.sinks.tables import append_table, ensure_table, replace_period

_KEYS = ["ROSTER_SYSTEM", "LOAD_PERIOD"]
_COLUMNS = ["INVOICEID", "INVOICE_YEAR", "INVOICE_MONTH"]
_DELIVERY = ["INVOICEID", "LOAD_PERIOD"]


def in_months(months: Iterable[date]) -> Column:
    """Any of the months, by literals: a condition per year, however many months."""
    years: dict[int, list[int]] = {}
    for day in sorted(months):
        years.setdefault(day.year, []).append(day.month)
    each = [(F.col("INVOICE_YEAR") == F.lit(year)) & F.col("INVOICE_MONTH").isin(*found) for year, found in years.items()]
    return reduce(lambda a, b: a | b, each, F.lit(False))


class InvoiceIndex:
    """The index of one roster system; ``detail`` is the table it is an index of."""

    def __init__(self, spark: SparkSession, name: str, detail: str, system: str):
        self.spark, self.name, self.detail, self.system = spark, name, detail, system
        fresh = not spark.catalog.tableExists(name)
        fields = {f.name: f for f in spark.table(detail).schema}
        ensure_table(spark, name, T.StructType([fields[c] for c in [*_COLUMNS, *_KEYS]]), _KEYS)
        if fresh:  # detail that was stored before there was an index
            append_table(spark.table(detail).select(*_COLUMNS, *_KEYS).distinct(), name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("ROSTER_SYSTEM") == self.system)

    def load(self, period: str) -> DataFrame:
        """Invoices of one load."""
        return self.rows().filter(F.col("LOAD_PERIOD") == period)

    def replace(self, period: str, detail: DataFrame) -> None:
        """Take the invoices of a load as its detail has them."""
        own = detail.select(*_COLUMNS).distinct().sortWithinPartitions("INVOICEID")
        key = {"ROSTER_SYSTEM": self.system, "LOAD_PERIOD": period}
        replace_period(own.withColumns({k: F.lit(v) for k, v in key.items()}), self.name, key)

    def of(self, invoices: DataFrame) -> DataFrame:
        """Rows of these invoices in all loads."""
        bounds = invoices.agg(F.min("INVOICEID").alias("low"), F.max("INVOICEID").alias("high")).first()
        near = self.rows().filter(F.col("INVOICEID").between(F.lit(bounds.low), F.lit(bounds.high)))
        return near.join(invoices.select("INVOICEID").distinct(), "INVOICEID", "left_semi")

    def deliveries(self, months: Iterable[date]) -> DataFrame:
        """Invoices with rows in these months, by load, and whether a later load ``SUPERSEDED`` that one."""
        inside = self.rows().filter(in_months(months))
        last = self.of(inside).groupBy("INVOICEID").agg(F.max("LOAD_PERIOD").alias("__last"))
        pairs = inside.select(*_DELIVERY).filter(F.col("LOAD_PERIOD").isNotNull()).distinct().join(last, "INVOICEID")
        return pairs.select(*_DELIVERY, (F.col("LOAD_PERIOD") < F.col("__last")).alias("SUPERSEDED"))

    def live(self, months: Iterable[date]) -> DataFrame:
        """Invoices with rows in these months, where their last load has put them there."""
        return self.deliveries(months).filter(~F.col("SUPERSEDED")).select(*_DELIVERY)

    def current(self, months: Iterable[date], live: DataFrame) -> DataFrame:
        """Detail rows of ``live`` invoices in these months, read from the loads that hold them."""
        return self._held(months, live).join(live, _DELIVERY, "left_semi")

    def standing(self, months: Iterable[date], deliveries: DataFrame) -> DataFrame:
        """The same rows from ``deliveries``: where few were superseded, these are left out and no detail is shuffled."""
        live = deliveries.filter(~F.col("SUPERSEDED")).select(*_DELIVERY)
        gone = deliveries.filter("SUPERSEDED").select(*_DELIVERY)
        if not fits_broadcast(gone):
            return self.current(months, live)
        return self._held(months, live).filter(F.col("INVOICEID").isNotNull()).join(F.broadcast(gone), _DELIVERY, "left_anti")

    def _held(self, months: Iterable[date], live: DataFrame) -> DataFrame:
        loads = [r.LOAD_PERIOD for r in live.select("LOAD_PERIOD").distinct().collect()]  # no more than there are loads
        return self.spark.table(self.detail).filter((F.col("ROSTER_SYSTEM") == self.system) & F.col("LOAD_PERIOD").isin(loads) & in_months(months))


def months_of(rows: DataFrame) -> set[date]:
    """Months of index rows: few values."""
    found = rows.select("INVOICE_YEAR", "INVOICE_MONTH").distinct().collect()
    return {date(r.INVOICE_YEAR, r.INVOICE_MONTH, 1) for r in found if r.INVOICE_YEAR and r.INVOICE_MONTH}
