"""Send what is pending exactly once: take the batch, write it, stamp the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from flowtables.operators.merge import mark_sent
from flowtables.session import staging
from flowtables.sinks.tables import change_table


def flush(
    spark: SparkSession,
    table: str,
    choose: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], str | None],
    keys: Sequence[str],
    stamp: datetime,
    label: str,
    stamp_col: str = "SENT_TIMESTAMP",
) -> tuple[str, str | None]:
    """Send the chosen rows of ``table`` and stamp exactly those.

    The batch is staged first, so rows that arrive while it is written are neither sent nor
    stamped.  A crash after the write and before the stamp sends the batch again under the
    same file name.
    """
    with staging(spark) as stage:
        batch = stage(choose(spark.table(table)), "outbox")
        count = batch.count()
        if not count:
            return f"{label}: Pending=0", None
        path = write(batch)
        change_table(spark, table, batch, lambda rows: mark_sent(rows, batch, keys, stamp, stamp_col))
    place = f" in {path.rsplit('/', 1)[-1]}" if path else ""
    return f"{label}: Pending={count} | Sent={count}{place}", path
