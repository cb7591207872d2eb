"""An extension: the event log as a stream. Its batch form is in sources and operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_repeated_events(events: DataFrame, key: str = "event_id", ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Drops events seen before, as long as the watermark remembers them."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(events: DataFrame, kind: str = "event_type", ts: str = "ts", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n"))
