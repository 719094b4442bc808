"""Event time and watermarks for streams (W1-W3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(rows: DataFrame, delay: str = "0 seconds", time_col: str = "event_time") -> DataFrame:
    """Declare ``time_col`` (a ``timestamp``) as event time with a disorder bound.

    A delay of 0 gives the ascending-time behavior: a window closes once a
    row at or after its end has been seen. ``timestamp_ntz`` columns are
    refused by Spark here; the ingest jobs produce ``timestamp``.
    """
    return rows.withWatermark(time_col, delay)


def keep_after_watermark(rows: DataFrame, predicate: Column, time_col: str = "event_time") -> DataFrame:
    """Filter a stream so that the rows it removes still move event time on.

    A plain ``where`` is pushed below the watermark, so removed rows would no
    longer advance it. A predicate that also reads the event-time column is
    not pushed there; rows without event time are dropped either way.
    """
    return rows.where(F.when(F.col(time_col).isNotNull(), predicate))
