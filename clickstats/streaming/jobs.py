"""Streaming forms of the jobs: each window is emitted once, complete.

Counts run as Spark's own windowed aggregation in append mode: state per
(window, key), evicted when the watermark passes the window end (plus any
allowed lateness), so state stays bounded.

For rankings, re-firing windows (allowed lateness with updates) and a late side
output see ``clickstats.streaming.ranked``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div
from clickstats.operators.windows import duration_ms
from clickstats.plans.jobs import is_page_view, salted_label
from clickstats.streaming.eventtime import keep_after_watermark, with_event_time


#: Beyond so many windows a row, rows are counted in panes first and only the panes are laid out.
MAX_WINDOWS_PER_ROW = 12


def stream_counts(rows: DataFrame, key: str | None, size: str, slide: str | None = None,
                  delay: str = "0 seconds", lateness: str = "0 seconds", keep: Column | None = None,
                  time_col: str = "event_time", count_col: str = "count") -> DataFrame:
    """Counts per key and window of a stream: ``key, window_end, count``.

    A window is emitted when the watermark (max event time - ``delay``
    - ``lateness``) passes its end; rows arriving for it later are dropped by
    Spark. ``keep`` filters rows after the watermark (see
    ``keep_after_watermark``).

    With more than ``MAX_WINDOWS_PER_ROW`` windows a row the count is made in two
    chained aggregations, by ``stream_pane_counts``; there a row is dropped when its
    pane has closed, which can be before its last window has.
    """
    if slide and duration_ms(size) > MAX_WINDOWS_PER_ROW * duration_ms(slide):
        return stream_pane_counts(rows, key, size, slide, delay, lateness, keep, time_col, count_col)
    timed = _timed(rows, delay, lateness, keep, time_col)
    win = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    keys = [key] if key else []
    return (timed.groupBy(win.alias("_w"), *keys)
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.unix_millis(F.col("_w.end")).alias("window_end"), count_col))


def _timed(rows, delay, lateness, keep, time_col):
    total_delay = f"{duration_ms(delay) + duration_ms(lateness)} milliseconds"
    timed = with_event_time(rows, total_delay, time_col)
    return timed if keep is None else keep_after_watermark(timed, keep, time_col)


def stream_pane_counts(rows: DataFrame, key: str | None, size: str, slide: str,
                       delay: str = "0 seconds", lateness: str = "0 seconds", keep: Column | None = None,
                       time_col: str = "event_time", count_col: str = "count") -> DataFrame:
    """Sliding counts of a stream for any size and slide: ``key, window_end, count``.

    Two chained aggregations in append mode. The first counts rows per pane, the
    longest stretch that no window border cuts (the greatest common divisor of
    size and slide); the second adds up the panes of each window. What is laid
    out size/slide times is one row per pane and key, however many rows the pane
    holds, by ``explode`` and not by ``F.window``, whose one projection for each window of a
    row makes the plan itself slow (1 h / 3 s: 1,200). Windows are emitted once,
    one batch after their panes.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if not 0 < slide_ms <= size_ms:
        raise ValueError("need 0 < slide <= size")
    keys = [key] if key else []
    pane_ms = math.gcd(size_ms, slide_ms)
    panes = (_timed(rows, delay, lateness, keep, time_col).groupBy(F.window(time_col, f"{pane_ms} milliseconds").alias("_pane"), *keys)
             .agg(F.count(F.lit(1)).alias("_c")))
    begin = F.unix_millis(F.col("_pane.start"))
    first, last = floor_div(begin + pane_ms - size_ms - 1, slide_ms) + 1, floor_div(begin, slide_ms)
    laid = panes.select(*keys, "_c", F.explode(F.sequence(first, last)).alias("_index"))
    # The last slide of each window stands for it: a tumbling window that ends with it. It is event time again, no
    # earlier than the pane's, which the column's metadata says.
    time = F.timestamp_millis(F.col("_index") * slide_ms + (size_ms - slide_ms))
    laid = laid.select(*keys, "_c", time.alias("_time", metadata={"spark.watermarkDelayMs": 0}))
    span = f"{slide_ms} milliseconds"
    windows = F.window("_time", span, span, f"{size_ms % slide_ms} milliseconds")
    return (laid.groupBy(windows.alias("_w"), *keys)
            .agg(F.sum("_c").alias(count_col))
            .select(*keys, F.unix_millis(F.col("_w.end")).alias("window_end"), count_col))


def stream_page_views(behavior_rows: DataFrame, size: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Total page views per tumbling window of a stream: ``pv, window_end, count``."""
    counts = stream_counts(behavior_rows, None, size, None, delay, keep=is_page_view())
    return counts.select(F.lit("pv").alias("pv"), "window_end", "count")


def stream_page_views_salted(behavior_rows: DataFrame, size: str = "1 hour", salts: int = 4,
                             delay: str = "0 seconds") -> DataFrame:
    """Salted two-stage page-view totals of a stream: ``window_end, count, pv``.

    Two chained windowed aggregations in append mode: per (salt label,
    window), then per window. The second stage sees each window's partial
    counts when the first evicts them, so it emits each window once.
    """
    timed = keep_after_watermark(with_event_time(behavior_rows, delay), is_page_view())
    cols = [c for c in ("user_id", "item_id", "category_id", "behavior", "ts_sec") if c in behavior_rows.columns]
    stage1 = (timed.groupBy(F.window("event_time", size).alias("window"),
                            salted_label(salts, *cols).alias("label"))
              .agg(F.count(F.lit(1)).alias("count")))
    stage2 = stage1.groupBy("window").agg(F.sum("count").alias("count"))
    return stage2.select(F.unix_millis(F.col("window.end")).alias("window_end"), "count",
                         F.concat(F.lit("pv:"), F.col("count").cast("string")).alias("pv"))
