"""Event-time window counts (tumbling and sliding), on epoch-millisecond time.

Windows are half-open ``[start, end)``, aligned to the epoch, and exist only
when a row falls in them. Results are ``keys..., window_end bigint (epoch ms),
count bigint``.

Three physical strategies, all exact:

* ``tumbling``: one group-by on ``(keys, floor(t / size))``.
* ``panes``: a row lies in a run of windows; rows are counted per ``(keys, first
  window, last window)`` first (one partial + final hash aggregate over the raw
  rows), then every window is derived from those runs as an interval-coverage
  count (see ``interval_counts``). Any size and slide; no per-row expansion and
  no task that holds a whole key, however hot the key.
* ``direct``: ``F.window``, which expands every input row size/slide times
  before the partial aggregate; only on request.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}

# Blocks of the coverage count span this many window lengths.
BLOCK_WINDOWS = 16


def duration_ms(d: str | int) -> int:
    """``"1 hour"``, ``"5 minutes"``, ``"3 s"`` or an int of ms -> ms."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"unsupported duration: {d!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def _key_cols(keys: str | list[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def windowed_count(rows: DataFrame, keys: str | list[str] | None, size: str | int,
                   slide: str | int | None = None, time_col: str = "event_ms",
                   count_col: str = "count", method: str = "auto") -> DataFrame:
    """Count rows per key and event-time window.

    ``time_col`` holds epoch ms (bigint). ``slide`` None means tumbling. The
    size need not be a multiple of the slide: windows start at the multiples
    of the slide. ``method``: ``auto`` (tumbling or panes) | ``direct`` | ``panes``.
    """
    if rows.isStreaming:
        raise ValueError("windowed_count runs on batch DataFrames; for streams use "
                         "clickstats.streaming.jobs.stream_counts or streaming.ranked.ranked_stream")
    keys = _key_cols(keys)
    size_ms = duration_ms(size)
    slide_ms = size_ms if slide is None else duration_ms(slide)
    if size_ms <= 0 or slide_ms <= 0 or slide_ms > size_ms:
        raise ValueError("need 0 < slide <= size")
    if method == "auto":
        method = "tumbling" if slide_ms == size_ms else "panes"
    if method == "tumbling" or (method == "panes" and slide_ms == size_ms):
        return _tumbling(rows, keys, size_ms, time_col, count_col)
    if method == "direct":
        return _direct(rows, keys, size_ms, slide_ms, time_col, count_col)
    if method == "panes":
        return _panes(rows, keys, size_ms, slide_ms, time_col, count_col)
    raise ValueError(f"unknown method {method!r}")


def _tumbling(rows, keys, size_ms, time_col, count_col):
    pane = floor_div(F.col(time_col), size_ms)
    return (rows.groupBy(*keys, pane.alias("_pane"))
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, ((F.col("_pane") + 1) * size_ms).alias("window_end"), count_col))


def _direct(rows, keys, size_ms, slide_ms, time_col, count_col):
    w = F.window(F.timestamp_millis(F.col(time_col)), f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
    return (rows.groupBy(*keys, w.alias("_w"))
            .agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.unix_millis(F.col("_w.end")).alias("window_end"), count_col))


def window_run(size_ms: int, slide_ms: int, time_col: str = "event_ms") -> tuple[Column, Column]:
    """First and last index (window start / slide) of the windows a row lies in."""
    t = F.col(time_col)
    return floor_div(t - size_ms, slide_ms) + 1, floor_div(t, slide_ms)


def _panes(rows, keys, size_ms, slide_ms, time_col, count_col):
    return interval_counts(_run_counts(rows, keys, size_ms, slide_ms, time_col), keys, "_first", "_last", "_c",
                           size_ms, slide_ms, count_col)


def _run_counts(rows, keys, size_ms, slide_ms, time_col):
    """Rows per key and run of windows they lie in: ``keys..., _first, _last, _c``."""
    first, last = window_run(size_ms, slide_ms, time_col)
    return (rows.groupBy(*keys, first.alias("_first"), last.alias("_last"))
            .agg(F.count(F.lit(1)).alias("_c")))


def windowed_runs(rows: DataFrame, keys: str | list[str], size: str | int, slide: str | int,
                  time_col: str = "event_ms", count_col: str = "count") -> DataFrame:
    """Sliding counts as runs of windows with one count (see ``covered_runs``), for ``rank.top_n_runs``."""
    if rows.isStreaming:
        raise ValueError("windowed_runs runs on batch DataFrames; for streams use clickstats.streaming.ranked.ranked_stream")
    keys, size_ms, slide_ms = _key_cols(keys), duration_ms(size), duration_ms(slide)
    if not 0 < slide_ms <= size_ms:
        raise ValueError("need 0 < slide <= size")
    return covered_runs(_run_counts(rows, keys, size_ms, slide_ms, time_col), keys, "_first", "_last", "_c",
                        size_ms, slide_ms, count_col)


def interval_counts(intervals: DataFrame, keys: list[str], first_col: str, last_col: str,
                    weight_col: str, size_ms: int, slide_ms: int, count_col: str = "count",
                    block_windows: int = BLOCK_WINDOWS, partitions: int | None = None) -> DataFrame:
    """Sum of weights of the intervals covering each integer index, per key.

    Each input row is an interval ``[first, last]`` of window indices (start /
    slide) with a weight (a count). Output: ``keys..., window_end = index * slide
    + size, count`` for every index where the sum is positive: the runs of
    ``covered_runs``, window by window.
    """
    runs = covered_runs(intervals, keys, first_col, last_col, weight_col, size_ms, slide_ms, count_col,
                        block_windows, partitions)
    return lay_out(runs, keys, size_ms, slide_ms, count_col)


def lay_out(runs: DataFrame, keys: list[str], size: str | int, slide: str | int, count_col: str = "count") -> DataFrame:
    """Runs of windows, window by window: ``keys..., window_end, count``."""
    step, span = F.lit(duration_ms(slide)).cast("bigint"), F.lit(duration_ms(size))
    lo, hi = F.col("first_window"), F.col("last_window")
    return runs.select(*keys, F.explode(F.sequence(lo * step + span, hi * step + span, step)).alias("window_end"), count_col)


def covered_runs(intervals: DataFrame, keys: list[str], first_col: str, last_col: str,
                 weight_col: str, size_ms: int, slide_ms: int, count_col: str = "count",
                 block_windows: int = BLOCK_WINDOWS, partitions: int | None = None) -> DataFrame:
    """Sum of weights of the intervals covering each index, as runs of indices with
    one sum: ``keys..., first_window, last_window, count``, where the sum is positive.

    Method (a distributed prefix sum): an interval becomes a ``+w`` delta at
    ``first`` and a ``-w`` delta at ``last + 1``; the running sum of deltas is
    the coverage. Indices are cut into blocks of ``block_windows`` window lengths
    and every interval is sent to each block it overlaps (one, sometimes
    two), so each ``(key, block)`` holds all intervals it needs and its
    running sum is exact without looking at other blocks. One shuffle on
    ``(key, block)``; a hot key is spread over its blocks. Runs end at block
    borders.

    That shuffle is small (pane counts) but its output expands to every
    window, so it gets a fixed partition count (``partitions``, by default
    ``spark.sql.shuffle.partitions``) instead of one sized by adaptive execution from its small input, which
    would leave the whole expansion to one task.
    """
    block = -(-size_ms // slide_ms) * max(block_windows, 1)
    c = F.col
    first_blk = floor_div(c(first_col), block)
    last_blk = floor_div(c(last_col), block)
    per_block = intervals.select(
        *keys, first_col, last_col, weight_col,
        F.explode(F.sequence(first_blk, last_blk)).alias("_blk"))
    parts = partitions or int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deltas = (per_block.repartition(parts, *[c(k) for k in keys], c("_blk"))
              .select(*keys, "_blk", F.inline(F.array(
                  F.struct(c(first_col).alias("_e"), c(weight_col).alias("_d")),
                  F.struct((c(last_col) + 1).alias("_e"), (-c(weight_col)).alias("_d")))))
              .groupBy(*keys, "_blk", "_e").agg(F.sum("_d").alias("_d")))
    w = Window.partitionBy(*keys, "_blk").orderBy("_e")
    covered = deltas.select(
        *keys, "_blk", "_e",
        F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_s"),
        F.lead("_e").over(w).alias("_next"))
    blk_lo = c("_blk") * block
    blk_hi = blk_lo + block
    lo = F.greatest(c("_e"), blk_lo)
    hi = F.least(F.coalesce(c("_next"), blk_hi), blk_hi)
    return (covered.where((c("_s") > 0) & (lo < hi))
            .select(*keys, lo.alias("first_window"), (hi - 1).alias("last_window"), c("_s").alias(count_col)))
