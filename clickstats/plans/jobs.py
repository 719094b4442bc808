"""The analytics jobs, as batch DataFrame plans over ingested rows.

Each job filters, counts per key and window, and ranks or totals, exactly as
the original streaming jobs do once every window has closed. Streaming
versions of the same plans are in ``clickstats.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div
from clickstats.operators.late import accepted_counts, split_late
from clickstats.operators.rank import top_n, top_n_runs
from clickstats.operators.windows import duration_ms, windowed_count, windowed_runs


def is_page_view(behavior: Column | None = None) -> Column:
    """Predicate of the item and page-view jobs: behavior is exactly ``pv``."""
    c = F.col("behavior") if behavior is None else behavior
    return F.coalesce(c == F.lit("pv"), F.lit(False))


def is_get(method: Column | None = None) -> Column:
    """Predicate of the URL job: method is exactly ``GET``."""
    c = F.col("method") if method is None else method
    return F.coalesce(c == F.lit("GET"), F.lit(False))


def item_counts(behavior_rows: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                method: str = "auto") -> DataFrame:
    """Page views per item and sliding window: ``item_id, window_end, count``."""
    return windowed_count(behavior_rows.where(is_page_view()), "item_id", size, slide, method=method)


def hot_items(behavior_rows: DataFrame, size: str = "1 hour", slide: str = "5 minutes", n: int = 5,
              method: str = "auto") -> DataFrame:
    """Top ``n`` items by page views per sliding window:
    ``item_id, window_end, count, rank``."""
    return _ranked(behavior_rows.where(is_page_view()), "item_id", size, slide, n, method, "count")


def _ranked(rows: DataFrame, key: str, size: str, slide: str, n: int, method: str, count_col: str) -> DataFrame:
    """Sliding counts, ranked; every ``method`` gives the same rows.

    ``auto`` and the methods of ``windowed_count`` rank window by window and shuffle the best of each window. ``runs`` and
    ``nodes`` shuffle runs of windows (``top_n_runs`` without and with its node limit): ``runs`` is cheaper where windows
    hold few keys, and much dearer where they hold many, since all of them are laid out in one block.
    """
    if method in ("runs", "nodes"):
        runs = windowed_runs(rows, key, size, slide, count_col=count_col)
        return top_n_runs(runs, key, n, size, slide, count_col, node_limit=method == "nodes")
    return top_n(windowed_count(rows, key, size, slide, count_col=count_col, method=method), key, n, count_col=count_col)


def url_counts(log_rows: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
               method: str = "auto") -> DataFrame:
    """GET hits per URL and sliding window: ``url, window_end, url_count``."""
    counts = windowed_count(log_rows.where(is_get()), "url", size, slide, method=method)
    return counts.withColumnRenamed("count", "url_count")


def hot_urls(log_rows: DataFrame, size: str = "10 minutes", slide: str = "5 seconds", n: int = 5,
             method: str = "auto") -> DataFrame:
    """Top ``n`` URLs by GET hits per sliding window, every window complete:
    ``url, window_end, url_count, rank``. (For arrival order, lateness and
    re-fired windows see ``hot_urls_with_lateness``.)"""
    return _ranked(log_rows.where(is_get()), "url", size, slide, n, method, "url_count")


def hot_urls_with_lateness(log_rows: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
                           delay: str = "1 second", lateness: str = "1 minute", n: int = 5,
                           batch_col: str = "batch_id") -> tuple[DataFrame, DataFrame]:
    """The hot-URL job over rows in arrival order: ``(rankings, late)``.

    ``log_rows`` carry the micro-batch each row arrived in (``batch_col``).
    Rows are judged by the watermark of the batches before theirs (max event
    time minus ``delay``); windows keep taking rows for ``lateness`` after
    their end and re-fire. ``rankings`` is the top ``n`` per window after its
    last re-firing (``url, window_end, url_count, rank``); ``late`` holds the
    GET rows too late for all their windows (the side output).
    """
    split = split_late(log_rows, is_get(), size, slide, delay, lateness, batch_col)
    counts = accepted_counts(split.on_time, "url", size, slide, lateness, count_col="url_count")
    return top_n(counts, "url", n, count_col="url_count"), split.late


def page_views(behavior_rows: DataFrame, size: str = "1 hour") -> DataFrame:
    """Total page views per tumbling window: ``pv, window_end, count``.

    Every row has the same group, the label ``pv``; the partial aggregate
    before the shuffle leaves one row per window and map task, so the shared
    key costs nothing.
    """
    counts = windowed_count(behavior_rows.where(is_page_view()), None, size)
    return counts.select(F.lit("pv").alias("pv"), "window_end", "count")


def salted_label(salts: int, *cols: str) -> Column:
    """``pv_<s>`` with s in [0, salts) from a hash of the row's columns.

    A hash instead of a random draw: a retried task gives every row the same
    salt again, so a lost executor cannot change the result.
    """
    return F.concat(F.lit("pv_"), F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("string"))


def page_views_salted(behavior_rows: DataFrame, size: str = "1 hour", salts: int = 4,
                      as_text: bool = True) -> DataFrame:
    """Total page views per tumbling window, counted in two stages.

    Stage 1 counts per (salt label, window), so one hot window is spread over
    ``salts`` groups; stage 2 adds the partial counts per window. Output
    ``window_end, count`` and, with ``as_text``, ``pv`` = ``"pv:" + count``.
    """
    size_ms = duration_ms(size)
    pv = behavior_rows.where(is_page_view())
    cols = [c for c in ("user_id", "item_id", "category_id", "behavior", "ts_sec") if c in pv.columns]
    staged = (pv.select(salted_label(salts, *cols).alias("label"),
                        ((floor_div(F.col("event_ms"), size_ms) + 1) * size_ms).alias("window_end"))
              .groupBy("label", "window_end").agg(F.count(F.lit(1)).alias("count")))
    totals = staged.groupBy("window_end").agg(F.sum("count").alias("count"))
    if as_text:
        totals = totals.withColumn("pv", F.concat(F.lit("pv:"), F.col("count").cast("string")))
    return totals
