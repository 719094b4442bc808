"""Queries over the driver's tables, one per job and operator.

Every query reads the whole ``events`` table of ``sf_dir``, renders it into
the input shape the job reads (lines, Kafka rows, arrival batches; see
``clickstats.sources.standin``), and runs the job on that. No query outputs a
timestamp column: times are ``bigint`` epoch ms or seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.operators import late
from clickstats.operators.ingest import ingest_access_log, ingest_behavior
from clickstats.operators.rank import COMPACT_ITEMS_LAYOUT, HOT_ITEMS_LAYOUT, HOT_URLS_LAYOUT, render_report
from clickstats.plans import jobs
from clickstats.sources import standin
from clickstats.sources.lines import decode_kafka
from clickstats.sources.tables import load_table

BEHAVIOR_OUT = ["user_id", "item_id", "category_id", "behavior", "ts_sec", "event_ms"]
LOG_OUT = ["ip", "user_id", "event_ms", "method", "url"]
BROKEN_EVERY = 97


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def behavior_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behavior lines rendered from ``events`` and parsed by the ingest job."""
    return ingest_behavior(standin.behavior_lines(_events(spark, sf_dir))).rows


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log lines rendered from ``events`` and parsed by the ingest job."""
    return ingest_access_log(standin.access_log_lines(_events(spark, sf_dir))).rows


def _window_rollup(counts: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """Per key: number of windows, sum and peak of the window counts, first and last
    window, and a checksum that a count in a wrong window would change."""
    seconds = F.floor(F.col("window_end") / 1000).cast("bigint")
    return counts.groupBy(key).agg(F.count(F.lit(1)).alias("windows"),
                                   F.sum(count_col).alias("total"), F.max(count_col).alias("peak"),
                                   F.min("window_end").alias("first_end"), F.max("window_end").alias("last_end"),
                                   F.sum(seconds * F.col(count_col)).alias("end_checksum"))


def arrival_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log rows with the arrival batch each line comes in."""
    lines = standin.access_log_lines(_events(spark, sf_dir), with_arrival=True)
    return ingest_access_log(lines).rows


def _hot_url_split(spark: SparkSession, sf_dir: str):
    return late.split_late(arrival_log_rows(spark, sf_dir), jobs.is_get(), "10 minutes", "5 seconds",
                           delay="1 second", lateness="1 minute")


# --- ingest (P1, P2) and filters (F1, F2) -----------------------------------

def q_ingest_behavior(spark, sf_dir):
    """Behavior lines parsed into typed rows."""
    return behavior_rows(spark, sf_dir).select(*BEHAVIOR_OUT)


def q_ingest_behavior_rejects(spark, sf_dir):
    """Malformed behavior lines set aside with the reason, in one pass."""
    lines = standin.behavior_lines(_events(spark, sf_dir), broken_every=BROKEN_EVERY)
    return ingest_behavior(lines, on_bad="reject").rejects.select("value", "reason")


def q_ingest_access_log(spark, sf_dir):
    """Access-log lines parsed into typed rows."""
    return log_rows(spark, sf_dir).select(*LOG_OUT)


def q_ingest_access_log_rejects(spark, sf_dir):
    """Malformed access-log lines (bad dates, trailing text, short lines)."""
    lines = standin.access_log_lines(_events(spark, sf_dir), broken_every=BROKEN_EVERY)
    return ingest_access_log(lines, on_bad="reject").rejects.select("value", "reason")


def q_ingest_behavior_clean(spark, sf_dir):
    """Behavior lines, some of them malformed: the rows that reject mode keeps."""
    lines = standin.behavior_lines(_events(spark, sf_dir), broken_every=BROKEN_EVERY)
    return ingest_behavior(lines, on_bad="reject").rows.select(*BEHAVIOR_OUT)


def q_ingest_access_log_clean(spark, sf_dir):
    """Access-log lines, some of them malformed: the rows that reject mode keeps."""
    lines = standin.access_log_lines(_events(spark, sf_dir), broken_every=BROKEN_EVERY)
    return ingest_access_log(lines, on_bad="reject").rows.select(*LOG_OUT)


def q_filter_pv(spark, sf_dir):
    """Rows whose behavior is ``pv``."""
    return behavior_rows(spark, sf_dir).where(jobs.is_page_view()).select(*BEHAVIOR_OUT)


def q_filter_get(spark, sf_dir):
    """Log rows whose method is ``GET``."""
    return log_rows(spark, sf_dir).where(jobs.is_get()).select(*LOG_OUT)


# --- window counts (N1-N4, A1-A4) -------------------------------------------

def q_item_counts_1h_5m(spark, sf_dir):
    """Page views per item, 1 h windows sliding by 5 min."""
    return jobs.item_counts(behavior_rows(spark, sf_dir), "1 hour", "5 minutes")


def q_item_counts_1h_3s(spark, sf_dir):
    """Page views per item, 1 h windows sliding by 3 s (1,200 windows per row),
    summed up per item: windows, total and peak count."""
    return _window_rollup(jobs.item_counts(behavior_rows(spark, sf_dir), "1 hour", "3 seconds"), "item_id")


def q_item_counts_1h_7s(spark, sf_dir):
    """Page views per item, 1 h windows sliding by 7 s (the size is no multiple of the
    slide), summed up per item."""
    return _window_rollup(jobs.item_counts(behavior_rows(spark, sf_dir), "1 hour", "7 seconds"), "item_id")


def q_url_counts_10m_5s(spark, sf_dir):
    """GET hits per URL, 10 min windows sliding by 5 s (120 windows per row)."""
    return jobs.url_counts(log_rows(spark, sf_dir), "10 minutes", "5 seconds")


def q_page_views_hourly(spark, sf_dir):
    """Total page views per hour (one shared key)."""
    return jobs.page_views(behavior_rows(spark, sf_dir), "1 hour")


def q_page_views_salted(spark, sf_dir):
    """Total page views per hour in two salted stages, with the text form."""
    return jobs.page_views_salted(behavior_rows(spark, sf_dir), "1 hour", salts=4, as_text=True).select(
        "window_end", "count", "pv")


# --- rankings and reports (T1-T5, R1) ---------------------------------------

def q_hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 items by page views per 1 h window sliding by 5 min."""
    return jobs.hot_items(behavior_rows(spark, sf_dir), "1 hour", "5 minutes", 5).select(
        "item_id", "window_end", "count", "rank")


def q_hot_items_kafka(spark, sf_dir):
    """Kafka-shaped rows decoded and ranked: top 5 items per 1 h window sliding
    by 3 s, summed up per item (windows in the top 5, best rank, peak count)."""
    lines = decode_kafka(standin.kafka_rows(_events(spark, sf_dir)))
    rows = ingest_behavior(lines.select("value")).rows
    top = jobs.hot_items(rows, "1 hour", "3 seconds", 5)
    seconds = F.floor(F.col("window_end") / 1000).cast("bigint")
    return top.groupBy("item_id").agg(F.count(F.lit(1)).alias("top_windows"),
                                      F.min("rank").alias("best_rank"), F.max("count").alias("peak"),
                                      F.min("window_end").alias("first_end"), F.max("window_end").alias("last_end"),
                                      F.sum(seconds * F.col("count")).alias("end_checksum"),
                                      F.sum(seconds * F.col("rank")).alias("rank_checksum"))


def q_hot_items_kafka_report(spark, sf_dir):
    """The Kafka job's text report: top 5 items of each 1 h window, here sliding by 30 min."""
    lines = decode_kafka(standin.kafka_rows(_events(spark, sf_dir)))
    top = jobs.hot_items(ingest_behavior(lines.select("value")).rows, "1 hour", "30 minutes", 5)
    return render_report(top, "item_id", COMPACT_ITEMS_LAYOUT)


def q_hot_urls_top5(spark, sf_dir):
    """Top 5 URLs by GET hits per 10 min window sliding by 5 s."""
    return jobs.hot_urls(log_rows(spark, sf_dir), "10 minutes", "5 seconds", 5).select(
        "url", "window_end", "url_count", "rank")


def q_hot_items_report(spark, sf_dir):
    """The text report of the top 5 items of each 1 h / 5 min window."""
    top = jobs.hot_items(behavior_rows(spark, sf_dir), "1 hour", "5 minutes", 5)
    return render_report(top, "item_id", HOT_ITEMS_LAYOUT)


def q_hot_urls_report(spark, sf_dir):
    """The text report of the top 5 URLs of each 10 min / 5 s window."""
    top = jobs.hot_urls(log_rows(spark, sf_dir), "10 minutes", "5 seconds", 5)
    return render_report(top, "url", HOT_URLS_LAYOUT, count_col="url_count")


# --- late data (L1, L2, T2 with re-firing, T3) -------------------------------

def q_late_rows(spark, sf_dir):
    """GET rows that arrive after all their windows closed (the side output)."""
    return _hot_url_split(spark, sf_dir).late.select(*LOG_OUT, "batch_id")


def q_on_time_rows(spark, sf_dir):
    """GET rows counted in at least one window."""
    return _hot_url_split(spark, sf_dir).on_time.select(*LOG_OUT, "batch_id")


def q_hot_urls_updated(spark, sf_dir):
    """Top 5 URLs per window after every late re-firing: counts of all rows
    each window accepted within the 1 min allowed lateness."""
    top, _ = jobs.hot_urls_with_lateness(arrival_log_rows(spark, sf_dir), "10 minutes", "5 seconds",
                                         "1 second", "1 minute", 5)
    return top.select("url", "window_end", "url_count", "rank")


def q_open_windows_after_expiry(spark, sf_dir):
    """Counts of the windows that may still change at the final watermark, 1 day retention."""
    rows = arrival_log_rows(spark, sf_dir)
    split = late.split_late(rows, jobs.is_get(), "10 minutes", "5 seconds", delay="1 second", lateness="1 minute")
    counts = late.accepted_counts(split.on_time, "url", "10 minutes", "5 seconds", "1 minute", count_col="url_count")
    final = rows.agg((F.max("event_ms") - 1000).alias("wm")).scalar()
    return late.expire_windows(counts, final, 86_400_000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_behavior": q_ingest_behavior,
    "ingest_behavior_rejects": q_ingest_behavior_rejects,
    "ingest_access_log": q_ingest_access_log,
    "ingest_access_log_rejects": q_ingest_access_log_rejects,
    "filter_pv": q_filter_pv,
    "filter_get": q_filter_get,
    "item_counts_1h_5m": q_item_counts_1h_5m,
    "item_counts_1h_3s": q_item_counts_1h_3s,
    "url_counts_10m_5s": q_url_counts_10m_5s,
    "page_views_hourly": q_page_views_hourly,
    "page_views_salted": q_page_views_salted,
    "hot_items_top5": q_hot_items_top5,
    "hot_items_kafka": q_hot_items_kafka,
    "hot_urls_top5": q_hot_urls_top5,
    "hot_items_report": q_hot_items_report,
    "hot_urls_report": q_hot_urls_report,
    "late_rows": q_late_rows,
    "on_time_rows": q_on_time_rows,
    "hot_urls_updated": q_hot_urls_updated,
    "ingest_behavior_clean": q_ingest_behavior_clean,
    "ingest_access_log_clean": q_ingest_access_log_clean,
    "item_counts_1h_7s": q_item_counts_1h_7s,
    "hot_items_kafka_report": q_hot_items_kafka_report,
    "open_windows_after_expiry": q_open_windows_after_expiry,
}
