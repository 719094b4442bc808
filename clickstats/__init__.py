"""clickstats: clickstream and access-log analytics on Spark DataFrames and streams."""

from clickstats.operators.ingest import Ingested, ingest_access_log, ingest_behavior
from clickstats.operators.rank import render_report, top_n
from clickstats.operators.windows import windowed_count
from clickstats.plans.jobs import (hot_items, hot_urls, hot_urls_with_lateness, item_counts, page_views,
                                   page_views_salted, url_counts)

__all__ = [
    "Ingested", "ingest_access_log", "ingest_behavior", "render_report", "top_n", "windowed_count",
    "hot_items", "hot_urls", "hot_urls_with_lateness", "item_counts", "page_views", "page_views_salted",
    "url_counts",
]
