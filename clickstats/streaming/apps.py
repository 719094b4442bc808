"""The jobs as running streams: source lines in, rankings and totals out.

Each ``start_*`` takes a streaming DataFrame of lines (``value string``, from
``read_lines``, ``read_kafka_lines`` + ``decode_kafka`` or
``read_socket_lines``), a folder for results and a checkpoint folder, and
returns the started ``StreamingQuery``. A relative folder is taken under the
shared checkpoint folder of the cluster (``clickstats.session.state_path``); an
absolute one should be shared too.

``on_bad="fail"`` stops the stream at a malformed line, as the original
parsers do; ``"reject"`` writes such lines with the reason to ``rejects``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickstats.operators.ingest import ingest_access_log, ingest_behavior
from clickstats.plans.jobs import is_get, is_page_view
from clickstats.session import state_path
from clickstats.streaming.jobs import stream_page_views, stream_page_views_salted
from clickstats.streaming.ranked import BUCKETS, close_bounded, ranked_stream
from clickstats.streaming.sinks import write_stream


def _place(spark: SparkSession, folder: str) -> str:
    return folder if folder.startswith("/") or ":" in folder.split("/")[0] else state_path(spark, folder)


def _start(ranked: DataFrame, rejects: DataFrame, on_bad: str, out_dir: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Start the tagged stream into folders by ``kind``; with ``on_bad="reject"`` a second query writes the rejected lines."""
    if on_bad == "reject":
        write_stream(rejects, f"{checkpoint}-rejects", sink="parquet", path=f"{out_dir}-rejects", trigger=trigger)
    return write_stream(ranked, checkpoint, sink="parquet", path=out_dir, trigger=trigger, partition_by="kind")


def start_hot_items(lines: DataFrame, out_dir: str, checkpoint: str, size: str = "1 hour",
                    slide: str = "5 minutes", n: int = 5, on_bad: str = "fail",
                    trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Top ``n`` items by page views per sliding window, each window ranked once
    when event time passes its end (ascending time: the watermark is 1 ms behind
    the latest event time, so a window closes once a row at its end is seen).

    One query without ``foreachBatch`` (``streaming.ranked``); results by
    ``ranked.latest_rankings(spark, out_dir)``. With ``on_bad="reject"`` a second
    query appends the rejected lines to ``<out_dir>-rejects``. Works for any size
    and slide. For the Kafka variant pass
    ``decode_kafka(read_kafka_lines(...))`` and ``slide="3 seconds"``. The windows
    still open at the end of a bounded source are ranked by ``close_hot_items``.
    """
    spark = lines.sparkSession
    out_dir, checkpoint = _place(spark, out_dir).rstrip("/"), _place(spark, checkpoint).rstrip("/")
    parts = ingest_behavior(lines, on_bad)
    ranked = ranked_stream(parts.rows, "item_id", size, slide, "1 ms", keep=is_page_view(), n=n, emit="final", buckets=buckets, late=False)
    return _start(ranked, parts.rejects, on_bad, out_dir, checkpoint, trigger)


def close_hot_items(spark: SparkSession, out_dir: str, checkpoint: str, size: str = "1 hour", slide: str = "5 minutes",
                    n: int = 5) -> DataFrame:
    """After ``start_hot_items`` on a bounded source has ended: rank its last windows too, as the job on a file does.

    Returns all rankings: ``item_id, window_end, count, rank``.
    """
    out_dir, checkpoint = _place(spark, out_dir).rstrip("/"), _place(spark, checkpoint).rstrip("/")
    return close_bounded(spark, checkpoint, out_dir, "item_id", size, slide, n).select("item_id", "window_end", "count", "rank")


def start_hot_urls(lines: DataFrame, out_dir: str, checkpoint: str, size: str = "10 minutes",
                   slide: str = "5 seconds", delay: str = "1 second", lateness: str = "1 minute", n: int = 5,
                   emit: str = "update", on_bad: str = "fail", tz: str = "UTC",
                   trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Top ``n`` URLs by GET hits per sliding window with bounded disorder and
    allowed lateness. ``emit="update"``: every window a batch touches is ranked
    again over all its URLs; ``"final"``: once at close. One query without
    ``foreachBatch``; results by ``ranked.latest_rankings`` and ``ranked.late_rows``,
    rejected lines in ``<out_dir>-rejects``.

    Dates are strict: one-digit days, trailing text and 31/02 are malformed,
    which stops the stream with ``on_bad="fail"`` where the original's lenient
    parser went on.
    """
    spark = lines.sparkSession
    out_dir, checkpoint = _place(spark, out_dir).rstrip("/"), _place(spark, checkpoint).rstrip("/")
    parts = ingest_access_log(lines, on_bad, tz)
    ranked = ranked_stream(parts.rows, "url", size, slide, delay, lateness, is_get(), n, emit, count_col="url_count", buckets=buckets)
    return _start(ranked, parts.rejects, on_bad, out_dir, checkpoint, trigger)


def start_page_views(lines: DataFrame, out_path: str, checkpoint: str, size: str = "1 hour",
                     salted: bool = False, salts: int = 4, on_bad: str = "fail",
                     trigger: dict | None = None) -> StreamingQuery:
    """Total page views per tumbling window, appended to parquet at ``out_path``
    as each window closes; ``salted`` counts in two stages over ``salts``.

    With ``on_bad="reject"`` a second query, with its own checkpoint beside the
    first, appends the rejected lines to ``<out_path>-rejects``; find it in
    ``spark.streams.active``.
    """
    spark = lines.sparkSession
    out_path, checkpoint = _place(spark, out_path).rstrip("/"), _place(spark, checkpoint).rstrip("/")
    parts = ingest_behavior(lines, on_bad)
    totals = stream_page_views_salted(parts.rows, size, salts) if salted else stream_page_views(parts.rows, size)
    if on_bad == "reject":
        write_stream(parts.rejects, f"{checkpoint}-rejects", sink="parquet", path=f"{out_path}-rejects", trigger=trigger)
    return write_stream(totals, checkpoint, sink="parquet", path=out_path, trigger=trigger)
