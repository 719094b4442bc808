import os

import pytest
from pyspark.sql import functions as F

from clickstats.operators.ingest import ingest_access_log, ingest_behavior
from clickstats.operators.late import accepted_counts, split_late
from clickstats.plans import jobs
from clickstats.plans.jobs import is_get, is_page_view
from clickstats.sources import standin
from clickstats.sources.lines import read_lines
from clickstats.sources.tables import load_table
from clickstats.streaming import ranked
from clickstats.streaming.jobs import stream_counts, stream_page_views_salted
from clickstats.streaming.sinks import write_stream
from conftest import SF_SMALL

ITEM = {"a": 1, "b": 2, "z": 26, "g": 7, "x": 8}
FIXTURE_65 = [["a0", "a10"], ["b20", "a290"], ["b310", "a305"], ["b700", "a640"], ["a100", "z5000"],
              ["a650", "z5100"]]


def write_batches(folder, batches):
    """One text file per micro-batch, modification times in batch order."""
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        p = os.path.join(folder, f"part-{i:05d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (1_000_000 + i * 10, 1_000_000 + i * 10))
    return folder


def behavior_line(token, behavior="pv"):
    key, sec = token[0], int(token[1:].lstrip("z") or 0)
    if token.startswith("x"):
        behavior = "buy"
    return f"1,{ITEM[key]},0,{behavior},{sec}"


def run_available(spark, df, scratch, name, mode="append", sink="memory", **kw):
    q = write_stream(df, f"{scratch}/ckpt-{name}", sink=sink, mode=mode, query_name=name,
                     trigger={"availableNow": True}, **kw)
    q.awaitTermination(300)
    return q


def stream_rows(spark, folder):
    return ingest_behavior(read_lines(spark, folder, streaming=True, max_files_per_trigger=1)).rows


def test_append_counts_follow_spark_late_rule(spark, scratch):
    folder = write_batches(f"{scratch}/in", [[behavior_line(t) for t in b] for b in FIXTURE_65])
    counts = stream_counts(stream_rows(spark, folder), "item_id", "10 minutes", "5 minutes", "1 second",
                           keep=is_page_view())
    run_available(spark, counts, scratch, "fx65")
    got = {(r.item_id, r.window_end // 1000): r["count"] for r in spark.table("fx65").collect()}
    # Spark drops late rows by the watermark of two batches back: a100 still counts in [0, 600).
    assert got == {(1, 300): 3, (1, 600): 5, (1, 900): 3, (1, 1200): 2,
                   (2, 300): 1, (2, 600): 2, (2, 900): 2, (2, 1200): 1}


def test_append_flush_by_far_future_row(spark, scratch):
    # FIXTURES 6.6: the last batch's far-future row closes every earlier window; its own stay open.
    batches = [["a0", "a10"], ["b20", "a290"], ["b310", "a305"], ["b700", "a640"], ["zz99999"]]
    folder = write_batches(f"{scratch}/in", [[behavior_line(t) for t in b] for b in batches])
    counts = stream_counts(stream_rows(spark, folder), "item_id", "10 minutes", "5 minutes", "1 second",
                           keep=is_page_view())
    run_available(spark, counts, scratch, "fx66")
    got = {(r.item_id, r.window_end // 1000): r["count"] for r in spark.table("fx66").collect()}
    assert got == {(1, 300): 3, (1, 600): 4, (1, 900): 2, (1, 1200): 1,
                   (2, 300): 1, (2, 600): 2, (2, 900): 2, (2, 1200): 1}


@pytest.mark.parametrize("guarded,expected", [(True, {300: 4}), (False, {})])
def test_watermark_taken_before_filter(spark, scratch, guarded, expected):
    batches = [["g0", "g10"], ["x5000", "x5000"], ["g20", "g30"], ["g40", "g50"]]
    folder = write_batches(f"{scratch}/in", [[behavior_line(t) for t in b] for b in batches])
    rows = stream_rows(spark, folder)
    if guarded:
        counts = stream_counts(rows, "item_id", "5 minutes", None, "1 second", keep=is_page_view())
    else:
        counts = stream_counts(rows.where(is_page_view()), "item_id", "5 minutes", None, "1 second")
    name = f"guard_{guarded}"
    run_available(spark, counts, scratch, name)
    assert {r.window_end // 1000: r["count"] for r in spark.table(name).collect()} == expected


def _sf_small_lines(spark):
    lines = standin.behavior_lines(load_table(spark, SF_SMALL, "events"))
    vals = [r.value for r in lines.collect()]
    return sorted(vals, key=lambda v: int(v.split(",")[4]))


def test_stream_salted_page_views(spark, scratch):
    vals = _sf_small_lines(spark)
    folder = write_batches(f"{scratch}/in", [vals[: len(vals) // 2], vals[len(vals) // 2:] +
                                             ["1,999999,0,pv,4102444800"]])
    run_available(spark, stream_page_views_salted(stream_rows(spark, folder)), scratch, "pvs")
    got = {(r.window_end, r["count"], r.pv) for r in spark.table("pvs").collect()}
    rows = ingest_behavior(spark.createDataFrame([(v,) for v in vals], "value string")).rows
    want = {(r.window_end, r["count"], r.pv) for r in jobs.page_views_salted(rows).collect()}
    assert got == want


def _late_stream(spark, scratch, batches, key, keep, size, slide, delay, lateness, parse):
    folder = write_batches(f"{scratch}/in", batches)
    rows = parse(read_lines(spark, folder, streaming=True, max_files_per_trigger=1)).rows
    out = ranked.ranked_stream(rows, key, size, slide, delay, lateness, keep, buckets=2, write_counts=True)
    run_available(spark, out, scratch, "late", sink="parquet", path=f"{scratch}/out", partition_by="kind")
    return ranked.final_counts(spark, f"{scratch}/ckpt-late", f"{scratch}/out", key, size, slide).cache()


def test_late_aware_stream_equals_replay_fixture(spark, scratch):
    batches = [[behavior_line(t) for t in b] for b in FIXTURE_65]
    counts = _late_stream(spark, scratch, batches, "item_id", is_page_view(), "10 minutes", "5 minutes",
                          "1 second", "0 seconds", ingest_behavior)
    got = {(r.item_id, r.window_end // 1000): r["count"] for r in counts.collect()}
    assert got == {(1, 300): 3, (1, 600): 4, (1, 900): 2, (1, 1200): 1, (2, 300): 1, (2, 600): 2,
                   (2, 900): 2, (2, 1200): 1, (26, 5100): 1, (26, 5400): 2, (26, 5700): 1}
    assert sorted(r.ts_sec for r in ranked.late_rows(spark, f"{scratch}/out").collect()) == [100, 650]
    # the last ranking emitted for each window is the top 5 of its final counts
    from clickstats.operators.rank import top_n
    last = {(r.item_id, r.window_end, r["count"], r.rank) for r in
            ranked.latest_rankings(spark, f"{scratch}/out").collect()}
    final = {(r.item_id, r.window_end, r["count"], r.rank) for r in top_n(counts, "item_id", 5).collect()}
    assert last == final


def test_late_aware_stream_equals_replay_on_table(spark, scratch):
    lines = standin.access_log_lines(load_table(spark, SF_SMALL, "events"), with_arrival=True)
    # Coarser arrival batches (7 days) keep the number of micro-batches small for a test.
    coarse = lines.select("value", F.floor(F.col("batch_id") / 1008).cast("bigint").alias("batch_id"))
    data = coarse.collect()
    ids = sorted({r.batch_id for r in data})
    batches = [[r.value for r in data if r.batch_id == b] for b in ids]
    counts = _late_stream(spark, scratch, batches, "url", is_get(), "10 minutes", "5 seconds", "1 second",
                          "1 minute", ingest_access_log)
    replay_rows = ingest_access_log(spark.createDataFrame(
        [(r.value, ids.index(r.batch_id)) for r in data], "value string, batch_id bigint")).rows
    split = split_late(replay_rows, is_get(), "10 minutes", "5 seconds", "1 second", "1 minute")
    want = {(r.url, r.window_end, r["count"]) for r in
            accepted_counts(split.on_time, "url", "10 minutes", "5 seconds", "1 minute").collect()}
    got = {(r.url, r.window_end, r["count"]) for r in counts.collect()}
    assert got == want and len(want) > 1000
    late = ranked.late_rows(spark, f"{scratch}/out")
    assert late.columns == [c for c in replay_rows.columns if c != "batch_id"]
    assert {tuple(r) for r in late.collect()} == {tuple(r) for r in split.late.drop("batch_id", "watermark_ms").collect()}
    from clickstats.operators.rank import top_n
    last = ranked.latest_rankings(spark, f"{scratch}/out").select("url", "window_end", "count", "rank")
    assert ({tuple(r) for r in last.collect()}
            == {tuple(r) for r in top_n(counts, "url", 5).select("url", "window_end", "count", "rank").collect()})


def _days_apart(vals, days):
    """The lines of the first days, few enough blocks of windows for a test."""
    first = int(vals[0].split(",")[4])
    return [v for v in vals if int(v.split(",")[4]) < first + days * 86_400]


@pytest.mark.parametrize("slide", ["5 minutes", "3 seconds"])
def test_app_hot_items_on_a_file_equals_batch(spark, scratch, slide):
    """A bounded source, without a closing row: the last windows are ranked when the run has ended."""
    from clickstats.streaming.apps import close_hot_items, start_hot_items
    vals = _days_apart(_sf_small_lines(spark), 4)
    chunks = [vals[j * len(vals) // 3:(j + 1) * len(vals) // 3] for j in range(3)]
    folder = write_batches(f"{scratch}/in", chunks)
    lines = read_lines(spark, folder, streaming=True, max_files_per_trigger=1)
    q = start_hot_items(lines, f"{scratch}/out", f"{scratch}/ckpt", slide=slide, trigger={"availableNow": True}, buckets=2)
    q.awaitTermination(300)
    rows = ingest_behavior(spark.createDataFrame([(v,) for v in vals], "value string")).rows
    want = {(r.item_id, r.window_end, r["count"], r.rank) for r in jobs.hot_items(rows, "1 hour", slide).collect()}
    before = {(r.item_id, r.window_end, r["count"], r.rank) for r in ranked.latest_rankings(spark, f"{scratch}/out").collect()}
    assert before < want  # the windows that event time has passed
    got = {tuple(r) for r in close_hot_items(spark, f"{scratch}/out", f"{scratch}/ckpt", slide=slide).collect()}
    assert got == want and len(want) > 200


def test_app_page_views_to_parquet(spark, scratch):
    from clickstats.streaming.apps import start_page_views
    vals = _sf_small_lines(spark)
    folder = write_batches(f"{scratch}/in", [vals[: len(vals) // 2], vals[len(vals) // 2:],
                                             ["1,999999,0,pv,4102444800"]])
    lines = read_lines(spark, folder, streaming=True, max_files_per_trigger=1)
    start_page_views(lines, f"{scratch}/out", f"{scratch}/ckpt", trigger={"availableNow": True}).awaitTermination(300)
    got = {(r.pv, r.window_end, r["count"]) for r in spark.read.parquet(f"{scratch}/out").collect()}
    rows = ingest_behavior(spark.createDataFrame([(v,) for v in vals], "value string")).rows
    assert got == {(r.pv, r.window_end, r["count"]) for r in jobs.page_views(rows).collect()}


def test_app_hot_urls_update_on_fixture(spark, scratch):
    import datetime as dt

    from clickstats.streaming.apps import start_hot_urls

    def log_line(token):
        key, sec = token[0], int(token[1:])
        when = dt.datetime.fromtimestamp(sec, dt.UTC).strftime("%d/%m/%Y:%H:%M:%S")
        return f"10.0.0.1 1 - {when} +0000 GET /{key}"

    folder = write_batches(f"{scratch}/in", [[log_line(t) for t in b] for b in FIXTURE_65]
                           + [["10.0.0.1 1 - 01/01/1970:00:00:01 +0000 POST /a"]])
    lines = read_lines(spark, folder, streaming=True, max_files_per_trigger=1)
    start_hot_urls(lines, f"{scratch}/out", f"{scratch}/ckpt", "10 minutes", "5 minutes", "1 second",
                   "0 seconds", trigger={"availableNow": True}, buckets=2).awaitTermination(300)
    got = {(r.url, r.window_end // 1000): r.url_count
           for r in ranked.latest_rankings(spark, f"{scratch}/out").collect()}
    assert got == {("/a", 300): 3, ("/a", 600): 4, ("/a", 900): 2, ("/a", 1200): 1, ("/b", 300): 1,
                   ("/b", 600): 2, ("/b", 900): 2, ("/b", 1200): 1, ("/z", 5100): 1, ("/z", 5400): 2,
                   ("/z", 5700): 1}
    late = sorted(r.event_ms // 1000 for r in ranked.late_rows(spark, f"{scratch}/out").collect())
    assert late == [100, 650]   # the POST row is filtered out, not a late GET row
    ranks = {(r.window_end // 1000, r.rank): r.url for r in ranked.latest_rankings(spark, f"{scratch}/out")
             .collect()}
    assert ranks[(600, 1)] == "/a" and ranks[(600, 2)] == "/b"


def test_batch_operators_refuse_streams_with_a_pointer(spark, scratch):
    from clickstats.operators.rank import top_n
    from clickstats.operators.windows import windowed_count
    folder = write_batches(f"{scratch}/in", [["1,1,0,pv,0"]])
    rows = stream_rows(spark, folder)
    with pytest.raises(ValueError, match="stream_counts"):
        windowed_count(rows, "item_id", "1 hour", "5 minutes")
    with pytest.raises(ValueError, match="ranked_stream"):
        top_n(rows.withColumnRenamed("ts_sec", "count").withColumnRenamed("event_ms", "window_end"), "item_id")


def test_kafka_shaped_stream_hot_items(spark, scratch):
    """W3: Kafka-shaped rows (the Kafka source's schema, read from parquet here) decoded and ranked
    per 1 h / 3 s window as a stream; equal to the batch job on the same lines."""
    from clickstats.sources.lines import decode_kafka
    from clickstats.streaming.apps import start_hot_items
    rows = standin.kafka_rows(load_table(spark, SF_SMALL, "events")).orderBy("offset").collect()
    rows = rows[:len(rows) // 8]
    sentinel = spark.createDataFrame([(None, bytearray(b"1,999999,0,pv,4102444800"), "hot", 0, 10**9, None, 0)],
                                     standin.kafka_rows(load_table(spark, SF_SMALL, "events")).schema)
    schema = sentinel.schema
    folder = f"{scratch}/kafka"
    thirds = [rows[i * len(rows) // 3:(i + 1) * len(rows) // 3] for i in range(3)]
    for i, part in enumerate(thirds):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/chunk={i}")
    sentinel.coalesce(1).write.parquet(f"{folder}/chunk=3")
    for i in range(4):  # one chunk per micro-batch, in order
        for f in os.listdir(f"{folder}/chunk={i}"):
            os.utime(f"{folder}/chunk={i}/{f}", (2_000_000 + i * 10, 2_000_000 + i * 10))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(folder))
    q = start_hot_items(decode_kafka(stream), f"{scratch}/out", f"{scratch}/ckpt", slide="3 seconds",
                        trigger={"availableNow": True}, buckets=2)
    q.awaitTermination(300)
    got = {(r.item_id, r.window_end, r["count"], r.rank)
           for r in ranked.latest_rankings(spark, f"{scratch}/out").collect()}
    batch_rows = ingest_behavior(decode_kafka(spark.createDataFrame(rows, schema)).select("value")).rows
    want = {(r.item_id, r.window_end, r["count"], r.rank)
            for r in jobs.hot_items(batch_rows, "1 hour", "3 seconds").collect()}
    assert got == want and len(want) > 10000


@pytest.mark.parametrize("size,slide", [("1 hour", "3 seconds"), ("10 seconds", "4 seconds")])
def test_fine_slides_in_two_chained_aggregations(spark, scratch, size, slide):
    from clickstats.streaming.jobs import stream_pane_counts
    vals = _days_apart(_sf_small_lines(spark), 2)
    folder = write_batches(f"{scratch}/in", [vals[: len(vals) // 2], vals[len(vals) // 2:], ["1,999999,0,pv,4102444800"],
                                             ["1,999999,0,pv,4102444801"]])
    rows = stream_rows(spark, folder)
    count = stream_counts if size == "1 hour" else stream_pane_counts
    q = run_available(spark, count(rows, "item_id", size, slide, keep=is_page_view()), scratch, f"panes{size[:2].strip()}")
    got = {(r.item_id, r.window_end, r["count"]) for r in spark.table(f"panes{size[:2].strip()}").collect()}
    batch = ingest_behavior(spark.createDataFrame([(v,) for v in vals], "value string")).rows
    want = {(r.item_id, r.window_end, r["count"]) for r in jobs.item_counts(batch, size, slide).collect()}
    assert got == want and len(want) > 30
    plan = q._jsq.explainInternal(False)
    raw = plan[plan.rindex("StateStoreSave"):]  # the first aggregation, down to the source
    assert plan.count("StateStoreSave") == 2 and "Expand" not in plan and "explode" not in raw, plan
