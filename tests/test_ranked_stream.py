"""The keyed-state rankings as streams: emissions, late rows, state, restarts, bounded sources."""

import os
import random

import pytest
from pyspark.sql import functions as F

from clickstats.operators.late import split_late
from clickstats.operators.rank import top_n
from clickstats.operators.windows import windowed_count
from clickstats.streaming import ranked
from clickstats.streaming.sinks import write_stream


def write(folder, batches, start=0):
    """One file of ``key ms`` lines per micro-batch, in order."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches, start):
        path = f"{folder}/{i:04d}.txt"
        with open(path, "w") as f:
            f.write("".join(f"{k} {t}\n" for k, t in rows))
        os.utime(path, (1_000_000 + i * 10, 1_000_000 + i * 10))


def stream(spark, folder):
    parts = F.split("value", " ")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return (lines.select(parts[0].alias("key"), parts[1].cast("bigint").alias("event_ms"))
            .withColumn("event_time", F.timestamp_millis("event_ms")))


@pytest.fixture
def one_task(spark):
    """Few state stores, for speed."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def run(spark, scratch, batches, start=0, out="out", ckpt="ckpt", **kw):
    write(f"{scratch}/in", batches, start)
    df = ranked.ranked_stream(stream(spark, f"{scratch}/in"), "key", **{"size": "10 minutes", "slide": "10 minutes", "buckets": 2, **kw})
    q = write_stream(df, f"{scratch}/{ckpt}", path=f"{scratch}/{out}", partition_by="kind", trigger={"availableNow": True})
    q.awaitTermination(300)
    return q


def rankings(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["window_end"], r["version"] if "version" in df.columns else 0), {})[r["rank"]] = (r["key"], r["count"])
    return out


def brute_emissions(batches, size, slide, delay, lateness, n):
    """Counts per window, the rankings of each touched window batch by batch, and the late rows."""
    counts, seen, out, late = {}, None, {}, []
    for rows in batches:
        wm = None if seen is None else seen - delay
        touched = set()
        for k, t in rows:
            ends = [s + size for s in range((t - size) // slide * slide + slide, t + 1, slide)]
            still = [e for e in ends if wm is None or e - 1 + lateness > wm]
            if not still:
                late.append((k, t))
            for e in still:
                counts[(e, k)] = counts.get((e, k), 0) + 1
                touched.add(e)
        for e in touched:
            top = sorted(((-c, k) for (w, k), c in counts.items() if w == e))[:n]
            out.setdefault(e, []).append({i + 1: (k, -c) for i, (c, k) in enumerate(top)})
        seen = max([t for _, t in rows] + ([seen] if seen is not None else []))
    return counts, out, late


@pytest.mark.parametrize("seed,size,slide", [(1, 10_000, 4_000), (2, 12_000, 3_000), (3, 5_000, 5_000)])
def test_every_emission_equals_brute_force(spark, scratch, one_task, seed, size, slide):
    rnd = random.Random(seed)
    now, batches = 50_000, []
    for _ in range(6):
        now += rnd.randrange(0, 9_000)
        batches.append([(rnd.choice("abcd"), max(0, now - rnd.randrange(0, 25_000))) for _ in range(rnd.randrange(1, 9))])
    run(spark, scratch, batches, size=size, slide=slide, delay=1_000, lateness=4_000, n=2, write_counts=True)
    counts, emitted, late = brute_emissions(batches, size, slide, 1_000, 4_000, 2)
    got = rankings(ranked.emitted(spark, f"{scratch}/out", "rank"))
    for end, want in emitted.items():
        assert [v for (e, _), v in sorted(got.items()) if e == end] == want, end
    assert {e for e, _ in got} == set(emitted)
    final = ranked.final_counts(spark, f"{scratch}/ckpt", f"{scratch}/out", "key", size, slide)
    assert {(r["window_end"], r["key"]): r["count"] for r in final.collect()} == counts
    assert sorted((r["key"], r["event_ms"]) for r in ranked.late_rows(spark, f"{scratch}/out").collect()) == sorted(late)
    last = {(e, r): v for (e, _), ranks in rankings(ranked.latest_rankings(spark, f"{scratch}/out")).items() for r, v in ranks.items()}
    assert last == {(e, r): v for e, all_ in emitted.items() for r, v in all_[-1].items()}


def test_late_rows_and_watermarks(spark, scratch, one_task):
    """The late rows are the replay's, and as many as Spark's append form drops; the recorded watermarks are the replay's."""
    from clickstats.operators.late import batch_watermarks
    from clickstats.streaming.jobs import stream_counts
    from clickstats.streaming.progress import BatchRecorder
    batches = [[("a", 5_000_000), ("b", 1_000)], [("a", 10), ("c", 4_999_000)], [("a", 9_000_000)], [("b", 5_000_000), ("c", 8_500_000)], [("a", 20)]]
    recorder = BatchRecorder()
    spark.streams.addListener(recorder)
    try:
        q = run(spark, scratch, batches, delay="1 second")
        dropped = write_stream(stream_counts(stream(spark, f"{scratch}/in"), "key", "10 minutes", None, "1 second"), f"{scratch}/c2",
                               sink="memory", query_name="appended", trigger={"availableNow": True})
        dropped.awaitTermination(300)
        recorder.wait(q, 5)
        recorder.wait(dropped, 5)
    finally:
        spark.streams.removeListener(recorder)
    rows = spark.createDataFrame([(k, t, i) for i, b in enumerate(batches) for k, t in b], "key string, event_ms bigint, batch_id bigint")
    split = split_late(rows, F.lit(True), "10 minutes", "10 minutes", "1 second", "0 seconds")
    want = sorted((r["key"], r["event_ms"]) for r in split.late.collect())
    assert sorted((r["key"], r["event_ms"]) for r in ranked.late_rows(spark, f"{scratch}/out").collect()) == want and len(want) == 3
    mine = {r["batch_id"]: r for r in recorder.frame(spark, q).collect()}
    marks = {r["batch_id"]: r["watermark_ms"] for r in batch_watermarks(rows, "1 second").collect()}
    assert all(mine[b]["watermark_ms"] == (w or 0) for b, w in marks.items()) and len(marks) == 5
    assert [mine[i]["input_rows"] for i in range(5)] == [2, 2, 1, 2, 1] and mine[0]["max_event_ms"] == 5_000_000
    # Spark's own operators drop by the watermark of the batch before, so compare at the end, where it stands still.
    theirs = recorder.frame(spark, dropped).where("batch_id >= 4").agg(F.sum("dropped_rows")).first()[0]
    assert theirs == 1 and all(r["dropped_rows"] == 0 for r in mine.values())


def test_a_batch_reads_and_writes_the_keys_it_touches(spark, scratch, one_task):
    many = [(f"k{i}", 1_000_000 + i) for i in range(3_000)]
    q = run(spark, scratch, [many, [("k1", 1_000_500)], [("k2", 1_000_600)]], size="1 hour", slide="3 minutes")
    counter = {p["batchId"]: p["stateOperators"][1] for p in q.recentProgress}
    assert counter[0]["numRowsTotal"] >= 6_000  # each key in two blocks
    for i in (1, 2):
        assert counter[i]["numRowsUpdated"] <= 10 and counter[i]["customMetrics"]["rocksdbGetCount"] <= 60, counter[i]["customMetrics"]


def test_closed_windows_leave_the_state(spark, scratch, one_task):
    """Read by Spark's state reader: no block whose last window is past its retention, no timer of one, no ranked window past it."""
    batches = [[("a", 1_000), ("b", 2_000)], [("a", 5_000_000)], [("c", 9_000_000)], [("c", 9_000_001)]]
    run(spark, scratch, batches, slide="5 minutes", lateness="1 minute", retention="2 minutes", emit="final")
    watermark, size, slide, retention, width = 9_000_000, 600_000, 300_000, 120_000, 2

    def state(variable, operator):
        return spark.read.format("statestore").option("operatorId", operator).option("stateVarName", variable).load(f"{scratch}/ckpt")

    for variable, operator in (("counts", 1), ("tops", 1), ("fired", 0)):
        for r in state(variable, operator).collect():
            assert ((r["key"]["block"] + 1) * width - 1) * slide + size - 1 + retention > watermark, (variable, r)
    assert {(r["user_map_key"]["key"]) for r in state("counts", 1).collect()} == {"c"}
    for r in state("tops", 1).collect():
        assert all(w * slide + size - 1 + retention > watermark for w in r["value"]["win"])
    timers = spark.read.format("statestore").option("operatorId", 1).option("readRegisteredTimers", True).load(f"{scratch}/ckpt").collect()
    assert timers and all(t["expiration_timestamp_ms"] > watermark for t in timers)


def test_restart_goes_on_and_a_bounded_end_closes(spark, scratch, one_task):
    first, second = [[("a", 1), ("b", 2), ("b", 3)], [("a", 400_000)]], [[("b", 900_000)], [("a", 1_300_000), ("a", 1_300_001)]]
    kw = {"slide": "5 minutes", "emit": "final", "delay": "1 ms"}
    run(spark, scratch, first, **kw)
    args = (spark, f"{scratch}/ckpt", f"{scratch}/out", "key", "10 minutes", "5 minutes")
    cols = ("key", "window_end", "count", "rank")

    def batch(batches):
        rows = spark.createDataFrame([r for b in batches for r in b], "key string, event_ms bigint")
        return sorted(tuple(r[c] for c in cols) for r in top_n(windowed_count(rows, "key", "10 minutes", "5 minutes"), "key", 5).collect())

    assert sorted(tuple(r[c] for c in cols) for r in ranked.close_bounded(*args).collect()) == batch(first)
    run(spark, scratch, second, start=2, **kw)  # the same query goes on, the windows it had open included
    assert sorted(tuple(r[c] for c in cols) for r in ranked.close_bounded(*args).collect()) == batch(first + second)


def test_second_start_over_old_results_raises(spark, scratch, one_task):
    run(spark, scratch, [[("/old", 1)], [("/old", 2)]])
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, scratch, [[("/new", 3)]], start=2, ckpt="ckpt2")
    run(spark, scratch, [[("/new", 3)]], start=2)
    got = {(r["key"], r["count"], r["rank"]) for r in ranked.latest_rankings(spark, f"{scratch}/out").collect()}
    assert got == {("/old", 2, 1), ("/new", 1, 2)}


def test_final_mode_closes_a_window_at_a_row_at_its_end(spark, scratch, one_task):
    """Ascending time is 1 ms behind the latest event: the window of 0-599,999 ms closes at 600,000, not at 599,999."""
    kw = {"delay": "1 ms", "emit": "final"}
    run(spark, scratch, [[("a", 10)], [("a", 599_999)], [("b", 599_998)]], **kw)
    assert not os.path.exists(f"{scratch}/out/kind=rank")
    run(spark, scratch, [[("b", 600_000)]], start=3, **kw)
    got = {(r["window_end"], r["rank"]): (r["key"], r["count"]) for r in ranked.emitted(spark, f"{scratch}/out", "rank").collect()}
    assert got == {(600_000, 1): ("a", 2), (600_000, 2): ("b", 1)}


def test_arguments(spark, scratch):
    write(f"{scratch}/in", [[("a", 1)]])
    rows = stream(spark, f"{scratch}/in")
    with pytest.raises(ValueError, match="slide"):
        ranked.ranked_stream(rows, "key", "10 seconds", "11 seconds")
    with pytest.raises(ValueError, match="emit"):
        ranked.ranked_stream(rows, "key", "10 seconds", "1 second", emit="both")
    with pytest.raises(ValueError, match="plain"):
        ranked.ranked_stream(rows.withColumn("x", F.array("key")), "key", "10 seconds", "1 second")


def test_rejected_lines_are_written(spark, scratch):
    from clickstats.sources.lines import read_lines
    from clickstats.streaming.apps import start_hot_items, start_page_views
    from test_streaming import write_batches
    folder = write_batches(f"{scratch}/in", [["1,2,3,pv,5", "bad"], ["1,2,3,pv,9000"], ["1,x,3,pv,7"]])

    def lines():
        return read_lines(spark, folder, streaming=True, max_files_per_trigger=1)

    for start, out in ((lambda *a, **k: start_hot_items(*a, buckets=2, **k), "out"), (start_page_views, "pv")):
        q = start(lines(), f"{scratch}/{out}", f"{scratch}/c-{out}", on_bad="reject", trigger={"availableNow": True})
        for other in [*spark.streams.active, q]:
            other.awaitTermination(300)
        assert {r["value"] for r in spark.read.parquet(f"{scratch}/{out}-rejects").collect()} == {"bad", "1,x,3,pv,7"}


def test_both_late_outputs_in_one_pass(spark, scratch):
    rows = spark.createDataFrame([("a", t, b) for b, t in [(0, 1), (1, 9_000_000), (2, 5)]], "key string, event_ms bigint, batch_id bigint")
    split = split_late(rows, F.lit(True), "10 minutes", "5 minutes", "1 second", "1 minute")
    split.judged.write.partitionBy("is_late").parquet(f"{scratch}/both")
    both = spark.read.parquet(f"{scratch}/both")
    assert [r["event_ms"] for r in both.where("cast(is_late as boolean)").collect()] == [5]
    assert both.where("not cast(is_late as boolean)").count() == 2
