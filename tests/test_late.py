import random

from pyspark.sql import functions as F

from clickstats.operators.late import accepted_counts, running_max_before, split_late

# FIXTURES 6.5: 10 min windows sliding by 5 min, 1 s disorder, no lateness; two rows per batch.
BATCHES = [[("a", 0), ("a", 10)], [("b", 20), ("a", 290)], [("b", 310), ("a", 305)],
           [("b", 700), ("a", 640)], [("a", 100), ("z", 5000)], [("a", 650), ("z", 5100)]]


def fixture_rows(spark):
    data = [(k, s * 1000, b) for b, rows in enumerate(BATCHES) for k, s in rows]
    return spark.createDataFrame(data, "key string, event_ms bigint, batch_id bigint")


def test_replay_rule_on_fixture(spark):
    split = split_late(fixture_rows(spark), F.lit(True), "10 minutes", "5 minutes", "1 second", "0 seconds")
    assert sorted((r.key, r.event_ms) for r in split.late.collect()) == [("a", 100_000), ("a", 650_000)]
    counts = {(r.key, r.window_end // 1000): r["count"] for r in
              accepted_counts(split.on_time, "key", "10 minutes", "5 minutes", "0 seconds").collect()}
    assert counts == {("a", 300): 3, ("a", 600): 4, ("a", 900): 2, ("a", 1200): 1,
                      ("b", 300): 1, ("b", 600): 2, ("b", 900): 2, ("b", 1200): 1,
                      ("z", 5100): 1, ("z", 5400): 2, ("z", 5700): 1}


def test_lateness_keeps_windows_open(spark):
    # With 10 min of allowed lateness a100 is counted again; a650 comes after z5000 moved the
    # watermark to 4,999 s, past 1,200 s + 10 min, so it is still late.
    split = split_late(fixture_rows(spark), F.lit(True), "10 minutes", "5 minutes", "1 second", "10 minutes")
    assert [r.event_ms for r in split.late.collect()] == [650_000]
    counts = {(r.key, r.window_end // 1000): r["count"] for r in
              accepted_counts(split.on_time, "key", "10 minutes", "5 minutes", "10 minutes").collect()}
    assert counts[("a", 300)] == 4 and counts[("a", 600)] == 5 and counts[("a", 900)] == 2


def test_filtered_rows_still_move_the_watermark(spark):
    # Only 'a' is kept, but z5000 (batch 4) sets the watermark that makes a650 late.
    split = split_late(fixture_rows(spark), F.col("key") == "a", "10 minutes", "5 minutes", "1 second", "0 s")
    assert {r.event_ms for r in split.late.collect()} == {100_000, 650_000}
    assert split.on_time.where(F.col("key") != "a").count() == 0


def test_running_max_two_levels_matches_brute_force(spark):
    rnd = random.Random(3)
    data = [(b, rnd.randrange(1000)) for b in rnd.sample(range(2000), 60)]
    df = spark.createDataFrame(data, "b bigint, v bigint")
    got = {r.b: r.m for r in running_max_before(df, "b", "v", "m", fanout=256).collect()}
    for b, _ in data:
        earlier = [v for bb, v in data if bb < b]
        assert got[b] == (max(earlier) if earlier else None)


def test_on_time_plus_late_is_all_kept_rows(spark):
    from conftest import SF_SMALL
    from clickstats.plans import registered as R
    from clickstats.plans.jobs import is_get
    rows = R.arrival_log_rows(spark, SF_SMALL)
    split = split_late(rows, is_get(), "10 minutes", "5 seconds", "1 second", "1 minute")
    kept = rows.where(is_get()).select("event_ms", "url", "batch_id")
    on_time, late = split.on_time.select(kept.columns), split.late.select(kept.columns)
    assert late.count() > 0
    assert on_time.unionByName(late).exceptAll(kept).count() == 0
    assert kept.exceptAll(on_time.unionByName(late)).count() == 0
    assert on_time.join(late, kept.columns, "left_semi").count() == 0


def test_running_max_with_sparse_ids(spark):
    # Epoch-ms ids ten minutes apart: hardly two share a group at the lower levels.
    rnd = random.Random(4)
    data = [(1_700_000_000_000 + 600_000 * i, rnd.randrange(1000)) for i in range(300)] + [(-5, 3)]
    df = spark.createDataFrame(data, "b bigint, v bigint")
    got = {r.b: r.m for r in running_max_before(df, "b", "v", "m", fanout=1024).collect()}
    for b, _ in data:
        assert got[b] == max((v for bb, v in data if bb < b), default=None)
