import random

import pytest
from pyspark.sql import functions as F

from clickstats.operators.windows import duration_ms, interval_counts, windowed_count

H, M = 3_600_000, 60_000


def rows(spark, items):
    return spark.createDataFrame(items, "key string, event_ms bigint")


def as_set(df, count_col="count"):
    return {(r["key"], r["window_end"], r[count_col]) for r in df.collect()}


def brute(items, size, slide):
    """Reference: each row in every window [k*slide, k*slide+size) containing it."""
    out = {}
    for key, t in items:
        k = t // slide
        while k * slide + size > t:
            end = k * slide + size
            out[(key, end)] = out.get((key, end), 0) + 1
            k -= 1
    return {(k, e, c) for (k, e), c in out.items()}


@pytest.mark.parametrize("method", ["direct", "panes"])
def test_row_on_boundary_starts_window(spark, method):
    # t = 5 min exactly: windows ending 10 min .. 65 min (12 windows), not the one ending at 5 min.
    df = rows(spark, [("a", 5 * M)])
    got = as_set(windowed_count(df, "key", "1 hour", "5 minutes", method=method))
    assert got == {("a", (5 + 5 * j) * M, 1) for j in range(1, 13)}


@pytest.mark.parametrize("size,slide", [(H, 5 * M), (10 * M, 5000), (H, 3000), (10 * M, 5 * M), (H, H)])
def test_panes_equal_direct_and_brute_force(spark, size, slide):
    rnd = random.Random(size + slide)
    items = [(rnd.choice("abc"), rnd.randrange(0, 6 * H)) for _ in range(300)]
    items += [("a", 2 * H), ("a", 2 * H), ("b", 2 * H - 1)]  # duplicates and a row 1 ms before an edge
    df = rows(spark, items)
    want = brute(items, size, slide)
    assert as_set(windowed_count(df, "key", size, slide, method="panes")) == want
    if size // slide <= 120:
        assert as_set(windowed_count(df, "key", size, slide, method="direct")) == want


def test_sum_over_windows_is_rows_times_windows(spark):
    rnd = random.Random(1)
    items = [("k", rnd.randrange(0, 48 * H)) for _ in range(500)]
    c = windowed_count(rows(spark, items), "key", "1 hour", "5 minutes")
    assert c.agg(F.sum("count")).first()[0] == 12 * 500


def test_tumbling_no_key_and_empty(spark):
    df = rows(spark, [("a", 0), ("b", H - 1), ("c", H)])
    got = {(r.window_end, r["count"]) for r in windowed_count(df, None, "1 hour").collect()}
    assert got == {(H, 2), (2 * H, 1)}
    empty = rows(spark, [])
    assert windowed_count(empty, "key", "1 hour", "3 seconds").count() == 0


def test_small_blocks_spread_a_hot_key(spark):
    # A dense key over many blocks; block size forced small so intervals cross blocks.
    items = [("hot", t * 1000) for t in range(0, 3000, 7)]
    iv = (rows(spark, items).groupBy("key", (F.col("event_ms") / 5000).cast("bigint").alias("p"))
          .agg(F.count(F.lit(1)).alias("c"))
          .select("key", (F.col("p") - 11).alias("f"), F.col("p").alias("l"), "c"))
    got = as_set(interval_counts(iv, ["key"], "f", "l", "c", 60_000, 5000, block_windows=1))
    assert got == brute(items, 60_000, 5000)


def test_durations():
    assert duration_ms("1 hour") == H and duration_ms("3 seconds") == 3000 and duration_ms("10 min") == 10 * M
    with pytest.raises(ValueError):
        duration_ms("soon")


def test_sliding_without_key(spark):
    rnd = random.Random(5)
    items = [("all", rnd.randrange(0, 5 * H)) for _ in range(200)]
    df = rows(spark, items).drop("key")
    got = {("all", r.window_end, r["count"]) for r in windowed_count(df, None, "1 hour", "5 minutes").collect()}
    assert got == brute(items, H, 5 * M)
