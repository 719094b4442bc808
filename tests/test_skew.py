"""A key holding a third of all rows must not end up in one task."""

import random

from pyspark.sql import functions as F

from clickstats.operators.windows import windowed_count
from clickstats.operators.late import expire_windows


def test_hot_key_is_spread_over_partitions(spark):
    rnd = random.Random(7)
    hours = 72
    rows = [("hot", rnd.randrange(hours * 3_600_000)) for _ in range(3000)]
    rows += [(f"k{rnd.randrange(500)}", rnd.randrange(hours * 3_600_000)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "key string, event_ms bigint")
    counts = windowed_count(df, "key", "1 hour", "3 seconds")
    per_part = (counts.where(F.col("key") == "hot")
                .groupBy(F.spark_partition_id().alias("p")).count().collect())
    total = sum(r["count"] for r in per_part)
    assert len(per_part) >= 3, per_part                      # several tasks share the hot key
    assert max(r["count"] for r in per_part) < 0.6 * total   # none holds most of it
    # and the counts are right: every hot row lies in 1,200 windows
    assert counts.where(F.col("key") == "hot").agg(F.sum("count")).first()[0] == 3000 * 1200


def test_expire_windows(spark):
    df = spark.createDataFrame([(1, 1000), (2, 2000), (3, 3000)], "k int, window_end bigint")
    assert [r.k for r in expire_windows(df, 2500, 500).collect()] == [3]     # 2000 - 1 + 500 <= 2500
    assert expire_windows(df, None, 500).count() == 3
    assert [r.k for r in expire_windows(df, F.lit(None).cast("bigint"), 500).collect()] == [1, 2, 3]
