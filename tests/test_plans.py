"""Physical-plan shape: the scale properties the README claims, checked on real plans."""

import re

from pyspark.sql import functions as F

from clickstats.operators.ingest import ingest_behavior
from clickstats.operators.rank import top_n
from clickstats.operators.windows import windowed_count
from clickstats.plans import jobs
from conftest import lines_df


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+(?:\([^)]*\))?)", text)


def rows(spark):
    return spark.createDataFrame([("a", 1000 * i) for i in range(100)], "key string, event_ms bigint")


def test_parse_runs_once_per_line(spark):
    df = ingest_behavior(lines_df(spark, ["1,2,3,pv,5"]), on_bad="reject").rows.where(jobs.is_page_view())
    text = plan(df)
    assert text.count("split(") == 1, text
    assert "Generate" in text


def test_sliding_counts_shuffle_pane_counts_then_time_blocks(spark):
    text = plan(windowed_count(rows(spark), "key", "1 hour", "3 seconds"))
    ex = exchanges(text)
    assert len(ex) == 2, ex
    assert "_blk" in ex[0] and "_blk" not in ex[1], ex              # top: (key, block); below: (key, pane)
    assert "partial_count" in text                                  # map-side aggregate before the shuffle
    assert "Expand" not in text and "Broadcast" not in text and "SinglePartition" not in text


def test_top_n_limits_before_the_shuffle(spark):
    counts = windowed_count(rows(spark), "key", "1 hour", "5 minutes")
    text = plan(top_n(counts, "key", 5))
    assert text.count("WindowGroupLimit") == 2, text
    assert "SinglePartition" not in text


def test_page_views_shared_key_is_pre_aggregated(spark):
    df = rows(spark).withColumn("behavior", F.lit("pv"))
    text = plan(jobs.page_views(df))
    assert "partial_count" in text and "SinglePartition" not in text


def test_late_split_parses_once_and_has_no_single_partition(spark):
    from conftest import SF_SMALL
    from clickstats.plans import registered
    for name in ("late_rows", "on_time_rows", "hot_urls_updated"):
        text = plan(registered.QUERIES[name](spark, SF_SMALL))
        assert "SinglePartition" not in text, name
        assert text.count("split(") == 1, name  # the other parse made the watermark table, which is read from its checkpoint


def test_any_size_and_slide_without_expansion(spark):
    for size, slide in (("1 hour", "7 seconds"), ("10 seconds", "4 seconds"), ("10 minutes", "5 minutes")):
        text = plan(windowed_count(rows(spark), "key", size, slide))
        assert "Expand" not in text and len(exchanges(text)) == 2, (size, slide)


def test_tables_are_read_as_they_are(spark):
    from conftest import SF_SMALL
    from clickstats.plans import registered
    text = plan(registered.QUERIES["filter_pv"](spark, SF_SMALL))
    assert "Exchange" not in text and "event_id" not in text


def test_fine_slides_shuffle_runs_and_lay_windows_out_last(spark):
    df = rows(spark).withColumn("behavior", F.lit("pv")).withColumnRenamed("key", "item_id")
    for method, shuffles in (("runs", 3), ("nodes", 4)):
        text = plan(jobs.hot_items(df, "1 hour", "3 seconds", 5, method))
        ex = exchanges(text)
        assert len(ex) == shuffles and "_block" in ex[0] and "_blk" in ex[-2], ex
        assert not any("window_end" in e for e in ex) and "SinglePartition" not in text, ex
        above = text[:text.index("Exchange")]
        assert above.count("Generate") == 1 and "sequence(" in above            # windows appear after the last shuffle
        if method == "nodes":
            assert "WindowGroupLimit [level" in text[text.index("Exchange hashpartitioning(level"):]  # n pieces of a node leave a task


def test_every_ranking_method_gives_the_same_rows(spark):
    df = spark.range(600).select((F.col("id") % 60).alias("item_id"), F.lit("pv").alias("behavior"), (F.col("id") * 7_001).alias("event_ms"))
    cols = ("item_id", "window_end", "count", "rank")
    got = [sorted(tuple(r[c] for c in cols) for r in jobs.hot_items(df, "10 minutes", "2 minutes", 2, m).collect())
           for m in ("auto", "direct", "runs", "nodes")]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) > 50


def test_rankings_limit_windows_before_the_shuffle(spark):
    df = rows(spark).withColumn("behavior", F.lit("pv")).withColumnRenamed("key", "item_id")
    assert plan(jobs.hot_items(df, "1 hour", "3 seconds", 5)).count("WindowGroupLimit") == 2
