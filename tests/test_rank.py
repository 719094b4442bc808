import random

import pytest
from pyspark.sql import Row

from clickstats.operators.rank import (COMPACT_ITEMS_LAYOUT, HOT_ITEMS_LAYOUT, HOT_URLS_LAYOUT, dyadic_pieces, render_report,
                                       top_n, top_n_runs)
from clickstats.operators.windows import windowed_count, windowed_runs


def counts(spark, data):
    return spark.createDataFrame(data, "item_id bigint, window_end bigint, count bigint")


# Fixed values below: the report texts of the original jobs, as printed.

def test_ties_lower_key_wins_and_fewer_than_n(spark):
    df = counts(spark, [(i, 1000, c) for i, c in [(9, 5), (3, 7), (4, 5), (8, 5), (1, 5), (2, 5), (6, 1)]]
                + [(1, 2000, 3)])
    got = {(r.window_end, r.rank): (r.item_id, r["count"]) for r in top_n(df, "item_id", 5).collect()}
    assert got == {(1000, 1): (3, 7), (1000, 2): (1, 5), (1000, 3): (2, 5), (1000, 4): (4, 5),
                   (1000, 5): (8, 5), (2000, 1): (1, 3)}


def test_report_text_layouts(spark):
    top = top_n(counts(spark, [(69, 1704070800000, 3), (7, 1704070800000, 4)]), "item_id", 5)
    rep = render_report(top, "item_id", HOT_ITEMS_LAYOUT).collect()
    assert rep == [Row(window_end=1704070800000, report=(
        "===========================\n窗口结束时间：2024-01-01 01:00:00.0\n"
        "top:1itemId:7商品热度:4\ntop:2itemId:69商品热度:3\n===========================\n"))]
    compact = render_report(top, "item_id", COMPACT_ITEMS_LAYOUT).first().report
    assert compact == ("窗口结束时间:2024-01-01 01:00:00.0top_1itemId:7count:4top_2itemId:69count:3"
                       "=========================\n")
    urls = spark.createDataFrame([("/a", 1704067205250, 2)], "url string, window_end bigint, url_count bigint")
    text = render_report(top_n(urls, "url", 5, count_col="url_count"), "url", HOT_URLS_LAYOUT,
                         count_col="url_count").first().report
    assert text == ("=============================\n窗口关闭时间：2024-01-01 00:00:05.25\n"
                    "topN1url:/a页面热度：2\n=============================\n")


def test_dyadic_pieces_cover_each_run_once(spark):
    rnd = random.Random(3)
    runs = [(i, a, a + rnd.randrange(0, 200)) for i, a in enumerate(rnd.randrange(-300, 300) for _ in range(200))]
    df = spark.createDataFrame(runs, "key int, first_window bigint, last_window bigint")
    for top in (0, 3, 6):
        got = {}
        for r in dyadic_pieces(df, ["key"], top).collect():
            assert 0 <= r["level"] <= top
            got.setdefault(r["key"], []).append((r["level"], r["node"]))
        for i, a, z in runs:
            covered = sorted(x for lvl, n in got[i] for x in range(n << lvl, (n + 1) << lvl))
            assert covered == list(range(a, z + 1)), (top, a, z)
            assert all(sum(lvl == k for lvl, _ in got[i]) <= 2 for k in range(top))


@pytest.mark.parametrize("size,slide,n,level", [("60 s", "3 s", 2, 10), ("60 s", "3 s", 1, 2), ("10 s", "4 s", 3, 10), ("50 s", "50 s", 2, 10),
                                                ("64 s", "1 s", 4, 0)])
def test_top_n_of_runs_equals_top_n_of_windows(spark, size, slide, n, level):
    """Ties, negative times, windows with fewer keys than n, many keys of one count."""
    rnd = random.Random(n)
    rows = spark.createDataFrame([(rnd.choice("abcdefgh"), rnd.randrange(-200_000, 400_000)) for _ in range(400)]
                                 + [(f"k{i}", 1_000_000) for i in range(50)], "key string, event_ms bigint")
    want = top_n(windowed_count(rows, "key", size, slide), "key", n).collect()
    cols = ("key", "window_end", "count", "rank")
    for limit in (False, True):
        got = top_n_runs(windowed_runs(rows, "key", size, slide), "key", n, size, slide, node_limit=limit, max_level=level).collect()
        assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(tuple(r[c] for c in cols) for r in want)


def test_top_n_of_runs_by_several_keys_and_of_no_rows(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 1, 8), (None, 1, 9)], "key string, part int, event_ms bigint")
    runs = windowed_runs(rows, ["key", "part"], 10, 5)
    got = top_n_runs(runs, ["key", "part"], 2, 10, 5).where("window_end = 10").orderBy("rank").collect()
    assert [(r["key"], r["part"], r["count"]) for r in got] == [("a", 1, 2), (None, 1, 1)]
    assert top_n_runs(windowed_runs(rows.where("false"), "key", 10, 5), "key", 2, 10, 5).collect() == []
    with pytest.raises(ValueError):
        top_n_runs(runs, "key", 0, 10, 5)
