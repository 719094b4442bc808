"""Top-N per window and the text report of a ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div, java_timestamp_text
from clickstats.operators.windows import duration_ms


def top_n(counts: DataFrame, key: str | list[str], n: int = 5, group_col: str = "window_end",
          count_col: str = "count", rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` highest counts of each window, with their 1-based rank.

    Ordered by count descending, ties broken by the key ascending (the
    original left ties in arrival order; this makes them repeatable). Windows
    with fewer than ``n`` keys keep them all. Spark plans ``row_number() <= n``
    as a ``WindowGroupLimit`` on both sides of the shuffle, so at most ``n``
    rows per window and map task are shuffled, however many keys a window has.
    """
    if n is None or n < 1:
        raise ValueError("n must be a positive integer")
    if counts.isStreaming:
        raise ValueError("top_n runs on batch DataFrames; for streams use "
                         "clickstats.streaming.ranked.ranked_stream")
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(group_col).orderBy(F.col(count_col).desc(), *[F.col(k).asc() for k in keys])
    return (counts.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))


#: Widest dyadic node of ``top_n_runs``, as a power of two.
MAX_LEVEL = 10


def dyadic_pieces(runs: DataFrame, cols: list[str], top: int, first: str = "first_window",
                  last: str = "last_window") -> DataFrame:
    """Cut each run of integers into dyadic nodes: ``cols..., level, node``, node n of level k being the integers
    ``[n * 2**k, (n + 1) * 2**k)``.

    The cut a segment tree makes: below ``top`` at most two nodes of each level, as many as needed at ``top``. The
    nodes of a run are disjoint and cover it exactly.
    """
    lo, hi = F.col(first), F.col(last) + 1
    nodes = []
    for k in range(top):
        a, z = -floor_div(-lo, 1 << k), floor_div(hi, 1 << k)
        nodes.append(F.when((a < z) & (a % 2 != 0), F.struct(F.lit(k).alias("level"), a.alias("node"))))
        nodes.append(F.when((a < z) & (z % 2 != 0), F.struct(F.lit(k).alias("level"), (z - 1).alias("node"))))
    a, z = -floor_div(-lo, 1 << top), floor_div(hi, 1 << top)
    whole = F.when(a < z, F.transform(F.sequence(a, z - 1), lambda n: F.struct(F.lit(top).alias("level"), n.alias("node"))))
    none = F.array().cast("array<struct<level:int,node:bigint>>")
    parts = F.concat(F.array_compact(F.array(*nodes)), F.coalesce(whole, none)) if top else F.coalesce(whole, none)
    return runs.select(*cols, F.inline(parts))


def top_n_runs(runs: DataFrame, key: str | list[str], n: int, size: str | int, slide: str | int,
               count_col: str = "count", rank_col: str = "rank", node_limit: bool = False,
               max_level: int = MAX_LEVEL) -> DataFrame:
    """``top_n`` of every window, from runs of windows (``windows.windowed_runs``): ``key, window_end, count, rank``.

    Runs are shuffled, not windows: each goes to the blocks of windows that it overlaps (a block is about one window
    length, so one or two), and only there is it laid out window by window and ranked. Same order and ties as ``top_n``.

    ``node_limit`` is for windows with very many keys. Runs are first cut into dyadic nodes of windows, and of each node
    the ``n`` best pieces are kept (a ``WindowGroupLimit`` on both sides of a shuffle): a piece with ``n`` better ones on
    the whole node is in no window's top ``n``. So at most ``n`` pieces a node reach a block, however many keys it has,
    for the price of a second shuffle.
    """
    if n is None or n < 1:
        raise ValueError("n must be a positive integer")
    keys = [key] if isinstance(key, str) else list(key)
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    # No block or node wider than about a window length: a row's run is hardly longer.
    top = min(max_level, max(0, (size_ms // slide_ms).bit_length() - 1))
    order = [F.col(count_col).desc(), *[F.col(k).asc() for k in keys]]
    if node_limit:
        pieces = dyadic_pieces(runs, [*keys, count_col], top)
        best = (pieces.withColumn("_place", F.row_number().over(Window.partitionBy("level", "node").orderBy(*order)))
                .where(F.col("_place") <= n))
        width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
        first = F.col("node") * width
        spans = best.select(*keys, count_col, first.alias("_lo"), (first + width - 1).alias("_hi"),
                            floor_div(first, 1 << top).alias("_block"))
    else:
        lo, hi, wide = F.col("first_window"), F.col("last_window"), 1 << top
        spans = runs.select(*keys, count_col, lo, hi, F.explode(F.sequence(floor_div(lo, wide), floor_div(hi, wide))).alias("_block"))
        begin = F.col("_block") * wide
        spans = spans.select(*keys, count_col, F.greatest(lo, begin).alias("_lo"), F.least(hi, begin + wide - 1).alias("_hi"), "_block")
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = spans.repartition(parts, "_block")
    step, span = F.lit(slide_ms).cast("bigint"), F.lit(size_ms)
    each = dealt.select(*keys, count_col, "_block", F.explode(
        F.sequence(F.col("_lo") * step + span, F.col("_hi") * step + span, step)).alias("window_end"))
    ranked = each.withColumn(rank_col, F.row_number().over(Window.partitionBy("_block", "window_end").orderBy(*order)))
    return ranked.where(F.col(rank_col) <= n).select(*keys, "window_end", count_col, rank_col)


@dataclass(frozen=True)
class ReportLayout:
    """Pieces of a ranking report: ``head + time_label + <window end> +
    after_time``, then per rank ``rank_label + r + key_label + key +
    count_label + count + row_end``, then ``tail``."""
    head: str
    time_label: str
    after_time: str
    rank_label: str
    key_label: str
    count_label: str
    row_end: str
    tail: str


# The three report layouts of the original jobs, text as printed.
HOT_ITEMS_LAYOUT = ReportLayout(
    head="===========================\n", time_label="窗口结束时间：", after_time="\n",
    rank_label="top:", key_label="itemId:", count_label="商品热度:", row_end="\n",
    tail="===========================\n")
HOT_URLS_LAYOUT = ReportLayout(
    head="=============================\n", time_label="窗口关闭时间：", after_time="\n",
    rank_label="topN", key_label="url:", count_label="页面热度：", row_end="\n",
    tail="=============================\n")
COMPACT_ITEMS_LAYOUT = ReportLayout(
    head="", time_label="窗口结束时间:", after_time="",
    rank_label="top_", key_label="itemId:", count_label="count:", row_end="",
    tail="=========================\n")


def render_report(top: DataFrame, key: str, layout: ReportLayout = HOT_ITEMS_LAYOUT,
                  group_col: str = "window_end", count_col: str = "count",
                  rank_col: str = "rank") -> DataFrame:
    """One text block per window from a ``top_n`` result: ``window_end, report``.

    The window end is printed as ``java.sql.Timestamp`` prints it, in UTC.
    Each window has at most N rows after ``top_n``, so gathering them into one
    array per window is bounded.
    """
    lit = F.lit
    line = F.concat(lit(layout.rank_label), F.col(rank_col).cast("string"), lit(layout.key_label),
                    F.col(key).cast("string"), lit(layout.count_label), F.col(count_col).cast("string"),
                    lit(layout.row_end))
    ranked = (top.groupBy(group_col)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), line.alias("l"))))
                   .alias("_lines")))
    body = F.array_join(F.transform(F.col("_lines"), lambda x: x["l"]), "")
    return ranked.select(
        group_col,
        F.concat(lit(layout.head), lit(layout.time_label), java_timestamp_text(F.col(group_col)),
                 lit(layout.after_time), body, lit(layout.tail)).alias("report"))
