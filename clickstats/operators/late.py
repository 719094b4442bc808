"""Late data: watermarks per arrival batch, the late side output, and the
windows a row may still be counted in.

Rule (the original job's: bounded disorder, allowed lateness, side output):
the watermark is the largest event time seen so far minus the disorder bound.
A window ``[start, end)`` still takes rows while ``end - 1 + lateness >
watermark``. A row whose every window is past that goes to the late output;
a row with some windows open is counted in those only.

Here "seen so far" means: in earlier arrival batches. Each input row carries
the id of the micro-batch it arrives in, and a batch is judged by the
watermark the batches before it left, which is also how Spark advances a
streaming watermark. The original advanced it at a fixed interval of processing
time, so which rows it judged late there depended on the arrival speed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div
from clickstats.operators.windows import duration_ms, interval_counts, window_run
from clickstats.session import ensure_checkpoint_dir

# Fan-out of the tree over batch ids: no window of the running maximum holds more rows.
BATCH_FANOUT = 1 << 16


def running_max_before(per_batch: DataFrame, batch_col: str, value_col: str, out_col: str,
                       fanout: int = BATCH_FANOUT) -> DataFrame:
    """For each row (one per batch), the maximum of ``value_col`` over all rows
    with a smaller ``batch_col``; null for the first.

    A tree over the ids: level l groups them by ``id div fanout^l``. At each
    level a group takes the running maximum of the groups before it under the
    same parent, which are at most ``fanout`` however sparse the ids are; a
    batch's answer is the largest of its own and its ancestors'. All levels
    run in one window, so the plan does not grow with their number.
    """
    c = F.col
    widths = [1]
    while widths[-1] * fanout < 1 << 63:
        widths.append(widths[-1] * fanout)
    ids = [floor_div(c(batch_col), w) for w in widths] + [F.lit(0).cast("bigint")]
    levels = len(widths)
    nodes = F.array(*[F.struct(F.lit(lvl).alias("lvl"), ids[lvl + 1].alias("parent"), ids[lvl].alias("node"))
                      for lvl in range(levels)])
    each = per_batch.select(c(batch_col).alias("_b"), c(value_col).alias("_v"), F.inline(nodes))
    maxima = each.groupBy("lvl", "parent", "node").agg(F.max("_v").alias("_v"))
    before = Window.partitionBy("lvl", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    prefix = maxima.select("lvl", "parent", "node", F.max("_v").over(before).alias("_before"))
    found = (each.select("_b", "lvl", "parent", "node").join(prefix, ["lvl", "parent", "node"])
             .groupBy("_b").agg(F.max("_before").alias(out_col)))
    return per_batch.join(found, c(batch_col) == c("_b")).select(*per_batch.columns, out_col)


def batch_watermarks(rows: DataFrame, delay: str | int, batch_col: str = "batch_id",
                     time_col: str = "event_ms") -> DataFrame:
    """``batch_id, watermark_ms``: the watermark each arrival batch is judged by
    (max event time of all earlier batches minus ``delay``; null for none).

    The one pass over ``rows`` that finds the maxima reads only time and batch
    id; its result, one row per batch, is written to the shared checkpoint
    folder, so nothing after it parses the input again.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    per_batch = rows.groupBy(batch_col).agg(F.max(time_col).alias("_max")).checkpoint()
    before = running_max_before(per_batch, batch_col, "_max", "_max_before")
    return before.select(batch_col, (F.col("_max_before") - duration_ms(delay)).alias("watermark_ms"))


def accepted_windows(size_ms: int, slide_ms: int, lateness_ms: int, time_col: str = "event_ms",
                     wm_col: str = "watermark_ms") -> tuple[Column, Column]:
    """First and last index (window start / slide) of the windows a row is counted in.

    Of the run of windows the row lies in, those whose end fails ``end - 1 +
    lateness > watermark`` are closed for it. ``first > last`` means the row
    is late for all its windows.
    """
    first, last = window_run(size_ms, slide_ms, time_col)
    open_from = first_open(size_ms, slide_ms, lateness_ms, F.col(wm_col))
    return F.when(F.col(wm_col).isNull(), first).otherwise(F.greatest(first, open_from)), last


def first_open(size_ms: int, slide_ms: int, lateness_ms: int, watermark: Column) -> Column:
    """Index of the first window that still takes rows at a watermark."""
    return floor_div(watermark - lateness_ms - size_ms + 1, slide_ms) + 1


def expire_windows(counts: DataFrame, watermark_ms: Column | int | None, retention_ms: int) -> DataFrame:
    """Keep the windows that may still change: ``end - 1 + retention > watermark``
    (T3). A null watermark (nothing seen yet) expires nothing."""
    if watermark_ms is None:
        return counts
    wm = watermark_ms if isinstance(watermark_ms, Column) else F.lit(watermark_ms)
    return counts.where(wm.isNull() | (F.col("window_end") - 1 + F.lit(retention_ms) > wm))


def first_open_index(size_ms: int, slide_ms: int, lateness_ms: int, watermark_ms: int) -> int:
    """``first_open`` of plain numbers."""
    return (watermark_ms - lateness_ms - size_ms + 1) // slide_ms + 1


@dataclass
class LateSplit:
    judged: DataFrame      # kept rows + watermark_ms, is_late: write this to get both outputs from one pass
    on_time: DataFrame     # kept rows with at least one open window (+ watermark_ms)
    late: DataFrame        # kept rows late for every window (the side output)
    watermarks: DataFrame  # batch_id, watermark_ms


def split_late(rows: DataFrame, keep: Column, size: str | int, slide: str | int, delay: str | int,
               lateness: str | int, batch_col: str = "batch_id", time_col: str = "event_ms") -> LateSplit:
    """Split the rows ``keep`` selects into on-time and late.

    The watermark comes from all ``rows``; ``keep`` (the job's filter) is
    applied after it, as in the original, where filtered-out rows still
    move event time on. Both outputs keep the input columns; ``on_time``
    also has ``watermark_ms``. The input is parsed once here for the watermark
    table (one row per batch, see ``batch_watermarks``) and once by whatever
    reads the result; ``judged.write.partitionBy("is_late")`` writes both
    outputs in that one pass. Spark broadcasts the watermark table when its
    measured size allows (adaptive execution), else joins it by shuffle.
    """
    size_ms, slide_ms, lateness_ms = duration_ms(size), duration_ms(slide), duration_ms(lateness)
    wm = batch_watermarks(rows, delay, batch_col, time_col).checkpoint()
    kept = rows.where(keep).join(wm, batch_col, "left")
    first, last = accepted_windows(size_ms, slide_ms, lateness_ms, time_col)
    judged = kept.withColumn("is_late", F.coalesce(first > last, F.lit(False)))
    cols = list(rows.columns)
    return LateSplit(judged=judged.select(*cols, "watermark_ms", "is_late"),
                     on_time=judged.where(~F.col("is_late")).select(*cols, "watermark_ms"),
                     late=judged.where("is_late").select(*cols),
                     watermarks=wm)


def accepted_counts(on_time: DataFrame, key: str, size: str | int, slide: str | int,
                    lateness: str | int, time_col: str = "event_ms", count_col: str = "count") -> DataFrame:
    """Final count per key and window of the rows each window accepted, i.e.
    the last value a re-firing window (allowed lateness) reports:
    ``key, window_end, count``.

    Rows are grouped by (key, first open window, last window) before the coverage
    count, so nothing is expanded per row.
    """
    size_ms, slide_ms, lateness_ms = duration_ms(size), duration_ms(slide), duration_ms(lateness)
    first, last = accepted_windows(size_ms, slide_ms, lateness_ms, time_col)
    intervals = (on_time.select(key, first.alias("_first"), last.alias("_last"))
                 .groupBy(key, "_first", "_last").agg(F.count(F.lit(1)).alias("_c")))
    return interval_counts(intervals, [key], "_first", "_last", "_c", size_ms, slide_ms, count_col)
