"""Ingest jobs: raw lines -> typed rows, with malformed lines set aside or fatal.

Each line is parsed once. ``reason`` is the first problem found, checking the
fields in the order the original parsers read them; a null ``reason`` means the
row is clean. Columns other than ``value`` (a batch id, Kafka coordinates) are
carried through unchanged, so both outputs stay traceable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.functions.parse import field, parse_integer, parse_log_time_ms, split_fields

BEHAVIOR_COLUMNS = ["user_id", "item_id", "category_id", "behavior", "ts_sec", "event_ms", "event_time"]
ACCESS_LOG_COLUMNS = ["ip", "user_id", "event_ms", "event_time", "method", "url"]


@dataclass
class Ingested:
    rows: DataFrame      # typed rows (plus carried columns)
    rejects: DataFrame   # value string, reason string (plus carried columns)


def _first_problem(checks: list[tuple[Column, str]]) -> Column:
    expr = None
    for failed, reason in checks:
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr


def _once(df: DataFrame, keep: list[str], expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as column ``name``, evaluated once per row in its own plan node.

    Catalyst substitutes projected expressions into every filter it pushes
    below a projection, so a parse read by several checks would run once per
    check. A generator's output cannot be substituted: the expression runs
    once per row and later filters read its result.
    """
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


def _once_struct(df: DataFrame, keep: list[str], fields: Column) -> DataFrame:
    """Like ``_once`` for a struct, whose fields become columns."""
    return df.select(*keep, F.inline(F.array(fields)))


def _finish(parsed: DataFrame, typed: list[Column], carried: list[str], on_bad: str) -> Ingested:
    if on_bad not in ("fail", "reject"):
        raise ValueError("on_bad must be 'fail' or 'reject'")
    if on_bad == "fail":
        # Kept in a filter so that column pruning can never drop the check.
        guard = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("malformed line ("), F.col("reason"), F.lit("): "),
                                   F.col("value"))))
        rows = parsed.where(guard).select(*carried, *typed)
    else:
        rows = parsed.where(F.col("reason").isNull()).select(*carried, *typed)
    rejects = parsed.where(F.col("reason").isNotNull()).select(*carried, "value", "reason")
    return Ingested(rows, rejects)


def ingest_behavior(lines: DataFrame, on_bad: str = "fail") -> Ingested:
    """CSV behavior lines ``user,item,category,behavior,epoch_seconds`` -> rows.

    Output: user_id bigint, item_id bigint, category_id int, behavior string,
    ts_sec bigint, event_ms bigint, event_time timestamp. Extra fields are ignored.
    ``on_bad="fail"`` stops the job at the first malformed line, as the original
    parser does; ``"reject"`` routes it to ``rejects`` with a reason.
    """
    carried = [c for c in lines.columns if c != "value"]
    c = F.col
    keep = [*carried, "value"]
    parsed = _once_struct(_once(lines, keep, split_fields(c("value"), ","), "_w"), keep, F.struct(
        field(c("_w"), 0).alias("_f0"), field(c("_w"), 1).alias("_f1"), field(c("_w"), 2).alias("_f2"),
        field(c("_w"), 3).alias("behavior"), field(c("_w"), 4).alias("_f4"),
        parse_integer(field(c("_w"), 0)).alias("user_id"),
        parse_integer(field(c("_w"), 1)).alias("item_id"),
        parse_integer(field(c("_w"), 2), "int").alias("category_id"),
        parse_integer(field(c("_w"), 4)).alias("ts_sec")))
    reason = _first_problem([
        (c("_f0").isNull(), "user_id missing"), (c("user_id").isNull(), "user_id not an integer"),
        (c("_f1").isNull(), "item_id missing"), (c("item_id").isNull(), "item_id not an integer"),
        (c("_f2").isNull(), "category_id missing"), (c("category_id").isNull(), "category_id not an integer"),
        (c("behavior").isNull(), "behavior missing"),
        (c("_f4").isNull(), "timestamp missing"), (c("ts_sec").isNull(), "timestamp not an integer"),
        (F.try_multiply(c("ts_sec"), F.lit(1000)).isNull(), "timestamp out of range"),
    ])
    parsed = parsed.withColumn("reason", reason)
    typed = [c("user_id"), c("item_id"), c("category_id"), c("behavior"), c("ts_sec"),
             (c("ts_sec") * 1000).alias("event_ms"),
             F.timestamp_seconds(c("ts_sec")).alias("event_time")]
    return _finish(parsed, typed, carried, on_bad)


def ingest_access_log(lines: DataFrame, on_bad: str = "fail", tz: str = "UTC") -> Ingested:
    """Access-log lines ``ip user - dd/MM/yyyy:HH:mm:ss zone method url`` -> rows.

    Fields are split on single spaces; fields 2 and 4 (the zone offset) are
    ignored and the time is read in ``tz``. Dates are strict: impossible dates
    and trailing text are malformed. Output: ip, user_id string, event_ms bigint,
    event_time timestamp, method, url.
    """
    carried = [c for c in lines.columns if c != "value"]
    c = F.col
    keep = [*carried, "value"]
    parsed = _once_struct(_once(lines, keep, split_fields(c("value"), " "), "_w"), keep, F.struct(
        field(c("_w"), 0).alias("ip"), field(c("_w"), 1).alias("user_id"), field(c("_w"), 3).alias("_time"),
        field(c("_w"), 5).alias("method"), field(c("_w"), 6).alias("url"),
        parse_log_time_ms(field(c("_w"), 3), tz).alias("event_ms")))
    reason = _first_problem([
        (c("_time").isNull(), "time missing"), (c("event_ms").isNull(), "time not a date"),
        (c("method").isNull(), "method missing"), (c("url").isNull(), "url missing"),
    ])
    parsed = parsed.withColumn("reason", reason)
    typed = [c("ip"), c("user_id"), c("event_ms"), F.timestamp_millis(c("event_ms")).alias("event_time"),
             c("method"), c("url")]
    return _finish(parsed, typed, carried, on_bad)
