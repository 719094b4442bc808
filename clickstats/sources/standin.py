"""Stand-in inputs rendered from the driver's ``events`` table.

The original jobs read behavior CSV lines, access-log lines and a Kafka topic,
none of which ship with it. These functions only render ``events`` rows into
those shapes, in Spark; every count, window and ranking is then computed by
the jobs from the rendered lines, exactly as it would be from real input.

Mapping: ``view`` -> behavior ``pv`` (other types keep their name), ``props.k``
-> item and URL ``/item/<k>``, ``k % 10`` -> category, ``10.0.0.<user % 256>`` ->
ip, view or click -> ``GET``, others -> ``POST``. Times are truncated to whole
seconds, as both line formats carry seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.functions.timecols import floor_div, ntz_epoch_micros


def _event_columns(events: DataFrame) -> DataFrame:
    micros = ntz_epoch_micros("ts")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        "event_id", "user_id", "event_type", "ts",
        floor_div(micros, 1_000_000).alias("ts_sec"),
        k.alias("k"),
    )


def _behavior_fields(e: DataFrame) -> list[Column]:
    c = F.col
    behavior = F.when(c("event_type") == "view", F.lit("pv")).otherwise(c("event_type"))
    return [c("user_id").cast("string"), c("k").cast("string"), F.pmod(c("k"), F.lit(10)).cast("string"),
            behavior, c("ts_sec").cast("string")]


def behavior_lines(events: DataFrame, broken_every: int | None = None) -> DataFrame:
    """``value`` = ``user,item,category,behavior,epoch_seconds`` per event.

    With ``broken_every`` = m, the line of every event whose id is a multiple
    of m is damaged in one of four ways (cycling): timestamp dropped, ``x``
    after the user id, spaces around the item id, or the line is ``bad``.
    """
    e = _event_columns(events)
    c = F.col
    fields = _behavior_fields(e)
    clean = F.concat_ws(",", *fields)
    if not broken_every:
        return e.select(clean.alias("value"))
    kind = F.pmod(floor_div(c("event_id"), broken_every), F.lit(4))
    broken = (F.when(kind == 0, F.concat_ws(",", *fields[:4]))
              .when(kind == 1, F.concat_ws(",", F.concat(fields[0], F.lit("x")), *fields[1:]))
              .when(kind == 2, F.concat_ws(",", fields[0], F.concat(F.lit(" "), fields[1], F.lit(" ")),
                                           *fields[2:]))
              .otherwise(F.lit("bad")))
    is_broken = F.pmod(c("event_id"), F.lit(broken_every)) == 0
    return e.select(F.when(is_broken, broken).otherwise(clean).alias("value"))


def _log_fields(e: DataFrame) -> list[Column]:
    c = F.col
    ts = c("ts")
    when_text = F.format_string("%02d/%02d/%04d:%02d:%02d:%02d", F.dayofmonth(ts), F.month(ts), F.year(ts),
                                F.hour(ts), F.minute(ts), F.second(ts))
    method = F.when(c("event_type").isin("view", "click"), F.lit("GET")).otherwise(F.lit("POST"))
    return [F.concat(F.lit("10.0.0."), F.pmod(c("user_id"), F.lit(256)).cast("string")),
            c("user_id").cast("string"), F.lit("-"), when_text, F.lit("+0000"), method,
            F.concat(F.lit("/item/"), c("k").cast("string"))]


def access_log_lines(events: DataFrame, broken_every: int | None = None,
                     with_arrival: bool = False) -> DataFrame:
    """``value`` = ``ip user - dd/MM/yyyy:HH:mm:ss +0000 method url`` per event.

    With ``broken_every`` = m, every m-th event's line is damaged (cycling):
    day 31 of February, text after the time, only four fields, or ``bad``.
    With ``with_arrival``, a ``batch_id`` column says in which 10-minute
    micro-batch the line arrives (see ``arrival_batch``).
    """
    e = _event_columns(events)
    c = F.col
    fields = _log_fields(e)
    clean = F.concat_ws(" ", *fields)
    value = clean
    if broken_every:
        kind = F.pmod(floor_div(c("event_id"), broken_every), F.lit(4))
        bad_date = F.concat(F.lit("31/02/"), F.year(c("ts")).cast("string"), F.lit(":00:00:00"))
        broken = (F.when(kind == 0, F.concat_ws(" ", *fields[:3], bad_date, *fields[4:]))
                  .when(kind == 1, F.concat_ws(" ", *fields[:3], F.concat(fields[3], F.lit("Z")), *fields[4:]))
                  .when(kind == 2, F.concat_ws(" ", *fields[:4]))
                  .otherwise(F.lit("bad")))
        value = F.when(F.pmod(c("event_id"), F.lit(broken_every)) == 0, broken).otherwise(clean)
    cols = [value.alias("value")]
    if with_arrival:
        cols.append(arrival_batch(c("event_id"), c("ts_sec")).alias("batch_id"))
    return e.select(*cols)


def arrival_batch(event_id: Column, ts_sec: Column) -> Column:
    """Arrival micro-batch of an event: 10-minute buckets of arrival time.

    ``events`` is in time order, so disorder is derived: every 10th event
    arrives ``((event_id / 10) % 7) * 10`` minutes after its event time, the
    rest on time.
    """
    delay_min = F.when(F.pmod(event_id, F.lit(10)) == 0,
                       F.pmod(floor_div(event_id, 10), F.lit(7)) * 10).otherwise(F.lit(0))
    return floor_div(ts_sec + delay_min * 60, 600)


def kafka_rows(events: DataFrame, topic: str = "hot") -> DataFrame:
    """Rows shaped like Spark's Kafka source, each value a behavior line."""
    e = _event_columns(events)
    c = F.col
    fields = _behavior_fields(e)
    return e.select(
        c("user_id").cast("string").cast("binary").alias("key"),
        F.concat_ws(",", *fields).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        c("event_id").alias("offset"),
        F.timestamp_seconds(c("ts_sec")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
