"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Documents of a source are cut into blocks. With integer weights a_s and
Q = sum a_s, block j (from 0) of source s is released at slot floor(j Q / a_s)
and due by slot ceil((j + 1) Q / a_s). One block runs per slot: among the
released ones the one with the earliest deadline. For one processor at full
load this keeps every source within one block of its share at any slot, and
the schedule repeats after Q slots, so one period is worked out and every
block finds its slot by arithmetic. When a source runs out, the next phase
begins with the weights of the sources that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickstats.llm.tables import fresh

#: Bins of a source's documents for numbering them; no window holds more than a bin of one source or all bins of one.
BINS = 4096
REST = "~rest"


def _phases(blocks: dict[str, int], weights: dict[str, int]) -> list[dict]:
    """Phases of whole periods; in each, the sources that still have blocks, and their first block."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    base, out = 0, []
    while left:
        live = sorted(left)
        periods = min(-(-left[s] // weights[s]) for s in live)
        out.append({"sources": live, "weights": [weights[s] for s in live], "start": [done[s] for s in live], "base": base})
        base += periods * sum(weights[s] for s in live)
        for s in live:
            done[s] += periods * weights[s]
            left[s] -= periods * weights[s]
        left = {s: n for s, n in left.items() if n > 0}
    return out


def _one_period(weights: Column, total: Column) -> Column:
    """array<int>: for each slot of a period the index of the source that runs, by earliest deadline among the released."""
    n = F.size(weights)
    first = F.struct(F.array_repeat(F.lit(0), n).alias("given"), F.array().cast("array<int>").alias("plan"))

    def step(acc, slot):
        ready = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(
            F.floor(acc["given"][i] * total / weights[i]) <= slot,
            F.struct(F.ceil((acc["given"][i] + 1) * total / weights[i]).alias("due"), i.alias("i"))))
        pick = F.array_min(F.array_compact(ready))["i"]
        return F.struct(F.transform(acc["given"], lambda g, i: F.when(i == pick, g + 1).otherwise(g)).alias("given"),
                        F.concat(acc["plan"], F.array(pick)).alias("plan"))

    return F.aggregate(F.sequence(F.lit(0), total - 1), first, step, lambda acc: acc["plan"])


def mix_sources(docs: DataFrame, weights: dict[str, int], rest_weight: int = 1, block_rows: int = 64,
                source: str = "source", key: str = "doc_id", text: str = "text", out: tuple = (
                "mix_source", "block", "block_row", "release", "deadline", "slot")) -> DataFrame:
    """Every row of ``docs`` once, with its place in the mix.

    Added columns (names in ``out``): the scheduled source, its block (from 0), the
    row in the block, the block's release slot, deadline slot (exclusive) and
    slot. ``ORDER BY slot, block_row`` is the mixed order; no slot holds two
    blocks, and slots of sources that ran out in a phase's last period stay
    empty. Sources not named in ``weights``, and null, run together as one
    source with ``rest_weight``. Within a source the order is by a hash of the
    key (of the text where the key is null); equal rows are interchangeable.
    Weights are positive integers; their sum bounds the schedule's period.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    if any(int(w) != w or w < 1 for w in [*weights.values(), rest_weight]):
        raise ValueError("weights must be positive integers")
    s, h, b, r, n, at, before, spans, mine = fresh(docs, "mix_s", "mix_h", "mix_bin", "mix_rn", "mix_n", "mix_at",
                                                   "mix_before", "mix_spans", "mix_mine")
    known = sorted(weights)
    named = F.when(F.col(source).isin(known), F.col(source)).otherwise(F.lit(REST)) if known else F.lit(REST)
    rows = docs.withColumn(s, named)
    rows = rows.withColumn(h, F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key)))
                           .otherwise(F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    rows = rows.withColumn(b, F.pmod(F.col(h), F.lit(BINS)).cast("int"))
    sizes = rows.groupBy(s, b).agg(F.count(F.lit(1)).alias(n))
    before_bin = Window.partitionBy(s).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(before, F.coalesce(F.sum(n).over(before_bin), F.lit(0)))

    # One row per named source: as many as the caller gave weights.
    counts = {x[0]: x[1] for x in sizes.groupBy(s).agg(F.sum(n)).collect()}
    phases = _phases({x: -(-c // block_rows) for x, c in counts.items()}, {**weights, REST: rest_weight})
    if not phases:
        blank = [F.lit(None).cast(t).alias(c) for c, t in zip(out, ("string", "long", "int", "long", "long", "long"))]
        return docs.where(F.lit(False)).select("*", *blank)

    def sql_array(xs, cast=""):
        return "array(" + ", ".join(f"{x}{cast}" for x in xs) + ")"

    def sql_text(x):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join(f"({i}, {sql_array(map(sql_text, p['sources']))}, {sql_array(p['weights'], 'L')}, "
                       f"{sql_array(p['start'], 'L')}, {p['base']}L)" for i, p in enumerate(phases))
    phase = spark.sql(f"SELECT * FROM VALUES {values} AS t(phase, names, ws, starts, base)")
    total = F.aggregate("ws", F.lit(0).cast("long"), lambda a, x: a + x)
    phase = phase.withColumn("period", total)
    plan = phase.withColumn("plan", _one_period(F.col("ws"), F.col("period").cast("int")))
    plan = plan.select("phase", "names", F.posexplode("plan").alias("slot_in", "i"))
    turn = F.row_number().over(Window.partitionBy("phase", "i").orderBy("slot_in")) - 1
    plan = plan.select("phase", F.element_at("names", F.col("i") + 1).alias("name"), turn.alias("turn"), "slot_in")
    steps = phase.select("phase", "base", "period", F.posexplode("names").alias("i", "name"), "ws", "starts")
    steps = steps.select("name", F.struct(F.element_at("starts", F.col("i") + 1).alias("start"), "phase", "base", "period",
                                          F.element_at("ws", F.col("i") + 1).alias("w")).alias("p"))
    steps = steps.groupBy("name").agg(F.array_sort(F.collect_list("p")).alias(spans)).withColumnRenamed("name", mine)
    p_name, p_phase, p_turn, p_slot = fresh(docs, "mix_pn", "mix_pp", "mix_pt", "mix_ps")
    plan = plan.toDF(p_phase, p_name, p_turn, p_slot)

    order = Window.partitionBy(s, b).orderBy(h, F.col(key).asc_nulls_last())
    placed = rows.withColumn(r, F.row_number().over(order))
    o_s, o_b = fresh(docs, "mix_os", "mix_ob")
    offsets = offsets.select(F.col(s).alias(o_s), F.col(b).alias(o_b), before)
    # At most (sources + 1) * BINS rows, sources phases and sources * period rows: all bounded by the parameters.
    placed = placed.join(F.broadcast(offsets), (F.col(s) == F.col(o_s)) & (F.col(b) == F.col(o_b)))
    placed = placed.withColumn(at, F.col(before) + F.col(r) - 1)
    placed = placed.withColumn(n, F.floor(F.col(at) / block_rows))
    placed = placed.join(F.broadcast(steps), F.col(s) == F.col(mine))
    placed = placed.withColumn(spans, F.element_at(F.filter(F.col(spans), lambda x: x["start"] <= F.col(n)), -1))
    since = F.col(n) - F.col(f"{spans}.start")
    placed = placed.withColumn(before, F.floor(since / F.col(f"{spans}.w")))
    placed = placed.withColumn(r, F.pmod(since, F.col(f"{spans}.w")).cast("int"))
    placed = placed.join(F.broadcast(plan), (F.col(s) == F.col(p_name)) & (F.col(f"{spans}.phase") == F.col(p_phase))
                         & (F.col(r) == F.col(p_turn)))
    base = F.col(f"{spans}.base") + F.col(before) * F.col(f"{spans}.period")
    added = [F.col(s), F.col(n).cast("long"), F.pmod(F.col(at), F.lit(block_rows)).cast("int"),
             (base + F.floor(F.col(r) * F.col(f"{spans}.period") / F.col(f"{spans}.w"))).cast("long"),
             (base + F.ceil((F.col(r) + 1) * F.col(f"{spans}.period") / F.col(f"{spans}.w"))).cast("long"),
             (base + F.col(p_slot)).cast("long")]
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], *[e.alias(c) for e, c in zip(added, out)])
