"""Filter interaction audit: what each filter of a cascade removes in every order.

Each document gets a set of failed filters. Filters on the text alone are
column conditions; "repeats an earlier text" is an existential self-join: a
document fails if some other row has the same hash, the same text and a
smaller id. The ids that fail are put together, one bit per filter, and counted
by combination of bits; every order of the filters is then read off the
combinations, of which there are at most ``2 ** filters`` in each part.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import fresh, text_column

#: A group of copies is dealt out in lots of about so many rows when it meets its first text.
LOT_ROWS = 1000


def word_list(text: Column) -> Column:
    """The words of a text: maximal runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def few_words(least: int) -> Callable[[Column, Column], Column]:
    return lambda text, words: F.size(words) < least


def repeated_words(percent: int) -> Callable[[Column, Column], Column]:
    """Fewer distinct words than ``percent`` of all words."""
    return lambda text, words: 100 * F.size(F.array_distinct(words)) < percent * F.size(words)


def many_capitals(percent: int) -> Callable[[Column, Column], Column]:
    """More than ``percent`` of the code points are A-Z."""
    return lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > percent * F.length(text)


def holds_any(characters: str) -> Callable[[Column, Column], Column]:
    return lambda text, words: reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in characters], F.lit(False))


def repeats_earlier_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text some row with a smaller ``key`` has too, with all columns.

    A left-semi join on the hash, the exact text and the smaller key. Null
    counts as the empty text; a row without a key is never a repeat, nor the
    earlier one; rows with one key are not earlier than each other.

    Only rows whose hash occurs under several keys take part. The right side
    is one row for each distinct text of them, with its smallest key, after a
    partial aggregate. A large group is dealt out in lots of ``LOT_ROWS`` rows,
    with the first text sent to each lot.
    """
    h, t, first, n, lot, low = fresh(docs, "text_hash", "whole_text", "first_key", "copies", "lot", "earliest")
    k = F.col(f"`{key}`")
    rows = docs.withColumn(t, text_column(text)).withColumn(h, F.xxhash64(t))
    seen = rows.groupBy(h).agg(F.min(k).alias(first), F.max(k).alias(low), F.count(F.lit(1)).alias(n))
    seen = seen.where(F.col(first) < F.col(low)).select(h, first, F.ceil(F.col(n) / LOT_ROWS).cast("int").alias(n))
    rows = rows.where(k.isNotNull()).join(seen, h)
    lots = rows.groupBy(h, t, n).agg(F.min(k).alias(low))
    lots = lots.select(h, t, low, F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(lot))
    later = rows.where(k > F.col(first)).withColumn(lot, F.pmod(F.xxhash64(k), F.col(n)).cast("int"))
    later, lots = later.alias("later"), lots.alias("lots")
    same = [F.col(f"later.{c}") == F.col(f"lots.{c}") for c in (h, t, lot)]
    found = later.join(lots, [*same, F.col("lots." + low) < F.col(f"later.`{key}`")], "left_semi")
    return found.select(*[F.col(f"later.`{c}`") for c in docs.columns])


def failure_counts(docs: DataFrame, filters: dict[str, Callable[[Column, Column], Column]], repeats: str | None = None,
                   key: str = "doc_id", text: str = "text", part: str = "lang", labels: DataFrame | None = None,
                   marks: tuple[str, ...] = ()) -> DataFrame:
    """(part, bits, n, one count for each of ``marks``): documents by the set of filters they fail.

    Bit i stands for the i-th of ``filters``, the bit after them for
    ``repeats_earlier_text`` if ``repeats`` names it. ``marks`` are columns of
    ``labels``; a document has a mark if any row of its key says 1. A null part
    counts as the empty string, a null text as the empty text. Every row is a
    document, repeated rows too. Rows are told apart by key, part and a hash of
    the text. An empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                      text_column(text).alias("text"))
    own = own.withColumn("row", F.xxhash64("text"))
    read = own.select("key", "part", "row", "text", word_list(F.col("text")).alias("words"))
    bits = F.lit(0)
    for i, fails in enumerate(filters.values()):
        bits = bits + F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0)
    ids = read.select("key", "part", "row", bits.alias("bits"), F.lit(1).cast("long").alias("n"))
    if repeats is not None:
        later = repeats_earlier_text(own, "key", "text")
        ids = ids.unionAll(later.select("key", "part", "row", F.lit(1 << len(filters)).alias("bits"), F.lit(0).cast("long").alias("n")))
    one = ids.groupBy("key", "part", "row").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    if labels is not None and marks:
        said = labels.select(F.col(key).alias("id"), *[(F.col(m) == 1).alias(f"m{i}") for i, m in enumerate(marks)])
        said = said.where(F.col("id").isNotNull()).groupBy("id", F.lit(0).cast("long").alias("deal")).agg(
            *[F.coalesce(F.max(f"m{i}"), F.lit(False)).alias(f"m{i}") for i in range(len(marks))])
        # Rows without a key meet nothing; the second join key keeps them from one task.
        one = one.withColumn("own_deal", F.when(F.col("key").isNull(), F.col("row")).otherwise(0))
        one = one.join(said, (F.col("key") == F.col("id")) & (F.col("own_deal") == F.col("deal")), "left")
    out = [F.sum("n").alias("n")]
    for i, m in enumerate(marks):
        has = F.col(f"m{i}") if labels is not None else F.lit(False)
        out.append(F.sum(F.when(has, F.col("n")).otherwise(0)).alias(m))
    return one.groupBy("part", "bits").agg(*out)


def audit_orders(counts: DataFrame, letters: str, marks: tuple[str, ...] = ()) -> DataFrame:
    """One row for each part, order of the filters and step, from ``failure_counts``.

    ``kept`` documents are left after the step, ``removed`` go in it,
    ``redundant`` fail its filter but went before, ``unique_fails`` fail it
    alone; ``<mark>_lost`` are the marked ones among the removed. ``shapley``
    is what the step's filter removes, summed over all orders: a document that
    fails k filters is removed by each of them in 1/k of the orders.
    """
    orders = ["".join(p) for p in permutations(letters)]
    every = math.factorial(len(letters))
    each = counts.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in orders])))
    each = each.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    place = [F.locate(x, F.col("filter_order")) for x in letters]
    own, before = F.lit(0), F.lit(0)
    for i, at in enumerate(place):
        own = own + F.when(at == F.col("step"), 1 << i).otherwise(0)
        before = before + F.when(at < F.col("step"), 1 << i).otherwise(0)
    each = each.withColumn("own", own).withColumn("before", before)
    fails, gone = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0

    def total(when, value=F.col("n")):
        return F.sum(F.when(when, value).otherwise(0)).cast("long")

    share = F.expr(f"n * {every} div greatest(bit_count(bits), 1)")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"),
        *[total(fails & ~gone, F.col(m)).alias(f"{m}_lost") for m in marks], total(fails, share).alias("shapley"))
