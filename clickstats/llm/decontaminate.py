"""Benchmark decontamination by SimHash windows, in DataFrame functions only.

A window of a document has as many words as a benchmark item. Windows and
items get a 64-bit SimHash of their word shingles, each occurrence weighing 1.
The fingerprints are cut into ``RADIUS + 1`` blocks: two that differ in at
most ``RADIUS`` bits agree in one block, so equi-joins on the blocks meet all
of them. What is met is verified by the exact weighted similarity, the sum of
the smaller over the sum of the larger shingle counts.

Fingerprints are made where they can matter. The shingles of all documents are
joined with those of the items; a window that does not hold as many shingles of
an item as the similarity takes cannot match that item, and no other window or
pair is left out. Only the documents that have such a window are read again for
it. ``RADIUS`` lies more than three standard deviations above the distance that a
similarity of 0.8 gives.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import fresh, text_column

WORDS = 5
PERCENT = 80
BITS = 64
RADIUS = 19
#: Items with so many shingles in all are broadcast; those of a larger benchmark are shuffled.
BROADCAST_SHINGLES = 200_000


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns that are computed once a row: a generator, which Catalyst does not copy into what reads them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; space and 0x09-0x0D part them."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column, n: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, in order, with repeats."""
    at = F.sequence(F.lit(0), n - width)
    return F.when(n >= width, F.transform(at, lambda i: F.xxhash64(*[words[i + j] for j in range(width)]))).otherwise(
        F.array().cast("array<long>"))


#: Four counters of 16 bits in a long: bits b, b + 16, b + 32 and b + 48 are counted in one pass.
_LANES = 0x0001000100010001
#: Most shingles that are counted before the counters are read.
_LANE_MOST = 32_000


def _bit_counts(shingles: Column, b: int) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"),
                       lambda a, h: a + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(_LANES)))


def simhash(shingles: Column) -> Column:
    """64-bit SimHash: bit b is set if more shingles have it than not.

    Beyond 32,000 shingles (a counter has 16 bits) each bit is counted by itself.
    """
    half = F.size(shingles)

    def packed(b):  # a long with bits b, b + 16, b + 32, b + 48 of the result, read from counters that are made once
        def read(count):
            out = F.lit(0).cast("long")
            for lane in range(4):
                n = F.shiftrightunsigned(count, 16 * lane).bitwiseAND(F.lit(0xFFFF).cast("long"))
                at = b + 16 * lane
                out = out.bitwiseOR(F.when(2 * n > half, F.lit(1 << at if at < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
            return out

        return F.transform(F.array(_bit_counts(shingles, b)), read)[0]

    def single(b):
        n = F.aggregate(shingles, F.lit(0), lambda a, h: a + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1)).cast("int"))
        return F.when(2 * n > half, F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))

    def joined(parts):
        return F.aggregate(F.array(*parts), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return F.when(half <= _LANE_MOST, joined([packed(b) for b in range(16)])).otherwise(joined([single(b) for b in range(BITS)]))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, bits) of the RADIUS + 1 blocks."""
    cuts = [BITS * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:])]


def _block(fp: Column, i: int) -> Column:
    first, bits = _blocks()[i]
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _similarity(a: Column, b: Column) -> tuple[Column, Column]:
    """(sum of smaller counts, sum of larger counts) of two shingle lists."""
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return common, F.size(a) + F.size(b) - common


def benchmark_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                      item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, start, similarity, row): for each document and item with a window at least ``percent`` similar, the best
    window (its first word, from 0; the first of several).

    Shingles have 5 words; an item with fewer words is one shingle, its windows too. A document with fewer words than the item
    is its own only window. Null, empty and blank texts match nothing, nor do items without words. Rows that share an id are
    told apart by ``row``, a hash of the text; equal rows give one result. Extra columns are not read.
    """
    spark = docs.sparkSession
    it = _once(items.select(F.col(item_key).alias("item_id"), text_column(item_text).alias("t")), iw=words_of(F.col("t")))
    it = it.select("item_id", "iw", F.size("iw").alias("m")).where("m > 0")
    widths = [r["w"] for r in it.select(F.least("m", F.lit(WORDS)).alias("w")).distinct().collect()]  # at most WORDS numbers
    d = docs.select(F.col(key).alias("doc_id"), text_column(text).alias("t"))
    d = d.select("doc_id", F.xxhash64("t").alias("row"), "t")
    parts = []
    for width in sorted(widths):
        mine = it.where(F.least("m", F.lit(WORDS)) == width)
        mine = _once(mine, ish=_shingles(F.col("iw"), F.col("m"), width)).drop("iw")
        mine = _once(mine, ifp=simhash(F.col("ish")))
        parts.append(_matches(d, mine, width, percent))
    if not parts:
        return spark.createDataFrame([], "doc_id long, item_id long, start int, similarity double, row long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    best = F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start")))
    got = found.groupBy("doc_id", "row", "item_id").agg(best.alias("b"))
    return got.select("doc_id", "item_id", F.col("b.start").alias("start"), F.col("b.similarity").alias("similarity"), "row")


def _each_shingle(d: DataFrame, width: int) -> DataFrame:
    """(doc_id, row, n, p, h): the shingles of all documents by position; a row carries no more of its document than that."""
    words = _once(d, words=words_of(F.col("t")))
    words = words.select("doc_id", "row", F.size("words").alias("n"), "words").where(F.col("n") >= width)
    runs = F.arrays_zip(*[F.slice("words", F.lit(j + 1), F.col("n") - (width - 1)).alias(f"w{j}") for j in range(width)])
    each = words.select("doc_id", "row", "n", F.posexplode(runs).alias("p", "s"))
    return each.select("doc_id", "row", "n", "p", F.xxhash64(*[F.col(f"s.w{j}") for j in range(width)]).alias("h"))


def _window_starts(at: Column, need: Column, span: Column, final: Column) -> Column:
    """Starts, 0 to ``final``, of the windows of ``span`` shingles that hold ``need`` or more of the sorted positions ``at``.

    Each start is listed once, at the first position in its window.
    """
    def around(i):
        low = F.greatest(F.lit(0), at[i + need - 1] - span + 1, F.coalesce(F.when(i > 0, at[i - 1]), F.lit(-1)) + 1)
        high = F.least(at[i], final)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(at) >= need, F.flatten(F.transform(F.sequence(F.lit(0), F.size(at) - need), around))).otherwise(
        F.array().cast("array<int>"))


def _matches(d: DataFrame, items: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, row, item_id, start, similarity) of all windows similar to an item."""
    flat = items.select("item_id", "m", F.explode(F.array_distinct("ish")).alias("ih"))
    small = flat.count() <= BROADCAST_SHINGLES

    def sized(df):
        return F.broadcast(df) if small else df

    hits = _each_shingle(d, width).join(sized(flat), F.col("h") == F.col("ih"))
    # A row with the id and text of another has the same shingles and windows: the positions are a set, and the best window is one.
    found = hits.groupBy("doc_id", "row", "n", "item_id", "m").agg(F.array_sort(F.collect_set("p")).alias("at"))
    theirs = F.col("m") - (width - 1)
    own = F.least("n", "m") - (width - 1)
    # common * 100 >= (own + theirs - common) * percent, and a window has no more shingles in common than it has hits.
    need = F.ceil((own + theirs) * percent / (100 + percent)).cast("int")
    final = F.greatest(F.lit(0), F.col("n") - F.col("m"))
    found = found.select("doc_id", "row", "item_id", own.alias("own"),
                         F.explode(_window_starts(F.col("at"), F.greatest(need, F.lit(1)), own, final)).alias("start"))
    mine = found.groupBy(F.col("doc_id").alias("k"), F.col("row").alias("r")).agg(F.collect_list(F.struct("item_id", "own", "start")).alias("windows"))
    texts = d.join(mine, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r")))
    texts = _once(texts.select("doc_id", "row", "windows", "t"), words=words_of(F.col("t"))).drop("t")
    texts = _once(texts, sh=_shingles(F.col("words"), F.size("words"), width)).drop("words")
    cut = F.transform("windows", lambda w: F.struct(w["item_id"].alias("item"), w["start"].alias("start"),
                                                    F.slice(F.col("sh"), w["start"] + 1, w["own"]).alias("sh")))
    win = _once(texts.select("doc_id", "row", F.inline(cut)), fp=simhash(F.col("sh")))
    blocks = range(RADIUS + 1)

    def dealt(df, fp, name):
        return df.select("*", F.posexplode(F.array(*[_block(F.col(fp), i) for i in blocks])).alias(f"{name}_b", f"{name}_v"))

    w, i = dealt(win, "fp", "w"), dealt(items.select("item_id", "ish", "ifp"), "ifp", "i")
    met = w.join(sized(i), (F.col("item") == F.col("item_id")) & (F.col("w_b") == F.col("i_b")) & (F.col("w_v") == F.col("i_v")))
    diff = F.col("fp").bitwiseXOR(F.col("ifp"))
    earlier = F.lit(False)  # an earlier block agrees too: this pair has been met there
    for b in blocks:
        earlier = earlier | ((F.lit(b) < F.col("w_b")) & (_block(diff, b) == 0))
    near = met.where((F.bit_count(diff) <= RADIUS) & ~earlier)
    both, either = _similarity(F.col("sh"), F.col("ish"))
    near = near.select("doc_id", "row", "item_id", "start", both.alias("both"), either.alias("either"))
    return near.where(F.col("both") * 100 >= F.col("either") * percent).select(
        "doc_id", "row", "item_id", "start", (F.col("both").cast("double") / F.col("either")).alias("similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark match; all columns, rows without an id too if their text is clean."""
    found = benchmark_matches(docs, items, key, text)
    k, r, mine = fresh(docs, "hit_id", "hit_row", "hit_own")
    bad = found.select(F.col("doc_id").alias(k), F.col("row").alias(r)).distinct()
    own = docs.withColumn(mine, F.xxhash64(text_column(text)))
    return own.join(bad, F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.col(mine) == F.col(r)), "left_anti").drop(mine)
