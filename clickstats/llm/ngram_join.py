"""N-gram Jaccard join by T-occurrence search.

Two texts link when their sets of word shingles have a Jaccard similarity of
at least ``PERCENT`` / 100, that is an overlap of at least T shingles, where T
follows from the two set sizes. The search keeps an inverted list per shingle.

1. One scan makes a class of each different set and counts shingles in a table
   of fixed size; the counts only order shingles from rare to frequent, so
   their bucketing cannot lose a link.
2. A set and another that reaches T share one of each other's rarest
   ``n - ceil(0.8 n) + 1`` shingles: the short lists. These are shuffled by
   shingle. Members of a list that can still reach T by size and position meet
   in a group.
3. In a group, DivideSkip: the lists of a query are divided; the short ones are
   merged, and sets that occur there often enough are looked up in the long
   ones by binary search. Sets that are linked already are skipped, so a group
   of thousands of near copies costs little more than its size.
4. A group of more than ``BLOCK_SHINGLES`` is dealt out to blocks by hash. Sets
   that did not join the hub's component within their block are then searched
   against every other block.
5. Links make components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstats.llm import blobs, textops
from clickstats.llm.components import connected_components
from clickstats.llm.tables import cut, fresh, shuffle_partitions, text_column

WORDS = 5
PERCENT = 80
#: Entries of the frequency table. Its size is fixed; more entries order shingles better.
FREQUENCY_BUCKETS = 1 << 20
_CHUNK = 1 << 12
#: Lists up to this length give their pairs directly; a longer one forms a group around a hub.
PAIR_LIST = 48
#: Shingles of one block of a group (8 bytes each).
BLOCK_SHINGLES = 1 << 20
STEP_BYTES = 1 << 21
#: Weight of merging against probing in DivideSkip.
MU = 0.01

_COUNT = np.dtype([("c", "<u4")])
#: A list's key is shorter than a shingle's hash: lists that fall together only give candidates that verification drops.
_POSTING = np.dtype([("key", "<u8"), ("cls", "<u8"), ("n", "<u4"), ("pos", "<u4")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS):
    """(index, sorted distinct shingle hashes) of each text that has a word."""
    data = textops.lower_ascii(data)
    starts, ends, first = textops.word_spans(data, offsets)
    h = textops.span_hashes(data, starts, ends)
    grams = textops.gram_hashes(h, words)
    for i in range(len(offsets) - 1):
        a, z = first[i], first[i + 1]
        if z - a >= words:
            yield i, np.unique(grams[a:z - words + 1])
        elif z > a:
            yield i, textops.gram_hashes(h[a:z], z - a)


def _class_of(s: np.ndarray) -> int:
    """A hash of a set; sets that differ share one with a chance of about 2**-64 per pair."""
    m = textops.mix(s + np.uint64(0x5851F42D4C957F2D))
    return int(textops.mix(np.array([m.sum(dtype=np.uint64) ^ np.uint64(len(s))], np.uint64))[0])


def _each_set(batches, text_at: int):
    """(batch, row, set) of every row with a word, in steps of bounded size."""
    for b in batches:
        data, off = textops.column_buffer(b.column(text_at))
        for i, z in textops.steps(off, STEP_BYTES):
            for k, s in shingle_sets(data[off[i]:off[z]], off[i:z + 1] - off[i]):
                yield b, i + k, s


def _scan_classes(texts: DataFrame) -> DataFrame:
    """(doc_id, row, n, cls) of every row, and the partial frequency counts of every task in rows with a chunk."""
    schema = "doc_id long, row long, n long, cls long, chunk int, counts binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()),
                       ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(FREQUENCY_BUCKETS, np.int64)
        for b in batches:
            n, cls, held, size = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.uint64), [], 0
            for _, i, s in _each_set([b], 1):
                n[i], cls[i] = len(s), _class_of(s)
                held.append((s & np.uint64(FREQUENCY_BUCKETS - 1)).astype(np.int64))
                size += len(s)
                if size > 1 << 20:
                    counts += np.bincount(np.concatenate(held), minlength=FREQUENCY_BUCKETS)
                    held, size = [], 0
            if held:
                counts += np.bincount(np.concatenate(held), minlength=FREQUENCY_BUCKETS)
            none = pa.nulls(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(cls.view(np.int64)),
                                              none.cast(pa.int32()), none.cast(pa.binary())], schema=arrow)
        parts = counts.astype(_COUNT).reshape(-1, _CHUNK)  # a task reads fewer than 2**32 shingles
        none = pa.nulls(len(parts)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(np.arange(len(parts)), pa.int32()),
                                          pa.array([blobs.squeeze(blobs.encode(p)) for p in parts], pa.binary())], schema=arrow)

    return texts.mapInArrow(run, schema)


def _frequencies(counts: DataFrame) -> np.ndarray:
    """The summed frequency table: FREQUENCY_BUCKETS numbers, whatever the corpus."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(1)):
                part = blobs.unpack(raw.as_py(), _COUNT)["c"].astype(np.int64)
                total[chunk] = total[chunk] + part if chunk in total else part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["chunk", "counts"])

    out = np.zeros(FREQUENCY_BUCKETS, np.int64)
    parts = min(shuffle_partitions(counts.sparkSession), FREQUENCY_BUCKETS // _CHUNK)
    for r in counts.repartition(parts, "chunk").mapInArrow(run, "chunk int, counts binary").collect():
        out[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def _short_postings(texts: DataFrame, frequency: np.ndarray) -> DataFrame:
    """Packed postings of the short lists of every class, once per task and class."""
    spark = texts.sparkSession
    buckets = blobs.bucket_count(spark)
    shared = spark.sparkContext.broadcast(np.minimum(frequency, np.iinfo(np.uint32).max).astype(np.uint32))

    def run(batches):
        table = shared.value
        seen: set[int] = set()
        held, size = [], 0

        def flush():
            r = np.concatenate(held)
            return blobs.to_batch(blobs.pack(r, blobs.bucket_of(r["key"])))

        for _, _, s in _each_set(batches, 1):
            c = _class_of(s)
            if c in seen:
                continue
            seen.add(c)
            n = len(s)
            m = n + (-PERCENT * n // 100) + 1  # n - ceil(0.8 n) + 1
            order = np.argsort(table[(s & np.uint64(FREQUENCY_BUCKETS - 1)).astype(np.int64)], kind="stable")[:m]
            r = np.empty(m, _POSTING)
            r["key"], r["cls"], r["n"], r["pos"] = blobs.short_keys(s[order], buckets), c, n, np.arange(m)
            held.append(r)
            size += m
            if size > 1 << 20:
                yield flush()
                held, size = [], 0
                if len(seen) > 1 << 20:
                    seen.clear()
        if held:
            yield flush()

    return texts.mapInArrow(run, blobs.SCHEMA)


def _meetings(r: np.ndarray) -> np.ndarray:
    """(hub, member, n) rows from the postings of a bucket: every pair that may link has a hub in common."""
    order = np.lexsort((r["cls"], r["n"], r["key"]))
    r = r[order]
    keep = np.r_[True, (r["key"][1:] != r["key"][:-1]) | (r["cls"][1:] != r["cls"][:-1])]
    r = r[keep]
    start = np.flatnonzero(np.r_[True, r["key"][1:] != r["key"][:-1]])
    length = np.diff(np.r_[start, len(r)])
    many = np.repeat(length, length) > 1
    r, length = r[many], length[length > 1]
    if not len(r):
        return np.zeros((0, 3), np.uint64)
    where = np.repeat(length, length)
    left = np.arange(len(r)) - np.repeat(np.r_[0, np.cumsum(length)[:-1]], length)
    after = where - left - 1  # entries of the list that follow
    n, pos = r["n"].astype(np.int64), r["pos"].astype(np.int64)
    hubs, members = [], []
    small = where <= PAIR_LIST
    at = np.flatnonzero(small)
    for d in range(1, PAIR_LIST):
        at = at[after[at] >= d]
        if not len(at):
            break
        x, y = at, at + d
        need = -(-PERCENT * (n[x] + n[y]) // (100 + PERCENT))
        ok = (100 * n[x] >= PERCENT * n[y]) & (1 + np.minimum(n[x] - pos[x] - 1, n[y] - pos[y] - 1) >= need)
        hubs += [x[ok], x[ok]]
        members += [x[ok], y[ok]]
        at = at[100 * n[x] >= PERCENT * n[y]]  # sorted by size: later ones are larger still
    long = np.flatnonzero(~small)
    if len(long):
        # Bands of sizes: sizes that can link lie in one band or in neighbouring ones.
        band = np.floor(np.log(n[long]) / np.log(100 / PERCENT)).astype(np.int64)
        lst = np.cumsum(np.r_[True, r["key"][long][1:] != r["key"][long][:-1]])
        for shift in (0, 1):  # with the own band's hub, and with the lower band's
            want = band - shift
            code, own = lst * 4096 + want, lst * 4096 + band
            first = np.searchsorted(own, code)
            ok = (first < len(own)) & (own[np.minimum(first, len(own) - 1)] == code)
            hubs.append(long[first[ok]])
            members.append(long[ok])
    h, m = np.concatenate(hubs), np.concatenate(members)
    rows = np.stack([r["cls"][h], r["cls"][m], r["n"][m].astype(np.uint64)], 1)
    return np.unique(rows, axis=0)


def _groups(postings: DataFrame) -> DataFrame:
    """(hub, cls, n), distinct."""

    def run(batches):
        for _, held in blobs.each_bucket(batches):
            rows = _meetings(np.concatenate([blobs.unpack(x, _POSTING) for x in held]))
            if len(rows):
                hub, cls, n = (np.ascontiguousarray(rows[:, k]).view(np.int64) for k in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(hub), pa.array(cls), pa.array(n)], names=["hub", "cls", "n"])

    return blobs.by_bucket(postings).mapInArrow(run, "hub long, cls long, n long").distinct()


def divide_skip_links(sets: list[np.ndarray], asks: list[bool] | None = None, known: list[int] | None = None,
                      percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join every pair of ``sets`` reaching the similarity, without those that change no component.

    ``sets`` are sorted distinct hashes. A pair is searched if either side
    ``asks`` (default: all). ``known``: component numbers to start from.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    by_size = np.argsort(size, kind="stable")
    size = size[by_size]
    ask = np.ones(m, bool) if asks is None else np.asarray(asks, bool)[by_size]
    offs = np.r_[0, np.cumsum(size)]
    uniq, ids = np.unique(np.concatenate([sets[i] for i in by_size]), return_inverse=True)
    df = np.bincount(ids, minlength=len(uniq))
    at = np.r_[0, np.cumsum(df)]
    lists = np.repeat(np.arange(m), size)[np.argsort(ids, kind="stable")]  # per shingle the sets that hold it, ascending
    parent = np.arange(m)
    if known is not None:
        seen: dict[int, int] = {}
        for j, i in enumerate(by_size):
            parent[j] = seen.setdefault(known[i], j)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for x in range(m - 1):
        own = ids[offs[x]:offs[x + 1]]
        own = own[df[own] > 1]
        need = int(-(-2 * percent * size[x] // (100 + percent)))  # the least overlap with a set of the same size or larger
        if len(own) < need:
            continue
        dfs = df[own]
        n_long = min(need - 1, int(need / (MU * np.log2(max(2, dfs.max())) + 1)))
        cut_at = np.argsort(-dfs, kind="stable")
        long, short = own[cut_at[:n_long]], own[cut_at[n_long:]]
        merged = np.concatenate([lists[at[i]:at[i + 1]] for i in short]) if len(short) else np.zeros(0, np.int64)
        cand, count = np.unique(merged[merged > x], return_counts=True)
        ok = (count >= need - n_long) & (100 * size[x] >= percent * size[cand])
        if not ask[x]:
            ok &= ask[cand]
        for y, c in zip(cand[ok], count[ok]):
            rx, ry = find(x), find(y)
            if rx == ry:
                continue
            theirs = ids[offs[y]:offs[y + 1]]
            spot = np.minimum(np.searchsorted(theirs, long), len(theirs) - 1)
            overlap = int(c) + int((theirs[spot] == long).sum())
            if (100 + percent) * overlap >= percent * (size[x] + size[y]):
                parent[max(rx, ry)] = min(rx, ry)
                links.append((int(by_size[x]), int(by_size[y])))
    return links


def _sets_of(texts: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cls, asks, comp, shingles) from ``wanted``: the same without the set, with the doc_id and row of a text that has it."""
    w = wanted.select(F.col("doc_id").alias("want_id"), F.col("row").alias("want_row"), *keys, "cls", "asks", "comp")
    same = F.col("doc_id").eqNullSafe(F.col("want_id")) & (F.col("row") == F.col("want_row"))
    rows = texts.join(w, same).select(*keys, "cls", "asks", "comp", "text")
    n = len(keys)
    schema = ", ".join(f"{k} {'long' if k == 'grp' else 'int'}" for k in keys) + ", cls long, asks boolean, comp long, shingles binary"

    def run(batches):
        for b in batches:
            want = b.column(n).to_numpy().view(np.uint64)
            at, raw = [], []
            for _, i, s in _each_set([b], n + 3):
                if _class_of(s) == int(want[i]):  # rows may share id and text hash and differ in text
                    at.append(i)
                    raw.append(s.tobytes())
            kept = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:n + 3], pa.array(raw, pa.binary())],
                                             names=[*keys, "cls", "asks", "comp", "shingles"])

    return rows.mapInArrow(run, schema)


def _search_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stars (a, b) from rows of (keys, cls, asks, comp, shingles), one DivideSkip search per value of the keys: ``b`` is the
    smallest class of the component that ``a`` has within the group."""
    n_keys = len(keys)
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys, "cls")

    def search(group):
        cls = [g[0] for g in group]
        first = [i for i in range(len(cls)) if i == 0 or cls[i] != cls[i - 1]]  # copies of a set count once
        got = divide_skip_links([np.frombuffer(group[i][3], np.uint64) for i in first], [group[i][1] for i in first],
                                [group[i][2] for i in first])
        low = {cls[i]: cls[i] for i in first}

        def find(x):
            while low[x] != x:
                low[x] = low[low[x]]
                x = low[x]
            return x

        for a, b in got:
            x, y = find(cls[first[a]]), find(cls[first[b]])
            low[max(x, y)] = min(x, y)
        return [(x, find(x)) for x in low if find(x) != x]

    def run(batches):
        now, group, out = None, [], []
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[:n_keys + 3]]
            for i in range(b.num_rows):
                key = tuple(c[i] for c in cols[:n_keys])
                if key != now:
                    if len(group) > 1:
                        out += search(group)
                    now, group = key, []
                if group and group[-1][0] == cols[n_keys][i]:  # copies of a set count once
                    continue
                group.append((cols[n_keys][i], cols[n_keys + 1][i], cols[n_keys + 2][i], b.column(n_keys + 3)[i].as_py()))
        if len(group) > 1:
            out += search(group)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                                         names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, row) of every row of ``docs``.

    ``n_shingles``: distinct 5-word shingles of the lower-cased text; a shorter
    text's whole word sequence is its only shingle; null, empty and blank texts
    have none and link with nothing. ``component_id``: the smallest id reachable
    by links, the own included; null ids are passed over in that minimum, and
    a null stands where a row without a set has no id, or a component none.
    Rows that repeat an id are rows of their own; ``row`` is a hash of the text. An empty table gives an empty
    result. Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), text_column(text).alias("text"),
                        F.xxhash64(text_column(text)).alias("row"))
    scanned = cut(_scan_classes(texts))
    rows = scanned.where(F.col("chunk").isNull()).select("doc_id", "row", "n", "cls")
    frequency = _frequencies(scanned.where(F.col("chunk").isNotNull()).select("chunk", "counts"))
    # One text of each class: that with the smallest id, ids before none.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    classes = cut(rows.where("n > 0").groupBy("cls").agg(first).select("cls", "first.doc_id", "first.row"))

    groups = cut(_groups(_short_postings(texts, frequency)))
    # Candidates that hang together form one group while that fits into a block, so that each set is sent once.
    tied = cut(connected_components(groups.select(F.col("hub").alias("a"), F.col("cls").alias("b"))))
    placed = groups.select("cls", "n").distinct().join(tied, F.col("cls") == F.col("node")).select("cls", "n", "root")
    total = placed.groupBy("root").agg(F.sum("n").alias("total"))
    small = total.where(F.col("total") <= BLOCK_SHINGLES).select(F.col("root").alias("r"))
    whole = placed.join(small, F.col("root") == F.col("r")).select(F.col("root").alias("grp"), "cls", "n", F.lit(1).alias("blocks"),
                                                                   F.lit(0).alias("block"))
    # What hangs together beyond that is searched hub by hub; a hub's group may still need several blocks.
    large = total.where(F.col("total") > BLOCK_SHINGLES).select(F.col("root").alias("r"))
    hubs = tied.join(large, F.col("root") == F.col("r")).select(F.col("node").alias("h"))
    by_hub = groups.join(hubs, F.col("hub") == F.col("h")).select(F.col("hub").alias("grp"), "cls", "n")
    sizes = by_hub.groupBy("grp").agg(F.sum("n").alias("total")).select(
        F.col("grp").alias("h"), F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = by_hub.join(sizes, F.col("grp") == F.col("h")).drop("h")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    # The hub is in every block of its group.
    block = F.when(F.col("cls") == F.col("grp"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = dealt.select("grp", "cls", "n", "blocks", F.explode(block).alias("block"))
    dealt = cut(whole.unionAll(dealt))

    def search(rows, keys):
        return _search_groups(_sets_of(texts, rows.join(classes, "cls"), keys), keys)

    first = dealt.withColumn("asks", F.lit(True)).withColumn("comp", F.col("cls"))
    links = cut(search(first, ["grp", "block"]))
    # A set of a whole group is nowhere else: its stars are components already. Groups around hubs overlap.
    overlap = by_hub.limit(1).count() > 0
    comps = cut(connected_components(links)) if overlap else links.select(F.col("a").alias("node"), F.col("b").alias("root"))

    split = dealt.where("blocks > 1")
    if overlap and split.limit(1).count():
        held = split.join(comps, F.col("cls") == F.col("node"), "left")
        held = held.withColumn("comp", F.coalesce("root", "cls")).drop("node", "root")
        held = held.join(comps.select(F.col("node").alias("h"), "root"), F.col("grp") == F.col("h"), "left")
        held = held.withColumn("asks", F.col("comp") != F.coalesce("root", "grp")).drop("h", "root")
        out = held.where("asks").groupBy("grp").agg(F.sum("n").alias("t")).select(
            F.col("grp").alias("h"), F.ceil(F.col("t") / BLOCK_SHINGLES).cast("int").alias("turns"))
        held = cut(held.join(out, F.col("grp") == F.col("h")).drop("h"))  # groups without such sets are done
        turn = F.pmod(F.xxhash64("cls", F.lit(1)), F.col("turns")).cast("int")
        every_turn, every_block = F.sequence(F.lit(0), F.col("turns") - 1), F.sequence(F.lit(0), F.col("blocks") - 1)
        asking = held.where("asks").select("grp", turn.alias("turn"), F.explode(every_block).alias("block"), "cls", "asks", "comp")
        # In every turn each block holds all its members, asking or not.
        others = held.select("grp", F.explode(every_turn).alias("turn"), "block", "cls", "asks", "comp")
        links = cut(links.unionAll(search(asking.unionAll(others).distinct(), ["grp", "turn", "block"])))
        comps = cut(connected_components(links))

    labelled = classes.join(comps, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    member = cut(labelled.select("cls", "root").join(lowest, "root").select(F.col("cls").alias("c"), "component_id"))
    return rows.join(member, (F.col("cls") == F.col("c")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "row")


def keep_one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` of which none links to another: of each component the row with the smallest id stays.

    Rows without a shingle stay. Rows that repeat both id and text are one document, of which one row stays. In a component
    without any id every different text stays.
    """
    found = cut(jaccard_components(docs, key, text))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("best")
    linked = found.where("n_shingles > 0")
    stay = linked.where(F.col("component_id").isNotNull()).groupBy("component_id").agg(best).select("best.doc_id", "best.row")
    lone = found.where("n_shingles = 0").select("doc_id", "row")
    nameless = linked.where(F.col("component_id").isNull()).select("doc_id", "row")
    i, r, mine = fresh(docs, "stay_id", "stay_row", "stay_own")
    stay = stay.unionAll(lone).unionAll(nameless).distinct().toDF(i, r)
    own = docs.withColumn(mine, F.xxhash64(text_column(text)))
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col(i)) & (F.col(mine) == F.col(r))
    return own.join(stay, same, "left_semi").dropDuplicates([key, mine]).drop(mine)
