"""Rankings of a stream with allowed lateness, re-firing windows and a late side
output, in one streaming query (L1, L2, T2, T3).

Two chained ``transformWithState`` operators, both in append mode:

* ``WindowCounter``, keyed by (block of windows, bucket of keys). A map state
  holds the counts of each key in the block, as deltas at the windows where
  they change; a value state holds the ``n`` best keys of each window of the
  block within the bucket. A batch reads and writes the counts of the keys it
  touches and no others: counts only grow, so the new top ``n`` is among the old
  top ``n`` and the touched keys.
* ``WindowRanker``, keyed by block, merges the buckets' best keys the same way and
  emits each ranking.

A row is late when all its windows are closed at the watermark, which is the
largest event time of earlier batches minus ``delay``; late rows come out of the
same query, tagged. Spark's own filter for late rows does not apply, since the
operators' input carries epoch milliseconds and no event-time column. Event-time
timers close windows and remove their state.

The result is one tagged stream: ``kind`` is ``rank``, ``late`` or ``count``. ``write_stream``
with ``partition_by="kind"`` splits it into folders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, MapType, StructType, TimestampType

from clickstats.functions.timecols import floor_div
from clickstats.operators.late import first_open_index
from clickstats.operators.rank import top_n
from clickstats.operators.windows import duration_ms, window_run
from clickstats.streaming.eventtime import keep_after_watermark, with_event_time

#: Groups of keys in a block of windows: the parallelism of the counts at one time. Fixed for the life of a checkpoint.
BUCKETS = 32
#: Keys whose counts are laid out at once.
_KEYS_AT_ONCE = 1000


def _best(win: np.ndarray, key: np.ndarray, count: np.ndarray, n: int):
    """Of entries (window, key, count) the ``n`` best keys of each window, each with its largest count, by window and rank."""
    names = pd.Series(key, dtype=object)
    codes = np.full(len(names), -1, np.int64)  # null first
    there = names.notna().to_numpy()
    if there.any():
        codes[there] = np.unique(names[there].to_numpy(), return_inverse=True)[1]
    order = np.lexsort((-count, codes, win))
    win, codes, count, key = win[order], codes[order], count[order], key[order]
    first = np.ones(len(win), bool)
    first[1:] = (win[1:] != win[:-1]) | (codes[1:] != codes[:-1])
    win, codes, count, key = win[first], codes[first], count[first], key[first]
    order = np.lexsort((codes, -count, win))
    win, count, key = win[order], count[order], key[order]
    starts = np.flatnonzero(np.concatenate([[True], win[1:] != win[:-1]])) if len(win) else np.zeros(0, int)
    place = np.arange(len(win)) - np.repeat(starts, np.diff(np.append(starts, len(win))))
    keep = place < n
    return win[keep], key[keep], count[keep], place[keep] + 1


def _entries(state) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, key, count) arrays of a value state that holds three lists."""
    win, key, count = state.get() if state.exists() else ([], [], [])
    return np.array(win, np.int64), _objects(key), np.array(count, np.int64)


def _objects(values) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = [v.item() if hasattr(v, "item") else v for v in values]
    return out


class _Windows:
    """Window arithmetic of the processors: indices (start / slide), blocks of ``width`` of them."""

    def __init__(self, size_ms: int, slide_ms: int, lateness_ms: int, retention_ms: int, n: int, emit: str, key: str, key_type: str,
                 write_counts: bool):
        self.size_ms, self.slide_ms, self.lateness_ms, self.retention_ms = size_ms, slide_ms, lateness_ms, retention_ms
        self.width = -(-size_ms // slide_ms)
        self.n, self.emit, self.key, self.key_type, self.write_counts = n, emit, key, key_type, write_counts

    def end(self, index):
        return index * self.slide_ms + self.size_ms

    def open_from(self, watermark: int, lateness_ms: int) -> int:
        """The first window that is open at a watermark."""
        return first_open_index(self.size_ms, self.slide_ms, lateness_ms, watermark)

    def closes_at(self, index: int) -> int:
        """The watermark at which a window's state may go."""
        return int(self.end(index)) - 1 + self.retention_ms


class WindowCounter(StatefulProcessor):
    """Counts of a bucket of keys in a block of windows; see the module."""

    def __init__(self, windows: _Windows):
        self.w = windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = self.w.key_type
        self.counts = handle.getMapState("counts", f"key {kind}", "at array<int>, delta array<bigint>")
        self.tops = handle.getValueState("tops", f"win array<bigint>, keys array<{kind}>, counts array<bigint>")

    def _out(self, kind, block, bucket, win=(), key=(), count=(), payload=None):
        m = len(win) if payload is None else len(payload)
        return pd.DataFrame({"kind": np.full(m, kind, object), "block": np.full(m, block, np.int64),
                             "lane": np.full(m, 0 if kind == "rank" else bucket + 1, np.int64),
                             "win": np.zeros(m, np.int64) if payload is not None else np.asarray(win, np.int64),
                             "key": _objects([None] * m if payload is not None else list(key)),
                             "count": np.zeros(m, np.int64) if payload is not None else np.asarray(count, np.int64),
                             "payload": _objects([None] * m) if payload is None else payload})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        w, (block, bucket) = self.w, (int(key[0]), int(key[1]))
        base = block * w.width
        opened = w.open_from(timerValues.getCurrentWatermarkInMs(), w.lateness_ms)
        parts = []
        for part in rows:
            late = part["payload"].notna() & (part["hi"] < opened)
            if late.any():
                yield self._out("late", block, bucket, payload=_payloads(part.loc[late, "payload"]))
            lo, hi = np.maximum(part["lo"].to_numpy(np.int64), opened), part["hi"].to_numpy(np.int64)
            ok = lo <= hi
            if ok.any():
                parts.append(pd.DataFrame({"key": part["key"].to_numpy()[ok], "lo": lo[ok] - base, "hi": hi[ok] - base + 1})
                             .groupby(["key", "lo", "hi"], dropna=False, sort=False).size())
        if not parts:
            return
        runs = pd.concat(parts).rename("c").reset_index()
        touched, entries = np.zeros(w.width + 1, np.int64), []
        for names in _chunks(runs, _KEYS_AT_ONCE):
            for name, mine in names:
                name = None if pd.isna(name) else name.item() if hasattr(name, "item") else name
                delta, fresh = np.zeros(w.width + 1, np.int64), np.zeros(w.width + 1, np.int64)
                if self.counts.containsKey((name,)):
                    at, value = self.counts.getValue((name,))
                    delta[np.array(at, np.int64)] = value
                lo, hi, c = (mine[x].to_numpy() for x in ("lo", "hi", "c"))
                np.add.at(delta, lo, c)
                np.add.at(delta, hi, -c)
                np.add.at(fresh, lo, 1)
                np.add.at(fresh, hi, -1)
                at = np.flatnonzero(delta)
                self.counts.updateValue((name,), (at.tolist(), delta[at].tolist()))
                touched += fresh
                where = np.flatnonzero(np.cumsum(fresh)[:-1] > 0)
                total = np.cumsum(delta)
                entries.append((where + base, _objects([name] * len(where)), total[where]))
            entries = [self._merged(entries)]
        old = _entries(self.tops)
        win, keys, counts, _ = _best(*(np.concatenate([a, b]) for a, b in zip(old, entries[0])), w.n)
        self.tops.update((win.tolist(), list(keys), counts.tolist()))
        at = np.flatnonzero(np.cumsum(touched)[:-1] > 0) + base
        if w.emit == "update":
            mine = np.isin(win, at)
            yield self._out("rank", block, bucket, win[mine], keys[mine], counts[mine])
            self.handle.registerTimer(w.closes_at(base + w.width - 1))
        else:
            self.handle.registerTimer(w.closes_at(int(win.min())))

    def _merged(self, entries):
        win, key, count = (np.concatenate(x) for x in zip(*entries))
        return _best(win, key, count, self.w.n)[:3]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w, (block, bucket) = self.w, (int(key[0]), int(key[1]))
        opened = w.open_from(timerValues.getCurrentWatermarkInMs(), w.retention_ms)
        if w.emit == "final":
            win, keys, counts = _entries(self.tops)
            gone = win < opened
            if gone.any():
                yield self._out("rank", block, bucket, win[gone], keys[gone], counts[gone])
                self.tops.update((win[~gone].tolist(), list(keys[~gone]), counts[~gone].tolist()))
            if (~gone).any():
                self.handle.registerTimer(w.closes_at(int(win[~gone].min())))
                return
        if opened >= (block + 1) * w.width:
            if w.write_counts:
                for (name,), (at, value) in self.counts.iterator():
                    delta = np.zeros(w.width + 1, np.int64)
                    delta[np.array(at, np.int64)] = value
                    total = np.cumsum(delta)[:-1]
                    where = np.flatnonzero(total)
                    yield self._out("count", block, bucket, where + block * w.width, [name] * len(where), total[where])
            self.counts.clear()
            self.tops.clear()
        elif w.emit == "final":  # nothing is ranked any more in this block, but rows may still come
            self.handle.registerTimer(w.closes_at((block + 1) * w.width - 1))

    def close(self) -> None:
        pass


def _payloads(values) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = [list(v) for v in values]
    return out


def _chunks(runs: pd.DataFrame, size: int):
    """Lists of at most ``size`` (key, its runs)."""
    some = []
    for item in runs.groupby("key", dropna=False, sort=False):
        some.append(item)
        if len(some) == size:
            yield some
            some = []
    if some:
        yield some


class WindowRanker(StatefulProcessor):
    """The best keys of each window over all buckets of a block; other rows pass through."""

    def __init__(self, windows: _Windows):
        self.w = windows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = self.w.key_type
        self.tops = handle.getValueState("tops", f"win array<bigint>, keys array<{kind}>, counts array<bigint>")
        self.fired = handle.getValueState("fired", "times bigint")

    def _out(self, kind, win, key, count, rank, version, payload):
        w = self.w
        return pd.DataFrame({"kind": kind, "window_end": w.end(np.asarray(win, np.int64)), "key": key, "count": np.asarray(count, np.int64),
                             "rank": np.asarray(rank, np.int32), "version": np.full(len(win), version, np.int64), "payload": payload})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        w, block = self.w, int(key[0])
        parts = []
        for part in rows:
            if int(key[1]):
                m = len(part)
                yield self._out(part["kind"].to_numpy(), part["win"], part["key"].to_numpy(), part["count"], np.zeros(m), 0,
                                _objects([None if v is None else list(v) for v in part["payload"]]))
            else:
                parts.append((part["win"].to_numpy(np.int64), _objects(part["key"].to_list()), part["count"].to_numpy(np.int64)))
        if not parts:
            return
        win, keys, counts = (np.concatenate(x) for x in zip(*parts))
        at = np.unique(win)
        times = (self.fired.get()[0] if self.fired.exists() else 0) + 1
        self.fired.update((times,))
        if w.emit == "update":
            win, keys, counts = (np.concatenate([a, b]) for a, b in zip(_entries(self.tops), (win, keys, counts)))
        win, keys, counts, rank = _best(win, keys, counts, w.n)
        if w.emit == "update":
            self.tops.update((win.tolist(), list(keys), counts.tolist()))
        mine = np.isin(win, at)
        yield self._out(np.full(int(mine.sum()), "rank", object), win[mine], keys[mine], counts[mine], rank[mine], times,
                        _objects([None] * int(mine.sum())))
        self.handle.registerTimer(w.closes_at((block + 1) * w.width - 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.tops.clear()
        if self.w.emit == "update" or self.w.open_from(timerValues.getCurrentWatermarkInMs(), self.w.retention_ms) >= (int(key[0]) + 1) * self.w.width:
            self.fired.clear()
        return iter([])

    def close(self) -> None:
        pass


def _as_text(name: str, kind) -> Column:
    if isinstance(kind, (ArrayType, MapType, StructType)):
        raise ValueError(f"column {name}: late rows may only have plain columns")
    c = F.col(f"`{name}`")
    return (F.unix_micros(c) if isinstance(kind, TimestampType) else c).cast("string")


def _from_text(text: Column, field) -> Column:
    kind = field.dataType
    value = F.timestamp_micros(text.cast("bigint")) if isinstance(kind, TimestampType) else text.cast(kind)
    return value.alias(field.name)


def ranked_stream(rows: DataFrame, key: str, size: str, slide: str, delay: str = "0 seconds", lateness: str = "0 seconds",
                  keep: Column | None = None, n: int = 5, emit: str = "update", retention: str | None = None,
                  count_col: str = "count", buckets: int = BUCKETS, write_counts: bool = False, late: bool = True) -> DataFrame:
    """Rankings and late rows of a stream: ``kind, window_end, <key>, <count>, rank, version, row``.

    ``rows`` need ``event_time`` (timestamp), ``event_ms`` and ``key``. ``keep`` is the job's filter, applied after the
    watermark is taken from all rows. Any size and slide; nothing is expanded per window.

    * ``kind = 'rank'``: the top ``n`` of a window over all its keys. ``emit="update"``: after each batch that touches the
      window, ``version`` growing from one to the next; ``"final"``: once, when the window closes.
    * ``kind = 'late'``: ``row`` is a row too late for all its windows, with all columns (``late=False``: left out).
    * ``kind = 'count'``, with ``write_counts``: all counts of a block of windows, when its last window closes.

    A window takes rows while ``end - 1 + lateness > watermark`` and is closed, its state removed, when ``end - 1 +
    retention <= watermark`` (``retention`` is at least ``lateness``). Event times before the epoch are not supported: Spark
    starts with watermark 0. A key that holds a large share of a batch is counted in the one task of its bucket and block.
    """
    if emit not in ("update", "final"):
        raise ValueError("emit must be 'update' or 'final'")
    size_ms, slide_ms, lateness_ms = duration_ms(size), duration_ms(slide), duration_ms(lateness)
    if not 0 < slide_ms <= size_ms:
        raise ValueError("need 0 < slide <= size")
    provider = rows.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass")
    if "RocksDB" not in provider:
        raise ValueError(f"transformWithState needs the RocksDB state store provider, the session has {provider}")
    retention_ms = max(duration_ms(retention) if retention else 0, lateness_ms)
    field = rows.schema[key]
    w = _Windows(size_ms, slide_ms, lateness_ms, retention_ms, n, emit, key, field.dataType.simpleString(), write_counts)

    timed = with_event_time(rows, f"{duration_ms(delay)} milliseconds")
    if keep is not None:
        timed = keep_after_watermark(timed, keep)
    first, last = window_run(size_ms, slide_ms)
    payload = F.array(*[_as_text(f.name, f.dataType) for f in rows.schema]) if late else F.lit(None).cast("array<string>")
    dealt = timed.select(F.col(f"`{key}`").alias("key"), first.alias("first"), last.alias("last"), payload.alias("payload"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(floor_div(F.col("first"), w.width), floor_div(F.col("last"), w.width))))
    begin = F.col("block") * w.width
    dealt = dealt.select("key", "block", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"),
                         F.greatest("first", begin).alias("lo"), F.least("last", begin + w.width - 1).alias("hi"),
                         F.when(F.col("last") < begin + w.width, F.col("payload")).alias("payload"))
    kind = w.key_type
    counted = dealt.groupBy("block", "bucket").transformWithStateInPandas(
        WindowCounter(w), f"kind string, block bigint, lane bigint, win bigint, key {kind}, count bigint, payload array<string>", "Append", "EventTime")
    ranked = counted.groupBy("block", "lane").transformWithStateInPandas(
        WindowRanker(w), f"kind string, window_end bigint, key {kind}, count bigint, rank int, version bigint, payload array<string>", "Append",
        "EventTime")
    row = F.struct(*[_from_text(F.col("payload")[i], f) for i, f in enumerate(rows.schema)])
    is_late = F.col("kind") == "late"
    return ranked.select("kind", F.when(~is_late, F.col("window_end")).alias("window_end"), F.col("key").alias(key),
                         F.when(~is_late, F.col("count")).alias(count_col), F.when(F.col("kind") == "rank", F.col("rank")).alias("rank"),
                         F.when(F.col("kind") == "rank", F.col("version")).alias("version"), F.when(is_late, row).alias("row"))


# --- results -------------------------------------------------------------------

#: Operators are numbered from the end of the plan: the ranker is 0, the counter 1.
_COUNTER = "1"


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("operatorId", _COUNTER).option("stateVarName", variable).load(checkpoint)


def emitted(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """The rows of one kind that a query has written so far."""
    return spark.read.parquet(out_dir).where(F.col("kind") == kind).drop("kind")


def late_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The side output: rows too late for all their windows."""
    return emitted(spark, out_dir, "late").select("row.*")


def latest_rankings(spark: SparkSession, out_dir: str) -> DataFrame:
    """The last ranking of each window (the one after its last re-firing): ``window_end, <key>, <count>, rank``, with the
    windows that ``close_bounded`` has ranked, unless the query has ranked them since."""
    ranks = emitted(spark, out_dir, "rank").drop("row")
    last = ranks.groupBy("window_end").agg(F.max("version").alias("version"))
    latest = ranks.join(last, ["window_end", "version"], "left_semi").drop("version")
    try:
        closed = spark.read.parquet(f"{out_dir}{_CLOSED}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return latest
    return latest.unionByName(closed.join(last, "window_end", "left_anti"))


#: Suffix of the folder of windows ranked at the end of a bounded source.
_CLOSED = "-closed"


def open_rankings(spark: SparkSession, checkpoint: str, key: str, size: str, slide: str, n: int = 5, count_col: str = "count") -> DataFrame:
    """The top ``n`` of every window that a stopped query still holds as state, read by Spark's state reader:
    ``window_end, <key>, <count>, rank``. ``n`` is at most the query's."""
    each = _state(spark, checkpoint, "tops").select(F.inline(F.arrays_zip("value.win", "value.keys", "value.counts")))
    end = F.col("win") * duration_ms(slide) + duration_ms(size)
    return top_n(each.select(end.alias("window_end"), F.col("keys").alias(key), F.col("counts").alias(count_col)), key, n, count_col=count_col)


def close_bounded(spark: SparkSession, checkpoint: str, out_dir: str, key: str, size: str, slide: str, n: int = 5,
                  count_col: str = "count") -> DataFrame:
    """Rank the windows still open when a bounded source has ended, as the end of a file closes them in a batch job.

    For ``emit="final"``, after an ``availableNow`` run. They are written beside ``out_dir`` and found by
    ``latest_rankings``; a later run of the same query goes on from its state and ranks them again when they close.
    """
    open_rankings(spark, checkpoint, key, size, slide, n, count_col).write.mode("overwrite").parquet(f"{out_dir}{_CLOSED}")
    return latest_rankings(spark, out_dir)


def open_counts(spark: SparkSession, checkpoint: str, key: str, size: str, slide: str, count_col: str = "count") -> DataFrame:
    """Counts of the windows that a stopped query still holds as state: ``<key>, window_end, <count>``. The state of a block
    of windows (one window length) goes when its last window closes."""
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    width = -(-size_ms // slide_ms)
    each = _state(spark, checkpoint, "counts").select(
        F.col("key.block").alias("block"), F.col("user_map_key.key").alias(key), F.inline(F.arrays_zip("user_map_value.at", "user_map_value.delta")))
    over = Window.partitionBy(key, "block").orderBy("at")
    runs = each.select(key, "block", "at", F.sum("delta").over(over.rowsBetween(Window.unboundedPreceding, 0)).alias(count_col),
                       F.coalesce(F.lead("at").over(over), F.lit(width)).alias("upto"))
    first = F.col("block") * width
    windows = F.explode(F.sequence(first + F.col("at"), first + F.col("upto") - 1))
    return runs.where((F.col(count_col) > 0) & (F.col("at") < F.col("upto"))).select(
        key, windows.alias("window_end"), count_col).withColumn("window_end", F.col("window_end") * slide_ms + size_ms)


def final_counts(spark: SparkSession, checkpoint: str, out_dir: str, key: str, size: str, slide: str, count_col: str = "count") -> DataFrame:
    """Count of every window so far, with ``write_counts``: of the closed blocks, and of those still held as state."""
    closed = emitted(spark, out_dir, "count").select(key, "window_end", count_col)
    return closed.unionByName(open_counts(spark, checkpoint, key, size, slide, count_col))
