"""Finding where documents repeat windows of earlier documents, at any scale.

A window is ``size`` consecutive units (words or bytes) of one text. It is
repeated if the same units also start somewhere in a document with a smaller
id. Shuffling every window would move many times the corpus, so:

1. Every window is given a key, the smallest hash of the short grams inside it.
   Equal windows have equal keys, and neighbouring windows mostly share theirs;
   a run of windows with one key is a zone. One shuffle of (key, document)
   finds the keys that two documents share. Where a gram is so short that it
   recurs by chance, prints of the units on both sides of it go along: equal
   windows share the gram and at least one whole side.
2. A task settles the equal zones it has of shared keys: whoever has not the
   smallest id is covered. The others send their piece of text to the bucket of
   their key. Equal pieces are settled there too, and a matcher (an automaton or
   a suffix array) finds which windows of the different pieces are equal.
3. Zones of hot keys, which a large share of documents may have, are taken as
   single windows, spread by content. Their hashes are sent first; windows whose
   hash another document has send their text to the matcher of their bucket.
4. Covered ranges go back to their document.

Hashes only choose what is compared; that windows are equal is always decided on
their words or bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstats.llm import blobs, textops
from clickstats.llm.tables import text_column

STEP_BYTES = 1 << 20
FLUSH = 1 << 20
#: A zone is split after so many windows, whatever it repeats.
ZONE_WINDOWS = 64
#: A key is hot when so many documents of one task's flush, or of a bucket, have it. Hot and other keys are matched
#: exactly alike; a hot key's windows are only routed one by one. With prints, the documents must share a side too; without
#: a common side it takes HOT_KEY times as many of a flush.
HOT_IN_FLUSH = 64
HOT_IN_BUCKET = 4096
HOT_KEY = 16

_ZONE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("row", "<u8")])
_PRINTED = np.dtype(_ZONE.descr + [("left", "<u2"), ("right", "<u2")])  # prints; 0: no window of the zone reaches so far
_MARK = np.iinfo(np.int64).min  # instead of a document: this key is hot
_HASHED = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("row", "<u8"), ("start", "<u4")])  # a window of a hot key
_PIECE = np.dtype([("key", "<u8"), ("doc", "<i8"), ("row", "<u8"), ("start", "<u4"), ("windows", "<u2"), ("bytes", "<u4")])
_RANGE = np.dtype([("doc", "<i8"), ("row", "<u8"), ("start", "<u4"), ("length", "<u2")])
#: A range in one long: the first unit, the length (less than 2 * ZONE_WINDOWS + size, a byte).
_LENGTH_BITS = 8


@dataclass(frozen=True)
class Units:
    """What windows consist of: ``size`` units each, keyed by grams of ``gram`` units; words are matched by their bytes.

    ``prints`` (bytes only, sides of 8 bytes at least): keys are shared only if a side of the gram is.
    """

    words: bool
    size: int
    gram: int
    prints: bool = False

    @property
    def span(self) -> int:
        """Grams of a window."""
        return self.size - self.gram + 1

    @property
    def side(self) -> int:
        """Units of a side: wherever the gram lies in a window, so many fit on its left or on its right."""
        return self.span // 2

    @property
    def record(self) -> np.dtype:
        return _PRINTED if self.prints else _ZONE


@dataclass
class _Step:
    """Units of some texts: hash of each, first unit of each text, and the bytes of pieces."""

    hashes: np.ndarray
    first: np.ndarray
    content: np.ndarray  # words joined by one space, or the bytes
    begin: np.ndarray | None  # of each word in content
    end: np.ndarray | None

    def cut(self, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges in ``content`` of ``count`` units from ``start``."""
        if self.begin is None:
            return start, start + count
        return self.begin[start], self.end[start + count - 1]


def _units(data: np.ndarray, offsets: np.ndarray, u: Units) -> _Step:
    if not u.words:
        return _Step(data, offsets, data, None, None)
    starts, ends, first = textops.word_spans(data, offsets)
    length = ends - starts
    begin = np.r_[0, np.cumsum(length + 1)[:-1]] if len(length) else np.zeros(0, np.int64)
    content = np.full(int(length.sum() + len(length)), 32, np.uint8)
    where = np.repeat(begin - starts, length)
    inside = np.flatnonzero(_covered(len(data), starts, ends))
    content[inside + where] = data[inside]
    return _Step(textops.span_hashes(data, starts, ends), first, content, begin, begin + length)


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions in any of the ranges."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _grams(step: _Step, u: Units) -> np.ndarray:
    if u.words:
        return textops.gram_hashes(step.hashes, u.gram)
    n = len(step.content) - u.gram + 1  # two overlapping 8-byte loads hold a gram of 8 to 16 bytes
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(step.content)
    at = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    return textops.mix(at[:n] * np.uint64(0x9E3779B97F4A7C15) ^ textops.mix(at[u.gram - 8:u.gram - 8 + n]))


def _smallest(g: np.ndarray, span: int, places: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """The smallest hash of every ``span`` in a row, and how far into them it stands first."""
    low, width, shifts = g, 1, []
    while 2 * width <= span:
        shifts.append(width)
        width *= 2
    into = np.zeros(len(g), np.min_scalar_type(span)) if places else None
    for shift in shifts + [span - width] * (width < span):
        left, right = low[:-shift], low[shift:]
        if places:
            into = np.where(right < left, into[shift:] + into.dtype.type(shift), into[:-shift])
        low = np.minimum(left, right)
    return low, into


def _runs(step: _Step, u: Units, places: bool = False) -> tuple:
    """(smallest hash, first window, end) of the zones; with ``places`` of their parts whose windows have the gram first at one
    place, and that place."""
    g = _grams(step, u)
    if len(g) < u.span:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    low, into = _smallest(g, u.span, places)
    first = step.first
    ends = first[1:]
    whole = np.ones(len(low), bool)  # windows that lie in one text
    gone = _covered(len(step.hashes), np.minimum(np.maximum(first[:-1], ends - u.size + 1), ends), ends)
    whole &= ~gone[:len(low)]
    place = np.arange(len(low)) + into if places else None
    new = whole.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~whole[:-1]
    if places:
        new[1:] |= whole[1:] & (place[1:] != place[:-1])
    start = np.flatnonzero(new)
    stop = np.flatnonzero(whole & np.r_[new[1:] | ~whole[1:], True]) + 1
    return low[start], start, stop, place[start] if places else None


def zones(step: _Step, u: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, key) of every zone; windows are numbered by their first unit."""
    key, start, stop, _ = _runs(step, u)
    count = stop - start
    if len(count) and count.max() > ZONE_WINDOWS:
        parts = -(-count // ZONE_WINDOWS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + nth * ZONE_WINDOWS
        count = np.minimum(ZONE_WINDOWS, np.repeat(stop, parts) - start)
        key = np.repeat(key, parts)
    text = np.searchsorted(step.first, start, side="right") - 1
    return text, start, count, key


def _side_prints(content: np.ndarray, at: np.ndarray, needed: np.ndarray, side: int) -> np.ndarray:
    """16-bit hashes, not 0, of the ``side`` bytes from ``at`` on; 0 where not ``needed``."""
    out = np.zeros(len(at), np.uint16)
    at = at[needed]
    if len(at):
        load = np.ndarray((len(content) - 7,), "<u8", content, 0, (1,))
        h = np.zeros(len(at), np.uint64)
        for k in range(-(-side // 8)):
            h = textops.mix(h * np.uint64(0x9E3779B97F4A7C15) + load[at + min(8 * k, side - 8)])
        out[needed] = np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.uint16)
    return out


def zone_records(step: _Step, u: Units, docs: np.ndarray, rows: np.ndarray, buckets: int) -> np.ndarray:
    """The records of ``_scan`` for some texts, in their order: one of each zone; with prints one of each place of a zone where
    the gram stands first in some of its windows."""
    key, start, stop, place = _runs(step, u, u.prints)
    text = np.searchsorted(step.first, start, side="right") - 1
    r = np.empty(len(start), u.record)
    r["key"], r["doc"], r["row"] = blobs.short_keys(key, buckets), docs[text], rows[text]
    if u.prints:
        content = np.ascontiguousarray(step.content)
        r["left"] = _side_prints(content, place - u.side, place - start >= u.side, u.side)
        r["right"] = _side_prints(content, place + u.gram, place - (stop - 1) < u.span - u.side, u.side)
    return r


def _distinct(r: np.ndarray) -> np.ndarray:
    """The different records of (key, doc, row), in this order."""
    r = r[np.lexsort((r["row"], r["doc"], r["key"]))]
    return r[np.r_[True, r[1:] != r[:-1]]] if len(r) else r


def _once(r: np.ndarray) -> np.ndarray:
    """The records in their order, without the repeated ones (but for collisions of a 64-bit hash)."""
    h = np.zeros(len(r), np.uint64)
    for name in r.dtype.names:
        h = textops.mix(h * np.uint64(0x9E3779B97F4A7C15) + r[name].astype(np.uint64))
    order = np.argsort(h)
    keep = np.ones(len(r), bool)
    keep[order[1:]] = r[order[1:]] != r[order[:-1]]
    return r[keep]


def _plain(r: np.ndarray) -> np.ndarray:
    """The records without prints."""
    out = np.empty(len(r), _ZONE)
    for name in _ZONE.names:
        out[name] = r[name]
    return out


def _by_side(r: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each side (mask of the records that have it, hashes of key and side); without prints the keys alone."""
    if "left" not in r.dtype.names:
        return [(np.ones(len(r), bool), r["key"])]
    key = textops.mix(r["key"])
    return [(r[s] > 0, key + r[s].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in ("left", "right")]


def _hot_keys(r: np.ndarray) -> np.ndarray:
    """Keys that many documents of a flush have, with a common side if there are prints; in their order."""
    groups = [(HOT_IN_FLUSH, *x) for x in _by_side(r)]
    if len(groups) > 1:
        groups.append((HOT_IN_FLUSH * HOT_KEY, np.ones(len(r), bool), r["key"]))
    out = [np.zeros(0, np.uint64)]
    for least, has, code in groups:
        order = np.sort(code[has])
        last = order[least - 1:]
        some = np.flatnonzero(has & np.isin(code, np.unique(last[last == order[:len(last)]])))
        d = _plain(r[some])
        d["key"] = code[some]
        value, n = np.unique(_distinct(d)["key"], return_counts=True)
        out.append(r["key"][some][np.isin(code[some], value[n >= least])])
    return np.unique(np.concatenate(out))


def _scan(texts: DataFrame, u: Units) -> DataFrame:
    """Packed records of all zones. Keys that are hot in a flush bypass their bucket, which gets a mark instead."""
    buckets = blobs.bucket_count(texts.sparkSession)

    def flush(held, turn):
        r = _once(np.concatenate(held))
        keys = _hot_keys(r)
        hot = np.isin(r["key"], keys)
        marks = np.zeros(len(keys), u.record)
        marks["key"], marks["doc"] = keys, _MARK
        plain = r[~hot]
        plain = np.concatenate([marks, plain[np.argsort(plain["doc"], kind="stable")]])
        rows = blobs.pack(plain, blobs.bucket_of(plain["key"]))
        past = _distinct(_plain(r[hot]))  # known to be shared: only passed on, evenly
        return rows + blobs.pack(past, buckets + (turn * 31 + np.arange(len(past)) // 4096).astype(np.int32) % buckets)

    def run(batches):
        held, size, turn = [], 0, 0
        for b in batches:
            docs, rows = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            data, off = textops.column_buffer(b.column(2))
            for i, z in textops.steps(off, STEP_BYTES):
                r = zone_records(_units(data[off[i]:off[z]], off[i:z + 1] - off[i], u), u, docs[i:z], rows[i:z], buckets)
                held.append(r)
                size += len(r)
                if size > FLUSH:
                    turn = int(docs[i] & 0xFFFF)
                    yield blobs.to_batch(flush(held, turn))
                    held, size = [], 0
        if size:
            yield blobs.to_batch(flush(held, int(held[-1]["doc"][-1] & 0xFFFF) if len(held[-1]) else turn))

    return texts.mapInArrow(run, blobs.SCHEMA)


def _shared(r: np.ndarray) -> np.ndarray:
    """Whether a document with another id has the record's key, and with prints one of its sides; marks count as one."""
    out = np.zeros(len(r), bool)
    for has, code in _by_side(r):
        some = np.flatnonzero(has)
        if not len(some):
            continue
        some = some[np.argsort(code[some])]
        code, doc = code[some], r["doc"][some]
        at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        two = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        out[some[np.repeat(two, np.diff(np.r_[at, len(some)]))]] = True
    return out


def _shared_keys(packed: DataFrame, u: Units) -> DataFrame:
    """(doc, row, key) of the keys that more than one document has; the lowest bit of the key is set if it is hot."""
    buckets = blobs.bucket_count(packed.sparkSession)

    def run(batches):
        for bucket, held in blobs.each_bucket(batches):
            if bucket < buckets:
                r = np.concatenate([blobs.unpack(x, u.record) for x in held])
                marked = np.isin(r["key"], r["key"][r["doc"] == _MARK])
                marks = np.unique(r["key"][marked])
                r = _distinct(_plain(r[(_shared(r) | marked) & (r["doc"] != _MARK)]))
                at = np.flatnonzero(np.r_[True, r["key"][1:] != r["key"][:-1]]) if len(r) else np.zeros(0, np.int64)
                n = np.diff(np.r_[at, len(r)])
                r["key"] |= np.repeat((n > HOT_IN_BUCKET) | np.isin(r["key"][at], marks), n).astype(np.uint64)
            else:
                r = np.concatenate([blobs.unpack(x, _ZONE) for x in held])
                r["key"] |= np.uint64(1)
            for i in range(0, len(r), 1 << 16):
                part = r[i:i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part["doc"])), _longs(part["row"]), _longs(part["key"])],
                                                 names=["k_doc", "k_row", "k"])

    return blobs.by_bucket(packed).mapInArrow(run, "k_doc long, k_row long, k long")


def _pack_pieces(p: np.ndarray, begin: np.ndarray, end: np.ndarray, content: np.ndarray, bucket: np.ndarray):
    """A blob of pieces per bucket: their number, the columns, the bytes."""
    order = np.argsort(bucket, kind="stable")
    p, begin, end, bucket = p[order], begin[order], end[order], bucket[order]
    raw = content.tobytes()
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    rows = []
    for a, z in zip(at, np.r_[at[1:], len(bucket)]):
        rows.append((int(bucket[a]), blobs.squeeze(np.int64(z - a).tobytes() + blobs.encode(p[a:z]) + b"".join(
            [raw[s:e] for s, e in zip(begin[a:z].tolist(), end[a:z].tolist())]))))
    return rows


def _unpack_pieces(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, their bytes end to end)."""
    ps, contents = [], []
    for x in map(blobs.unsqueeze, held):
        n = int(np.frombuffer(x, np.int64, 1)[0])
        size = 8 + n * _PIECE.itemsize
        ps.append(blobs.decode(x[8:size], _PIECE, n))
        contents.append(np.frombuffer(x, np.uint8, -1, size))
    return np.concatenate(ps), np.concatenate(contents)


def _settle_copies(doc: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Whether another piece with the same content (numbers of ``textops.equal_spans``) has a smaller id."""
    order = np.lexsort((doc, content))
    docs, of = doc[order], content[order]
    new = np.r_[True, of[1:] != of[:-1]]
    behind = np.zeros(len(doc), bool)
    behind[order] = docs > docs[new][np.cumsum(new) - 1]
    return behind


def _as_ranges(p: np.ndarray, size: int) -> np.ndarray:
    """The ranges that the pieces cover; pieces of a row whose windows follow each other make one, of less than twice
    ZONE_WINDOWS windows."""
    p = p[np.lexsort((p["start"], p["row"], p["doc"]))]
    if not len(p):
        return np.zeros(0, _RANGE)
    start = p["start"].astype(np.int64)
    stop = start + p["windows"]
    new = np.r_[True, (p["doc"][1:] != p["doc"][:-1]) | (p["row"][1:] != p["row"][:-1]) | (start[1:] != stop[:-1])]
    turn = (start - start[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]) // ZONE_WINDOWS
    new[1:] |= turn[1:] != turn[:-1]
    at = np.flatnonzero(new)
    r = np.empty(len(at), _RANGE)
    r["doc"], r["row"], r["start"] = p["doc"][at], p["row"][at], start[at]
    r["length"] = stop[np.r_[at[1:], len(p)] - 1] - start[at] + (size - 1)
    return r


def _codes(r: np.ndarray) -> np.ndarray:
    return (r["start"].astype(np.int64) << _LENGTH_BITS) | r["length"].astype(np.int64)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _zones_of(batches, u: Units, buckets: int):
    """(step, text, start, count, key, docs, rows, turn) of the zones whose key is in the list (column 3) of some text of the step."""
    for b in batches:
        docs, rows = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
        data, off = textops.column_buffer(b.column(2))
        lists = b.column(3)
        k_off = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]
        k_all = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for i, z in textops.steps(off, STEP_BYTES):
            keys = np.unique(k_all[k_off[i]:k_off[z]])
            if not len(keys):
                continue
            step = _units(data[off[i]:off[z]], off[i:z + 1] - off[i], u)
            text, start, count, key = zones(step, u)
            key = blobs.short_keys(key, buckets)
            plain = keys & ~np.uint64(1)
            spot = np.minimum(np.searchsorted(plain, key), len(plain) - 1)
            found = plain[spot] == key
            yield (step, text[found], start[found], count[found], keys[spot[found]], docs[i:z], rows[i:z], int(docs[i] & 0xFFFF))


def _passed_on(r: np.ndarray, buckets: int, turn: int) -> list[tuple[int, bytes]]:
    """Settled records, evenly over further buckets that only pass them on."""
    return blobs.pack(r, 2 * buckets + (turn * 31 + np.arange(len(r)) // 4096).astype(np.int32) % buckets)


def _pieces_of(step: _Step, p: np.ndarray, start: np.ndarray, units: np.ndarray) -> tuple:
    """(pieces, hashes, begins, ends, content) of ``units`` units from ``start`` of the step; only the bytes of pieces are
    kept, so that a flush holds no whole texts."""
    begin, end = step.cut(start, units)
    p["bytes"] = end - begin
    h = textops.span_hashes(step.content, begin, end)
    used = _covered(len(step.content), begin, end)
    to = np.r_[0, np.cumsum(used)]
    return p, h, to[begin], to[end], step.content[used]


def _joined(held: list[tuple]) -> tuple:
    """The pieces of several steps as those of one."""
    shift = np.cumsum([0] + [len(x[4]) for x in held])
    return (np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]),
            np.concatenate([x[2] + s for x, s in zip(held, shift)]), np.concatenate([x[3] + s for x, s in zip(held, shift)]),
            np.concatenate([x[4] for x in held]))


def _send_pieces(keyed: DataFrame, u: Units) -> DataFrame:
    """Packed pieces of text of the zones with shared keys; in the next buckets the hashes of hot keys' windows, and in further
    ones the ranges that a task could settle itself."""
    buckets = blobs.bucket_count(keyed.sparkSession)

    def flush(held, turn):
        p, h, begin, end, content = _joined(held)
        behind = _settle_copies(p["doc"], textops.equal_spans(h, content, begin, end))
        hot = (p["key"] & np.uint64(1)).astype(bool)
        plain, single = np.flatnonzero(~behind & ~hot), np.flatnonzero(~behind & hot)
        rows = _pack_pieces(p[plain], begin[plain], end[plain], content, blobs.bucket_of(p["key"][plain]))
        w = np.empty(len(single), _HASHED)
        w["hash"], w["doc"], w["row"], w["start"] = h[single], p["doc"][single], p["row"][single], p["start"][single]
        rows += blobs.pack(w, buckets + (w["hash"] % np.uint64(buckets)).astype(np.int32))
        return rows + _passed_on(_as_ranges(p[behind], u.size), buckets, turn)

    def run(batches):
        held, size = [], 0
        for step, text, start, count, key, docs, rows, turn in _zones_of(batches, u, buckets):
            hot = (key & np.uint64(1)).astype(bool)
            if hot.any():  # one record per window
                each = np.where(hot, count, 1)
                nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                text, key, start = np.repeat(text, each), np.repeat(key, each), np.repeat(start, each) + nth
                count = np.where(np.repeat(hot, each), 1, np.repeat(count, each))
            p = np.empty(len(key), _PIECE)
            p["key"], p["doc"], p["row"] = key, docs[text], rows[text]
            p["start"], p["windows"] = start - step.first[text], count
            held.append(_pieces_of(step, p, start, count + u.size - 1))
            size += len(p) + len(held[-1][4]) // 16
            if size > FLUSH:
                yield blobs.to_batch(flush(held, turn))
                held, size = [], 0
        if held:
            yield blobs.to_batch(flush(held, turn))

    return keyed.mapInArrow(run, blobs.SCHEMA)


def _cut_windows(asked: DataFrame, u: Units) -> DataFrame:
    """Packed pieces of the windows of hot keys that are asked for (codes in column 3), spread by content."""
    buckets = blobs.bucket_count(asked.sparkSession)

    def flush(held):
        p, h, begin, end, content = _joined(held)
        return _pack_pieces(p, begin, end, content, (h % np.uint64(buckets)).astype(np.int32))

    def run(batches):
        held, size = [], 0
        for b in batches:
            docs, rows = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            data, off = textops.column_buffer(b.column(2))
            lists = b.column(3)
            n = lists.value_lengths().fill_null(0).to_numpy()
            c_off = np.r_[0, np.cumsum(n)]
            codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            of = np.repeat(np.arange(len(n)), n)
            for i, z in textops.steps(off, STEP_BYTES):
                code, text = codes[c_off[i]:c_off[z]], of[c_off[i]:c_off[z]] - i
                if not len(code):
                    continue
                step = _units(data[off[i]:off[z]], off[i:z + 1] - off[i], u)
                start = code >> _LENGTH_BITS
                whole = step.first[text] + start + u.size <= step.first[text + 1]
                text, start = text[whole], start[whole]
                p = np.empty(len(text), _PIECE)
                p["key"], p["doc"], p["row"], p["start"], p["windows"] = 0, docs[i:z][text], rows[i:z][text], start, 1
                held.append(_pieces_of(step, p, step.first[text] + start, np.full(len(text), u.size)))
                size += len(p) + len(held[-1][4]) // 16
                if size > FLUSH:
                    yield blobs.to_batch(flush(held))
                    held, size = [], 0
        if held:
            yield blobs.to_batch(flush(held))

    return asked.mapInArrow(run, blobs.SCHEMA)


def _matched(held: list[bytes], u: Units, matcher, settle: bool) -> np.ndarray:
    """Covered ranges from the pieces of a bucket. ``settle``: equal pieces are set aside first, and windows of different pieces
    can be equal only under one key."""
    p, content = _unpack_pieces(held)
    end = np.cumsum(p["bytes"].astype(np.int64))
    begin = end - p["bytes"]
    own, done = np.arange(len(p)), np.zeros(0, _RANGE)
    if settle:
        behind = _settle_copies(p["doc"], textops.equal_spans(textops.span_hashes(content, begin, end), content, begin, end))
        own, done = np.flatnonzero(~behind), _as_ranges(p[behind], u.size)
        own = own[np.argsort(p["key"][own], kind="stable")]
        key = p["key"][own]
        new = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1 if len(own) else np.zeros(0, np.int64)
        own = own[np.bincount(new)[new] > 1] if len(own) else own
    if not len(own):
        return done
    piece, window = matcher(content, begin[own], end[own], p["windows"][own].astype(np.int64), p["doc"][own], u.size)
    order = np.lexsort((window, piece))
    piece, window = piece[order], window[order]
    at = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (window[1:] != window[:-1] + 1)]) if len(piece) else piece
    ends = np.r_[at[1:], len(piece)] if len(piece) else at
    r = np.empty(len(at), _RANGE)
    who = own[piece[at]]
    r["doc"], r["row"] = p["doc"][who], p["row"][who]
    r["start"] = p["start"][who] + window[at]
    r["length"] = window[ends - 1] - window[at] + u.size
    return np.concatenate([done, r])


def _match(packed: DataFrame, u: Units, matcher, settle: bool = False) -> DataFrame:
    """(doc, row, code, ask): covered ranges, and the windows of hot keys that are to be sent, as codes."""
    buckets = blobs.bucket_count(packed.sparkSession)

    def run(batches):
        for bucket, held in blobs.each_bucket(batches):
            done, asks = np.zeros(0, _RANGE), np.zeros(0, _RANGE)
            if bucket < buckets:
                done = _matched(held, u, matcher, settle)
            elif bucket < 2 * buckets:
                w = np.concatenate([blobs.unpack(x, _HASHED) for x in held])
                w = w[np.lexsort((w["doc"], w["hash"]))]
                at = np.flatnonzero(np.r_[True, w["hash"][1:] != w["hash"][:-1]])
                ends = np.r_[at[1:], len(w)]
                w = w[np.repeat(w["doc"][at] != w["doc"][ends - 1], ends - at)]
                asks = np.empty(len(w), _RANGE)
                asks["doc"], asks["row"], asks["start"], asks["length"] = w["doc"], w["row"], w["start"], u.size
            else:
                done = np.concatenate([blobs.unpack(x, _RANGE) for x in held])
            for r, of in ((done, 0), (asks, 1)):
                for i in range(0, len(r), 1 << 16):
                    part = r[i:i + (1 << 16)]
                    value, none = pa.array(_codes(part)), pa.nulls(len(part), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part["doc"])), _longs(part["row"]),
                                                      none if of else value, value if of else none],
                                                     names=["doc", "row", "code", "ask"])

    return blobs.by_bucket(packed).mapInArrow(run, "doc long, row long, code long, ask long")


def with_repeats(docs: DataFrame, u: Units, matcher, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, text, repeats, key_in, asks) of every row of ``docs``: the id with null as the largest, a 64-bit hash of the
    text, the text with null as empty, the covered ranges (codes), the id as it was; ``asks`` is of no further use.

    Keys and ranges belong to (doc, row), so rows that share an id, or have none, hold only what their own text needs.

    ``matcher(content, begin, end, windows, doc, size)`` returns (piece, window) of the windows whose units also stand in a
    piece with a smaller id.
    """
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                         F.xxhash64(text_column(text)).alias("row"), text_column(text).alias("text"), F.col(key).alias("key_in"))
    packed = _scan(source.select("doc", "row", "text"), u)

    def own(doc, row):
        return (F.col("doc") == F.col(doc)) & (F.col("row") == F.col(row))

    # Sets, not lists: rows that repeat both id and text send the same keys and ranges.
    keys = _shared_keys(packed, u).groupBy("k_doc", "k_row").agg(F.collect_set("k").alias("keys"))
    # Every join with the texts puts the same side with the same columns first, and every use of ``seen`` has both of its
    # lists, so Spark shuffles each once and reads it again.
    keyed = source.join(keys, own("k_doc", "k_row"), "left").select("doc", "row", "text", "keys", "key_in")
    seen = _match(_send_pieces(keyed, u), u, matcher, True).groupBy(F.col("doc").alias("s_doc"), F.col("row").alias("s_row")).agg(
        F.collect_set("code").alias("codes"), F.collect_set("ask").alias("asks"))
    asked = source.join(seen, own("s_doc", "s_row"), "left").select("doc", "row", "text", "asks", "codes", "key_in")
    found = _match(_cut_windows(asked, u), u, matcher)
    found = found.groupBy(F.col("doc").alias("r_doc"), F.col("row").alias("r_row")).agg(F.collect_set("code").alias("more"))
    whole = source.join(seen, own("s_doc", "s_row"), "left").join(found, own("r_doc", "r_row"), "left")
    none = F.array().cast("array<long>")
    return whole.select("doc", "row", "text", F.concat(F.coalesce("codes", none), F.coalesce("more", none)).alias("repeats"),
                        "key_in", "asks")


def covered_units(codes: np.ndarray | None, n: int) -> np.ndarray:
    """Mask of the units of a row that its ranges cover."""
    if codes is None:
        return np.zeros(n, bool)
    start = codes >> _LENGTH_BITS
    # A range of another text with the row's id and 64-bit hash could reach beyond the text.
    return _covered(n, np.minimum(start, n), np.minimum(start + (codes & ((1 << _LENGTH_BITS) - 1)), n))


def each_row(batches):
    """(batch, i, codes) of the result of ``with_repeats``."""
    for b in batches:
        lists = b.column(3)
        off = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        for i in range(b.num_rows):
            a, z = off[i], off[i + 1]
            yield b, i, flat[a:z] if z > a else None
