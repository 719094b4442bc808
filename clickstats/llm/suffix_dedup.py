"""Substring dedup by bytes: suffix arrays with deep-shallow sorting.

In each bucket of ``repeats`` the suffixes that start a window are sorted:
multikey quicksort by 8-byte keys down to a shallow depth, then blind tries
for the groups whose common prefix is longer. A blind trie looks only at the
places where its suffixes branch. Suffixes that come out equal over the whole
window are one repeated string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickstats.llm import repeats, textops

BYTES = 50
GRAM = 12
UNITS = repeats.Units(False, BYTES, GRAM, prints=True)
#: Keys of 8 bytes that the shallow sort looks at.
SHALLOW_KEYS = 2


def _keys(data: np.ndarray, at: np.ndarray, k: int, size: int) -> np.ndarray:
    """Bytes 8k to 8k + 7 of the windows that start at ``at``, big-endian; bytes past the window are 0."""
    # ``data`` must go on for 8 bytes after the last window.
    load = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    x = load[at + 8 * k].byteswap()
    over = 8 * (k + 1) - size
    return x & ~np.uint64((1 << (8 * over)) - 1) if over > 0 else x


def deep_shallow_sort(data: np.ndarray, at: np.ndarray, size: int, shallow: int = SHALLOW_KEYS) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): the sorted order of the ``size``-byte windows that start at ``at``, and for each place in that order
    the number of its group of equal windows."""
    n, deep = len(at), -(-size // 8)
    shallow = min(shallow, deep)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # numbered by first place, so the numbers keep the order
    # Shallow: ternary partitions by one key after the other, of the groups that are still open.
    active = np.arange(n)
    for k in range(shallow):
        key = _keys(data, at[order[active]], k, size)
        by = np.lexsort((key, group[active]))
        order[active] = order[active][by]
        key = key[by]
        new = np.r_[True, (group[active][1:] != group[active][:-1]) | (key[1:] != key[:-1])]
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        active = _open(group, active)
        if not len(active):
            return order, group
    # Deep: a level of blind tries at a time. A node branches at the first key where any of its suffixes differs.
    while len(active):
        g = group[active]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        node = np.cumsum(np.r_[True, g[1:] != g[:-1]]) - 1
        lead = at[order[active]][start][node]
        branch = np.full(len(start), deep)
        for k in range(deep - 1, shallow - 1, -1):
            differs = _keys(data, at[order[active]], k, size) != _keys(data, lead, k, size)
            branch[np.unique(node[differs])] = k
        split = branch[node] < deep  # the other nodes are leaves: their windows are equal
        active, node, g = active[split], node[split], g[split]
        if not len(active):
            break
        place = at[order[active]] + 8 * branch[node]
        load = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))[place].byteswap()
        over = np.maximum(0, 8 * (branch[node] + 1) - size).astype(np.uint64)
        load = (load >> (np.uint64(8) * over)) << (np.uint64(8) * over)
        by = np.lexsort((load, g))
        order[active] = order[active][by]
        load = load[by]
        new = np.r_[True, (g[1:] != g[:-1]) | (load[1:] != load[:-1])]
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        active = _open(group, active)
    return order, group


def _open(group: np.ndarray, active: np.ndarray) -> np.ndarray:
    """The places of ``active`` whose group has more than one member."""
    g = group[active]
    same = np.r_[g[1:] == g[:-1], False]
    return active[same | np.r_[False, same[:-1]]]


def suffix_matcher(content, begin, end, windows, doc, size):
    """(piece, window) of the windows that a piece with a smaller id holds too."""
    data = np.concatenate([content, np.zeros(16, np.uint8)])
    piece = np.repeat(np.arange(len(begin)), windows)
    nth = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    order, group = deep_shallow_sort(data, begin[piece] + nth, size)
    docs = doc[piece][order]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    low = np.minimum.reduceat(docs, start) if len(start) else docs
    behind = docs > low[np.cumsum(np.r_[True, group[1:] != group[:-1]]) - 1]
    return piece[order][behind], nth[order][behind]


def remove_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row of ``docs``.

    A byte of the UTF-8 text goes if it lies in a 50-byte string that also starts in a document with a smaller id; strings
    are judged on the input. ``n_spans``: maximal removed runs. Null and empty texts have no bytes. A null id counts as
    larger than every other; rows that share an id are one document, and judged row by row. An empty table gives an empty
    result.
    """
    found = repeats.with_repeats(docs, UNITS, suffix_matcher, key, text)
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes

    def run(batches):
        for batch in batches:
            n, gone, spans, sha, kept = [], [], [], [], []
            data, off = textops.column_buffer(batch.column(2))
            for _, i, ranges in repeats.each_row([batch]):
                raw = data[off[i]:off[i + 1]]
                if ranges is None:
                    left, removed, runs = raw.tobytes(), 0, 0
                else:
                    away = repeats.covered_units(ranges, len(raw))
                    left, removed = raw[~away].tobytes(), int(away.sum())
                    runs = int(away[:1].sum() + (away[1:] & ~away[:-1]).sum())
                n.append(len(raw))
                gone.append(removed)
                spans.append(runs)
                sha.append(hashlib.sha256(left).hexdigest())
                if keep_bytes:
                    kept.append(left)
            cols = [batch.column(4), *[pa.array(x, pa.int64()) for x in (n, gone, spans)], pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * keep_bytes, names=names)

    return found.mapInArrow(run, schema)
