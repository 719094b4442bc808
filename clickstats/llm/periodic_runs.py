"""Periodic runs of words, by a suffix automaton with link-cut access.

The words of a document are appended one by one to its suffix automaton. The
suffix links form a tree; each node carries the last position at which its
strings ended. Appending word i recolours the path from the new prefix to the
root with i. The path falls into segments of one earlier colour e; the longest
string of such a segment, of length L, ended at e and ends again at i. If the
distance d = i - e is within the segment's length, L + d words ending at i have
period d (a square, when d <= L), and L cannot be extended to the left. Such a
stretch that the next word does not continue is a run, and every run is met
once, at its last word. The paths are splay trees of a link-cut tree, so all
segments of n words together cost O(n log n) amortised steps.

In a run that holds its period at least four times every five words come twice
(or more often) within it, so only stretches of positions whose five words
occur again in the same document are appended to an automaton. The stretches
hold all runs whole, and a stretch has no neighbour that could extend one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from clickstats.llm.tables import fresh, text_column

#: A run holds its period at least so many times, and at least so many words.
TIMES = 4
LEAST_WORDS = 6
#: Words of the windows that must recur. No run of TIMES periods and LEAST_WORDS words lacks a repeat of these.
_WINDOW = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def automaton_runs(word: list[int], times: int = TIMES, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of ``word`` with length >= max(least, times * period), by end.

    ``times`` must be 2 or more.
    """
    n = len(word)
    size = 2 * n + 2
    # State 1 is the root, 0 is none. step: transitions; length: longest string; left, right, up: the splay trees, up
    # also from a path's root to the node above the path; last: the colour, held at the root of each path's tree.
    step: list[dict] = [{}, {}]
    length, link = [0] * size, [0] * size
    left, right, up, last = [0] * size, [0] * size, [0] * size, [-1] * size

    def splay(x):
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        # The colour moves to the new root.
        while True:
            p = up[x]
            if not p:
                break
            at_left = left[p] == x
            if not at_left and right[p] != x:
                break
            g = up[p]
            g_left = left[g] == p
            inner = g and (g_left or right[g] == p)
            if inner:
                top = up[g]
                if g_left == at_left:  # zig-zig: p over g first
                    if at_left:
                        b = right[p]
                        left[g] = b
                        right[p] = g
                    else:
                        b = left[p]
                        right[g] = b
                        left[p] = g
                    if b:
                        up[b] = g
                    up[g] = p
                    if at_left:
                        b = right[x]
                        left[p] = b
                        right[x] = p
                    else:
                        b = left[x]
                        right[p] = b
                        left[x] = p
                    if b:
                        up[b] = p
                    up[p] = x
                else:
                    if at_left:
                        b, c = right[x], left[x]
                        left[p], right[g] = b, c
                        right[x], left[x] = p, g
                    else:
                        b, c = left[x], right[x]
                        right[p], left[g] = b, c
                        left[x], right[x] = p, g
                    if b:
                        up[b] = p
                    if c:
                        up[c] = g
                    up[p] = up[g] = x
                if top:
                    if left[top] == g:
                        left[top] = x
                    elif right[top] == g:
                        right[top] = x
                    else:
                        last[x] = last[g]
                else:
                    last[x] = last[g]
                up[x] = top
            else:
                if at_left:
                    b = right[x]
                    left[p] = b
                    right[x] = p
                else:
                    b = left[x]
                    right[p] = b
                    left[x] = p
                if b:
                    up[b] = p
                up[p], up[x] = x, g
                last[x] = last[p]

    found = []
    states, whole = 2, 1
    for i in range(n):
        w = word[i]
        cur = states
        states += 1
        step.append({})
        length[cur] = i + 1
        p = whole
        while p and w not in step[p]:
            step[p][w] = cur
            p = link[p]
        if not p:
            above = 1
        else:
            q = step[p][w]
            if length[q] == length[p] + 1:
                above = q
            else:
                clone = states
                states += 1
                length[clone] = length[p] + 1
                step.append(step[q].copy())
                while p and step[p].get(w) == q:
                    step[p][w] = clone
                    p = link[p]
                link[clone] = link[q]
                link[q] = clone
                # The clone stands right above q, on the path of q and with its colour.
                splay(q)
                b = left[q]
                left[clone] = b
                if b:
                    up[b] = clone
                left[q] = clone
                up[clone] = q
                above = clone
        link[cur] = above
        up[cur] = above
        whole = cur
        ends = i + 1 == n
        low, x = cur, above
        while x:  # access: one turn for each segment
            splay(x)
            e = last[x]
            if e >= 0:
                reach = length[x]
                d = i - e
                if reach + d >= times * d and reach + d >= least and (ends or word[i + 1] != word[i + 1 - d]):
                    found.append((i - reach - d + 1, reach + d, d))
            b = right[x]
            if b:
                last[b] = e
            right[x] = low
            low = x
            x = up[x]
        last[low] = i
    return found


def repeated_stretches(word: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of ``word`` whose windows of five words all occur more than once."""
    m = len(word) - _WINDOW + 1
    if m < 2:
        return []
    h = np.zeros(m, np.uint64)
    for j in range(_WINDOW):
        h = (h + word[j:j + m].astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    equal = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(equal):
        return []
    again = np.zeros(m + 2, np.int8)
    again[order[equal] + 1] = 1
    again[order[equal + 1] + 1] = 1
    edge = np.diff(again)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(a), int(z) + _WINDOW - 1) for a, z in zip(begin, end) if z - a > LEAST_WORDS - _WINDOW]


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words only."""
    number: dict[bytes, int] = {}
    return np.array([number.setdefault(w, len(number)) for w in words], np.int64)


def runs_of(word: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a document's word numbers, by start, then period."""
    out = []
    for a, z in repeated_stretches(word):
        out += [(a + s, n, q) for s, n, q in automaton_runs(word[a:z].tolist())]
    return sorted(out)


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q:s + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


RUN_TYPE = ArrayType(StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")]), False)


def word_runs(docs: DataFrame, text: str = "text", key: str | None = None,
              rewrite: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """``docs`` with its runs: ``word_runs`` array<struct<start, length, period>> by start, then period,
    ``word_count`` and ``collapsed_text`` (the words left when every run keeps its first period only, one space between).

    Words are maximal runs of characters other than space and 0x09-0x0D; equal means equal bytes. Null and empty texts
    have no words, no runs and an empty ``collapsed_text``. ``rewrite``, if given, gets the value of column ``key`` and
    the number of words and may return the word numbers to read instead, in order. Every row is read for itself, so
    repeated rows give equal results. Columns called like the three new ones are replaced.
    """
    added = [StructField("word_runs", RUN_TYPE), StructField("word_count", IntegerType()), StructField("collapsed_text", StringType())]
    (t,) = fresh(docs, "run_text")
    names = [c for c in docs.columns if c.lower() not in {f.name for f in added}]
    plain = docs.select(*[F.col(f"`{c}`") for c in names], text_column(text).cast("binary").alias(t))
    schema = StructType([*plain.drop(t).schema.fields, *added])
    types = [pa.list_(pa.struct([pa.field(f, pa.int64(), False) for f in ("start", "length", "period")])), pa.int32(), pa.string()]

    def run(batches):
        for b in batches:
            keys = b.column(names.index(key)).to_pylist() if key is not None and rewrite is not None else None
            runs, counts, left = [], [], []
            for i, value in enumerate(b.column(len(names))):
                words = value.as_py().split()  # bytes: at space and 0x09-0x0D
                order = rewrite(keys[i], len(words)) if keys is not None else None
                if order is not None:
                    words = [words[j] for j in order]
                found = runs_of(word_numbers(words)) if len(words) >= LEAST_WORDS else []
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                counts.append(len(words))
                left.append(b" ".join(without_repeats(words, found)))
            new = [pa.array(runs, types[0]), pa.array(counts, types[1]), pa.array(left, pa.binary()).view(types[2])]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(len(names))], *new], names=schema.names)

    return plain.mapInArrow(run, schema)

