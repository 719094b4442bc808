"""Numpy helpers over batches of texts: words, word hashes, shingle hashes.

A batch is one byte buffer with the texts laid end to end (an Arrow string
column already is one). Words are maximal runs of bytes other than space and
0x09-0x0D, which is the same as ``[^\\x20\\x09-\\x0D]+`` on the decoded text,
because UTF-8 never uses those bytes inside a longer sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Odd multiplier of the polynomial word hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def column_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def steps(offsets: np.ndarray, limit: int):
    """(i, z) ranges of texts, each of at most ``limit`` bytes or of a single longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        z = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, z
        i = z


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of the first word of each text (one more at the end)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]  # a text ends its last word, whatever follows in the buffer
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POW = _powers(_BASE, 4096)
_POW_INV = _powers(_BASE_INV, 4096)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they lie.

    Polynomial prefix sums, in pieces of 4,096 bytes so that the powers stay in
    cache; a span's hash is the shifted difference of two prefix sums.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    n, size = len(data), len(_POW)
    k = -(-n // size)
    padded = np.zeros(k * size, np.uint64)
    padded[:n] = data
    padded[:n] += np.uint64(1)
    padded = padded.reshape(k, size)
    padded *= _POW
    sums = np.zeros((k, size + 1), np.uint64)
    np.cumsum(padded, axis=1, out=sums[:, 1:])
    del padded
    row, at = starts // size, starts % size
    row2, at2 = (ends - 1) // size, (ends - 1) % size + 1
    with np.errstate(over="ignore"):
        h = (sums[row, np.where(row == row2, at2, size)] - sums[row, at]) * _POW_INV[at]
        over = np.flatnonzero(row != row2)  # spans that cross pieces
        for i in over:
            shift = int(size - at[i])
            for r in range(int(row[i]) + 1, int(row2[i]) + 1):
                upto = int(at2[i]) if r == row2[i] else size
                h[i] += sums[r, upto] * np.uint64(pow(_BASE, shift, 1 << 64))
                shift += size
        return mix(h ^ mix((ends - starts).astype(np.uint64)))


_STEP = [int(x) for x in mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (``len(words) - k + 1`` values)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j:j + n] * np.uint64(_STEP[j])
    return mix(out)


def as_long(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs that Spark has."""
    return h.view(np.int64)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from ``a`` on equal those from ``b`` on. ``data`` must go on for 8 bytes after the last."""
    same = np.ones(len(a), bool)
    left = np.flatnonzero(length > 0)
    load = np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,))
    k = 0
    while len(left):
        rest = length[left] - k
        over = (8 * np.maximum(0, 8 - rest)).astype(np.uint64)
        ok = ((load[a[left] + k] ^ load[b[left] + k]) << over) == 0
        same[left[~ok]] = False
        left = left[ok & (rest > 8)]
        k += 8
    return same


def equal_spans(h: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number of each span of ``data``, the same for two spans if and only if their bytes are.

    ``h``, a hash of the bytes, only says which spans are compared.
    """
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    length = end - begin
    out = np.empty(len(h), np.int64)
    left, done = np.arange(len(h)), 0
    while len(left):
        _, first, number = np.unique(h[left], return_index=True, return_inverse=True)
        lead = left[first][number]
        same = length[left] == length[lead]
        maybe = np.flatnonzero(same)
        same[maybe] = same_bytes(data, begin[left[maybe]], begin[lead[maybe]], length[left[maybe]])
        out[left[same]] = done + number[same]
        done += len(first)
        left = left[~same]
    return out
