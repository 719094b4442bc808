"""Shuffling numeric records as packed columns.

A task packs the records for a bucket into one binary value, so that Spark
shuffles a few values per task and bucket instead of a row per record.
Buckets are hash ranges; their number is ``spark.sql.shuffle.partitions``, so a
bucket stays small when that setting follows the data. Larger numbers than
that go round to the same partitions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import shuffle_partitions

SCHEMA = "bucket int, blob binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def bucket_count(spark) -> int:
    return shuffle_partitions(spark)


#: Hash bits of a short key below its bucket. Two keys of a bucket that share them are taken for one; callers compare contents.
KEY_BITS = 40


def short_keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Keys of 64-bit hashes that name their bucket in the upper bits; the lowest bit is free (0)."""
    low = (h >> np.uint64(64 - KEY_BITS)) & ~np.uint64(1)
    return ((h % np.uint64(buckets)) << np.uint64(KEY_BITS)) | low


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(KEY_BITS)).astype(np.int32)


def encode(records: np.ndarray) -> bytes:
    """The columns of a structured array as byte planes; integers with a sign (ids, which come in order) as differences."""
    out = []
    for f in records.dtype.names:
        col = np.ascontiguousarray(records[f])
        if col.dtype.kind == "i":
            col = np.diff(col, prepend=col.dtype.type(0))
        out.append(col.view(np.uint8).reshape(len(col), col.dtype.itemsize).T.tobytes())
    return b"".join(out)


def decode(raw: bytes, dtype: np.dtype, n: int) -> np.ndarray:
    out, at = np.empty(n, dtype), 0
    for f in dtype.names:
        kind = dtype[f]
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        col = np.ascontiguousarray(planes.T).view(kind).ravel()
        out[f] = np.cumsum(col, dtype=kind) if kind.kind == "i" else col
        at += n * kind.itemsize
    return out


def squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueeze(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def pack(records: np.ndarray, bucket: np.ndarray) -> list[tuple[int, bytes]]:
    """(bucket, its records) of a structured array, in their order."""
    if not len(records):
        return []
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[at[1:], len(bucket)]
    return [(int(bucket[a]), squeeze(encode(records[a:z]))) for a, z in zip(at, ends)]


def unpack(blob: bytes, dtype: np.dtype) -> np.ndarray:
    raw = unsqueeze(blob)
    return decode(raw, dtype, len(raw) // dtype.itemsize)


def to_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                                      schema=_ARROW)


def by_bucket(blobs: DataFrame) -> DataFrame:
    """The blobs of a bucket in one partition, one after the other; each partition has as many buckets as any other."""
    n = shuffle_partitions(blobs.sparkSession)
    return blobs.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")


def each_bucket(batches):
    """(bucket, blobs) from the Arrow batches of a partition of ``by_bucket``."""
    now, held = None, []
    for b in batches:
        for bucket, blob in zip(b.column(0).to_pylist(), b.column(1)):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, []
            held.append(blob.as_py())
    if held:
        yield now, held
