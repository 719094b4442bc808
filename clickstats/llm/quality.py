"""Quality by compression: two zstandard dictionaries, one built from good and one from bad labelled text.

A text is cut into blocks of bytes and every block is compressed with both
dictionaries. The difference of the two total sizes, by length, says which kind
of text it resembles: blocks of good text shrink more with the dictionary of
good text. A logistic curve, fitted on labelled texts that neither dictionary
has seen, turns the difference into a probability; the shorter a text, the more
the score rests on the share of good texts alone.

Both fits read bounded samples: at most ``DICT_ROWS`` and ``CURVE_ROWS`` labelled rows
of each class, and of the former at most ``MAX_PIECES`` pieces of text. Scoring
reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickstats.llm.tables import fresh, text_column

#: Labelled rows of each class that a dictionary is built from, and that the curve is fitted on, at most.
DICT_ROWS = 500
CURVE_ROWS = 1500
#: A sampled text is taken in pieces of so many characters, so many of each class at most.
PIECE_CHARS = 2048
MAX_PIECES = 3000
DICT_BYTES = 1 << 16
LEVEL = 3
#: Bytes that are compressed together: short enough for a dictionary to matter throughout a long text.
BLOCK = 1024
#: A text of so many bytes counts half for its own difference and half for the share of good texts.
HALF_BYTES = 64


def build_dictionary(pieces: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes from pieces of text; their own bytes, where they are too few to train on."""
    pieces = [p for p in pieces if p]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-size:]


class _Sizer:
    """Compressed sizes with one dictionary, without what an empty block takes."""

    def __init__(self, dictionary: bytes):
        plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(dictionary) >= 8:
            d = zstandard.ZstdCompressionDict(dictionary)
            d.precompute_compress(level=LEVEL)
            plain["dict_data"] = d
        self._compress = zstandard.ZstdCompressor(**plain).compress
        self._empty = len(self._compress(b""))

    def __call__(self, text: bytes) -> int:
        view = memoryview(text)
        return sum(len(self._compress(view[i:i + BLOCK])) - self._empty for i in range(0, len(text), BLOCK))


@dataclass(frozen=True)
class QualityModel:
    """The dictionaries and the curve: logit = a * w * x + b * w + c, with x the size difference per byte and w = bytes / (bytes + HALF_BYTES)."""

    good: bytes
    bad: bytes
    curve: tuple[float, float, float]

    def score(self, difference: np.ndarray, length: np.ndarray) -> np.ndarray:
        z = _features(difference, length) @ np.asarray(self.curve)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _features(difference, length) -> np.ndarray:
    n = np.asarray(length, float)
    w = n / (n + HALF_BYTES)
    return np.stack([w * np.asarray(difference, float) / np.maximum(n, 1), w, np.ones(len(n))], 1)


def fit_curve(difference, length, label, weight, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton steps; without rows of both classes, the share alone."""
    y, weight = np.asarray(label, float), np.asarray(weight, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return (0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    x = _features(difference, length)
    # Differences per byte are hundredths: brought to the size of the other columns for the ridge.
    scale = np.array([max(1e-6, float(np.abs(x[:, 0]).mean())), 1.0, 1.0])
    x, theta = x / scale, np.zeros(3)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (weight * (y - p)) - ridge * theta)
        theta = theta + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in theta / scale)


def learns_from(key: str = "doc_id"):
    """True for the rows whose labels may be learnt from: crc32 of the id as text, modulo 3, is not 1. False without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _differences(df: DataFrame, good: bytes, bad: bytes, text: str, out: tuple[str, str]) -> DataFrame:
    """``df`` with ``out`` in place of the column ``text``: size difference (bad - good) and bytes of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast((good, bad))  # two dictionaries of DICT_BYTES
    names = [c for c in df.columns if c != text]
    ordered = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).cast("binary").alias(text))
    schema = StructType([*ordered.drop(text).schema.fields, *[StructField(c, DoubleType()) for c in out]])

    def run(batches):
        with_good, with_bad = (_Sizer(d) for d in shared.value)
        for b in batches:
            texts = [v.as_py() for v in b.column(len(names))]
            diff = [float(with_bad(t) - with_good(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], pa.array(diff, pa.float64()),
                                              pa.array([float(len(t)) for t in texts], pa.float64())], names=schema.names)

    return ordered.mapInArrow(run, schema)


def fit_from_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                    dict_rows: int = DICT_ROWS, curve_rows: int = CURVE_ROWS) -> QualityModel:
    """A model from the labelled rows that may be learnt from.

    Rows without an id, a text row or a 0/1 label are left out, and so are ids
    with both labels; of several texts under one id the one with the smallest
    hash is read. A quarter of the ids, by hash, is for the curve, the rest for
    the dictionaries; of each class the rows with the smallest hash are taken.
    Class weights bring the curve back to the shares among all rows that
    qualify. The result does not depend on the order or partitions of the rows.
    """
    lab = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y"))
    lab = lab.where(learns_from("id") & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
    lab = lab.where("y = z").select("id", "y", F.xxhash64("id", F.lit("quality sample")).alias("h"))
    lab = lab.withColumn("curve", F.pmod(F.col("h"), F.lit(4)) == 0)
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    parts = [lab.where((F.col("y") == c) & (F.col("curve") == v)).orderBy("h", "id").limit(curve_rows if v else dict_rows)
             for c in (0, 1) for v in (False, True)]
    chosen = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])  # so many rows of numbers
    texts = docs.select(F.col(key).alias("doc"), text_column(text).alias("t"))
    rows = texts.join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    rows = rows.groupBy("id", "y", "curve", "h").agg(F.min_by("t", F.struct(F.xxhash64("t"), F.col("t"))).alias("t"))
    at = F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("t"), F.lit(1)) - 1) / PIECE_CHARS).cast("int")))
    pieces = rows.where("NOT curve").select("id", "y", "t", at.alias("at"))
    pieces = pieces.select("id", "y", "at", F.xxhash64("id", "at").alias("h"), F.expr(f"substring(t, at * {PIECE_CHARS} + 1, {PIECE_CHARS})").alias("t"))
    made = []
    for c in (1, 0):
        got = pieces.where(F.col("y") == c).orderBy("h", "id", "at").limit(MAX_PIECES).select("t").collect()
        made.append(build_dictionary([r["t"].encode() for r in got]))
    seen = rows.where("curve").select("id", "y", "t")
    seen = sorted(_differences(seen, *made, "t", ("d", "n")).collect())  # curve_rows of each class, numbers only
    y = [r["y"] for r in seen]
    every = max(1, sum(n.values()))
    weight = [n[c] / every * len(y) / y.count(c) for c in y]
    return QualityModel(*made, fit_curve([r["d"] for r in seen], [r["n"] for r in seen], y, weight))


def score_texts(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with ``out``: the score of each whole text, 0 to 1. Null and empty texts get the share of good texts.

    A column called ``out`` in ``docs`` is replaced; every other column stays.
    """
    t, d, n = fresh(docs, "score_text", "size_difference", "text_bytes")
    names = [c for c in docs.columns if c.lower() != out.lower()]
    sized = _differences(docs.select(*[F.col(f"`{c}`") for c in names], text_column(text).alias(t)), model.good, model.bad, t, (d, n))
    a, b, c = model.curve
    w = F.col(n) / (F.col(n) + HALF_BYTES)
    z = F.lit(a) * w * F.col(d) / F.greatest(F.col(n), F.lit(1.0)) + F.lit(b) * w + F.lit(c)
    z = F.greatest(F.least(z, F.lit(60.0)), F.lit(-60.0))
    return sized.select(*[F.col(f"`{x}`") for x in names], (1 / (1 + F.exp(-z))).alias(out))
