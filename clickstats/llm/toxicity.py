"""Toxicity scores from subword embeddings.

A text is the average of the embeddings of its character n-grams (bytes, 3 to
6, inside words, with an edge), put through a two-class linear softmax.
Embeddings and softmax are trained together in numpy by gradient steps with a
rate per n-gram. A misspelt word shares most of its n-grams with the word.

Training takes a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` of each
class, chosen by a hash of the id), so its cost does not grow with the corpus;
each class is weighed back to its share among all labelled rows. Scoring runs
over every whole text in Arrow batches. There the trained network is a table
with one number per n-gram bucket, since both layers are linear.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickstats.llm import textops
from clickstats.llm.tables import fresh, text_column

#: Labelled rows of each class that training reads at most. A documented bound; scoring has none.
SAMPLE_PER_CLASS = 2000
N_GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIM = 8
#: Bytes of text that one numpy step works on; a longer text is summed over steps.
STEP_BYTES = 1 << 21

#: Word bytes: letters, digits and everything beyond ASCII. The rest separates words.
_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
for _a, _z in ((48, 57), (65, 90), (97, 122)):
    _WORD[_a:_z + 1] = True


def gram_buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, bucket) of every n-gram of lower-cased ``data``.

    An n-gram lies in one word and may take in the separator on one side,
    which marks the word's edge; a text's ends count as separators if given so.
    """
    word = _WORD[data]
    clean = np.where(word, textops.lower_ascii(data), np.uint8(32)).astype(np.uint64)
    inside = np.concatenate([[0], np.cumsum(word)])
    at, out = [], []
    roll = clean.copy()
    for n in range(2, max(N_GRAMS) + 1):
        if len(data) < n:
            break
        roll = roll[:len(data) - n + 1] * np.uint64(0x100000001B3) + clean[n - 1:]
        if n not in N_GRAMS:
            continue
        m = len(data) - n + 1
        core = inside[n - 1:n - 1 + m] - inside[1:1 + m]  # word bytes between first and last
        ok = np.flatnonzero((core == n - 2) & (word[:m] | word[n - 1:]))
        at.append(ok)
        out.append((textops.mix(roll[ok] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int32))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(at), np.concatenate(out)


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one separator before each and one after the last, and where each text begins."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    where = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    out[where] = data
    return out, offsets + np.arange(n + 1)


def bags(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text; the shares of a text sum to 1."""
    out = []
    for t in texts:
        data = np.frombuffer(b" " + t + b" ", np.uint8)
        b, c = np.unique(gram_buckets(data)[1], return_counts=True)
        out.append((b.astype(np.int32, copy=False), (c / max(1, c.sum())).astype(np.float32)))
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """``weight[bucket]``: the difference of the two logits that an n-gram adds; ``bias``: of an empty text."""

    weight: np.ndarray
    bias: float

    def score(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = self.bias + sums / np.maximum(counts, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def train(texts: list[bytes], labels: list[int], class_weight: tuple[float, float] = (1.0, 1.0), epochs: int = 10,
          batch: int = 32, rate: float = 0.7, seed: int = 7) -> ToxicityModel:
    """Embeddings and softmax, jointly, on the given texts. Without texts of both classes: their share alone decides."""
    y = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1.0 / DIM, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 1.0, (2, DIM)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weigh = np.asarray(class_weight, np.float32)
    total = np.array([(weigh[c] * (y == c).sum()) for c in (0, 1)])
    if (y == 0).all() or (y == 1).all():
        share = float(total[1] / total.sum()) if len(y) else 0.0
        return ToxicityModel(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    bag = bags(texts)
    seen_e = np.full(BUCKETS, 1e-8, np.float32)
    seen_s, seen_b = np.full((2, DIM), 1e-4, np.float32), np.full(2, 1e-4, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            idx = np.concatenate([bag[i][0] for i in rows])
            val = np.concatenate([bag[i][1] for i in rows])
            size = np.array([len(bag[i][0]) for i in rows])
            doc = np.repeat(np.arange(len(rows)), size)
            # Average embedding of each text: shares times embeddings, summed by text.
            mean = np.stack([np.bincount(doc, emb[idx, d] * val, len(rows)) for d in range(DIM)], 1).astype(np.float32)
            z = mean @ soft.T + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weigh[y[rows]][:, None]
            g_soft, g_bias = p.T @ mean / len(rows), p.mean(0)
            back = p @ soft  # gradient of each text's average
            used, inv = np.unique(idx, return_inverse=True)
            grad = np.stack([np.bincount(inv, val * back[doc, d]) for d in range(DIM)], 1).astype(np.float32) / len(rows)
            seen_e[used] += (grad ** 2).mean(1)
            emb[used] -= step * grad / np.sqrt(seen_e[used])[:, None]
            seen_s += g_soft ** 2
            seen_b += g_bias ** 2
            soft -= step * 0.2 * g_soft / np.sqrt(seen_s)
            bias -= step * 0.2 * g_bias / np.sqrt(seen_b)
    return ToxicityModel((emb @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]))


def learns_from(key: str = "doc_id"):
    """True for the rows whose labels may be learnt from: crc32 of the id as text is not a multiple of 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit_from_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                    per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """A model from the labelled rows that may be learnt from.

    Rows without an id, a text row or a 0/1 label are left out, and so are ids
    with both labels; of several texts under one id the one with the smallest
    hash is read. Of each class the ``per_class`` rows with the smallest hash of
    the id are taken (all, if fewer); the class weights restore the shares among
    all rows that qualify. The model does not depend on the order or the
    partitions of the rows. The sample is bounded, so one task trains on it; the
    driver gets the trained numbers only.
    """
    lab = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y"))
    lab = lab.where(learns_from("id") & F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
    lab = lab.where("y = z").select("id", "y")
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [lab.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    chosen = picked[0].unionAll(picked[1])  # at most 2 * per_class rows of two numbers
    texts = docs.select(F.col(key).alias("doc"), text_column(text).alias("t"))
    rows = texts.join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    rows = rows.groupBy("id", "y").agg(F.min_by("t", F.struct(F.xxhash64("t"), F.col("t"))).alias("t"))
    every = max(1, sum(n.values()))

    def run(batches):
        rows = sorted(((r["id"], r["y"], r["t"]) for b in batches for r in b.to_pylist()), key=lambda r: r[0])
        y = [r[1] for r in rows]
        weight = tuple(n.get(c, 0) / every * len(y) / max(1, y.count(c)) for c in (0, 1))
        model = train([r[2] for r in rows], y, weight)
        yield pa.RecordBatch.from_pydict({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    sample = rows.select("id", "y", F.col("t").cast("binary").alias("t")).coalesce(1)
    model = sample.mapInArrow(run, "weight binary, bias double").first()
    if model is None:  # an empty table has no task
        return train([], [])
    return ToxicityModel(np.frombuffer(bytes(model["weight"]), np.float32), model["bias"])


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "toxicity_score") -> DataFrame:
    """``docs`` with ``out``: the score of each whole text, 0 to 1. Null and empty texts get the bias alone.

    A column called ``out`` in ``docs`` is replaced; every other column stays.
    """
    (t,) = fresh(docs, "score_text")
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # BUCKETS numbers, whatever the corpus
    names = [c for c in docs.columns if c != out]
    plain = docs.select(*[F.col(f"`{c}`") for c in names], text_column(text).alias(t))
    schema = StructType([*plain.drop(t).schema.fields, StructField(out, DoubleType())])

    def run(batches):
        m = ToxicityModel(*shared.value)
        for b in batches:
            data, off = textops.column_buffer(b.column(len(names)))
            sums, counts = np.zeros(b.num_rows), np.zeros(b.num_rows)
            for i, z in textops.steps(off, STEP_BYTES):
                buf, begin = _padded(data[off[i]:off[z]], off[i:z + 1] - off[i])
                for a in range(0, len(buf), 4 * STEP_BYTES):  # only a longer text takes several turns
                    at, bucket = gram_buckets(buf[a:a + 4 * STEP_BYTES + max(N_GRAMS) - 1])
                    new = at < 4 * STEP_BYTES  # each n-gram in the turn in which it starts
                    at, bucket = at[new] + a, bucket[new]
                    doc = np.searchsorted(begin, at, side="right") - 1
                    doc = np.minimum(doc, z - i - 1)
                    sums[i:z] += np.bincount(doc, m.weight[bucket], z - i)
                    counts[i:z] += np.bincount(doc, minlength=z - i)
            cols = [b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(m.score(sums, counts))], names=[*names, out])

    return plain.mapInArrow(run, schema)
