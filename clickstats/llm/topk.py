"""Exact top-k inner products over norm-sorted vectors.

Vectors are rotated into the axes of their second-moment matrix (the SVD of
the data), so that most of an inner product lies in the first coordinates.
Candidates are processed by descending length in blocks. For a query with
k-th best score s, a block is skipped when |q| |c| < s for its longest
vector; in a block that is not, the sum over the first coordinates plus the
Cauchy-Schwarz bound of the rest, |q_rest| |c_rest|, prunes single vectors, in
steps: each takes in more coordinates and bounds less. What survives is scored
in exact integers. Every task starts from a true lower bound of s, the k-th best
score among ``SEED_ROWS`` vectors, so it prunes from its first block on.

The query set is a stated one. It is taken in chunks of bounded size; each
chunk is broadcast and the candidates are passed over in parallel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickstats.llm.tables import shuffle_partitions

#: Numbers in one broadcast chunk of queries (8 bytes each).
CHUNK_NUMBERS = 1 << 20
BLOCK_ROWS = 2048
_UNSET = -(1 << 62)
#: Coordinates of the partial sums, as shares of the dimension, step by step.
STEPS = (0.5, 0.625, 0.75, 0.8125, 0.875, 0.9375)
#: Vectors, by the smallest hash of the key, that give each query a first lower bound.
SEED_ROWS = 2048


def quantized(vectors: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(key, vec array<long>): floor(scale * x) of each component, as doubles; vectors that hold null, NaN or infinity are left out,
    null vectors and null keys too."""
    x = F.col("raw")
    wide = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("raw"))
    sound = x.isNotNull() & F.col("key").isNotNull() & F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return wide.where(sound).select("key", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("vec"))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def second_moments(vecs: DataFrame, dim: int) -> np.ndarray:
    """The dim x dim matrix of summed products over all vectors of that length."""

    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            m = _matrix(b.column(0), dim).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim), pa.int32()), pa.array(total.ravel())], names=["i", "v"])

    parts = vecs.where(F.size("vec") == dim).select("vec").mapInArrow(run, "i int, v double")
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()  # dim * dim numbers, whatever the table
    out = np.zeros(dim * dim)
    for r in rows:
        out[r["i"]] = r["v"]
    return out.reshape(dim, dim)


class _Best:
    """The k best (score, key) of each query so far; ties go to the smaller key."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _UNSET)
        self.key = np.full((n, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, q: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        if not len(q):
            return
        touched = np.unique(q)
        qs = np.concatenate([np.repeat(touched, self.k), q])
        ks = np.concatenate([self.key[touched].ravel(), key])
        ss = np.concatenate([self.score[touched].ravel(), score])
        order = np.lexsort((ks, -ss, qs))
        qs, ks, ss = qs[order], ks[order], ss[order]
        first = np.searchsorted(qs, touched)
        take = first[:, None] + np.arange(self.k)
        self.score[touched], self.key[touched] = ss[take], ks[take]


def seed_floors(q_int: np.ndarray, q_key: np.ndarray, s_int: np.ndarray, s_key: np.ndarray, k: int) -> np.ndarray:
    """For each query a number that its k-th best score is not below: the k-th best among the seeds, less what rounding may add."""
    out = np.full(len(q_key), -np.inf)
    if len(s_key) <= k:
        return out
    seeds = s_int.astype(np.float64).T
    for i in range(0, len(q_key), 1024):
        score = q_int[i:i + 1024].astype(np.float64) @ seeds
        score[q_key[i:i + 1024, None] == s_key[None, :]] = -np.inf
        kth = np.partition(score, -k, axis=1)[:, -k]
        out[i:i + 1024] = kth - 1 - 1e-9 * np.abs(np.where(np.isfinite(kth), kth, 0))
    return out


def rests(rot: np.ndarray, heads: list[int]) -> list[np.ndarray]:
    """The length of what lies beyond each head."""
    return [np.sqrt((rot[:, h:] ** 2).sum(1)) for h in heads]


def _search(best: _Best, low, q_int, q_key, q_rot, q_norm, q_rest, c_int, c_key, c_rot, heads: list[int]) -> int:
    """Offer a block of candidates, sorted by descending length, to all queries; how many pairs were scored exactly."""
    c_norm = np.sqrt((c_rot * c_rot).sum(1))
    c_rest = rests(c_rot, heads)
    # Scores are integers: the margin covers rounding in the bounds.
    need = np.maximum(low, np.where(best.floor() == _UNSET, -np.inf, best.floor() - 0.5))
    live = np.flatnonzero(q_norm * c_norm.max() >= need)
    scored = 0
    for i in range(0, len(live), 512):
        rows = live[i:i + 512]
        sums = q_rot[rows, :heads[0]] @ c_rot[:, :heads[0]].T
        at, cand = np.nonzero(sums + np.outer(q_rest[0][rows], c_rest[0]) >= need[rows][:, None])
        sums = sums[at, cand]
        for j in range(0, len(at), 1 << 18):
            a, c, part = rows[at[j:j + (1 << 18)]], cand[j:j + (1 << 18)], sums[j:j + (1 << 18)]
            for step in range(1, len(heads)):
                more = slice(heads[step - 1], heads[step])
                part = part + np.einsum("ij,ij->i", q_rot[a, more], c_rot[c, more])
                keep = part + q_rest[step][a] * c_rest[step][c] >= need[a]
                a, c, part = a[keep], c[keep], part[keep]
            s = np.einsum("ij,ij->i", q_int[a], c_int[c])
            scored += len(s)
            keep = (q_key[a] != c_key[c]) & (s >= best.floor()[a])
            best.add(a[keep], c_key[c[keep]], s[keep])
    return scored


def top_inner_products(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
                       scale: int = 256) -> DataFrame:
    """(query_id, rank, <key>, score): the ``k`` candidates with the highest integer inner products of each query.

    Queries are the rows where the column ``is_query`` holds, candidates all
    rows with another key; ties go to the smaller key, ranks start at 1, and
    fewer candidates than ``k`` are all returned. Vectors that are null, hold
    null or a number that is not finite, or have a null key take no part; a
    vector meets only vectors of its own length. Keys are whole numbers; rows
    with one key and different vectors are each a candidate, and each a query.
    """
    spark = vectors.sparkSession
    vecs = quantized(vectors, key, vector, scale)
    asked = quantized(vectors.where(is_query), key, vector, scale)
    out = None
    schema = f"query_id long, row_in long, {key} long, score long"
    dims = [r["d"] for r in vecs.groupBy(F.size("vec").alias("d")).count().collect() if r["d"] > 0]
    for dim in sorted(dims):  # one, in a table of embeddings
        axes = np.linalg.eigh(second_moments(vecs, dim))[1][:, ::-1].copy()
        heads = sorted({max(1, int(dim * share)) for share in STEPS})
        own = vecs.where(F.size("vec") == dim)
        norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        parts = shuffle_partitions(spark)
        # A round over the lengths: every task gets long and short vectors, and sorts its own.
        spread = own.repartition(parts, "key").sortWithinPartitions(norm.desc())
        per_chunk = max(1, CHUNK_NUMBERS // dim)
        queries = asked.where(F.size("vec") == dim)
        total = queries.count()
        chunks = max(1, -(-total // per_chunk))
        part = F.pmod(F.xxhash64("key"), F.lit(chunks))
        seeds = own.orderBy(F.xxhash64("key"), "key", "vec").limit(SEED_ROWS).toArrow()  # so many vectors, whatever the table
        s_key = seeds.column(0).to_numpy().astype(np.int64)
        s_int = np.array(seeds.column(1).to_pylist(), np.int64).reshape(-1, dim)
        for c in range(chunks):
            rows = queries.where(part == c).toArrow()
            if not rows.num_rows:
                continue
            q_key = rows.column(0).to_numpy().astype(np.int64)
            q_int = np.array(rows.column(1).to_pylist(), np.int64).reshape(-1, dim)
            shared = spark.sparkContext.broadcast((q_key, q_int, axes, seed_floors(q_int, q_key, s_int, s_key, k)))

            def run(batches, shared=shared, dim=dim, heads=heads, c=c):
                q_key, q_int, axes, low = shared.value
                q_rot = q_int @ axes
                q_norm, q_rest = np.sqrt((q_rot ** 2).sum(1)), rests(q_rot, heads)
                best = _Best(len(q_key), k)
                for b in batches:
                    for i in range(0, b.num_rows, BLOCK_ROWS):
                        piece = b.slice(i, BLOCK_ROWS)
                        c_int = _matrix(piece.column(1), dim)
                        c_key = piece.column(0).to_numpy().astype(np.int64)
                        _search(best, low, q_int, q_key, q_rot, q_norm, q_rest, c_int, c_key, c_int @ axes, heads)
                row, col = np.nonzero(best.score != _UNSET)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_key[row]), pa.array(row + (c << 32)), pa.array(best.key[row, col]), pa.array(best.score[row, col])],
                    names=["query_id", "row_in", key, "score"])

            found = spread.mapInArrow(run, schema)
            out = found if out is None else out.unionAll(found)
    if out is None:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    order = Window.partitionBy("query_id", "row_in").orderBy(F.desc("score"), F.col(key))
    ranked = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col(key), "score")
