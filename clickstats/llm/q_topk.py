"""Query of the exact top-k search, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.tables import load
from clickstats.llm.topk import top_inner_products


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50, against all others."""
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.vec::DOUBLE[], c.vec::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
