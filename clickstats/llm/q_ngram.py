"""Query of the n-gram Jaccard join, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstats.llm.ngram_join import jaccard_components
from clickstats.llm.tables import load


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return jaccard_components(load(spark, sf_dir, "documents")).drop("row")


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, len(s) AS n FROM g), e AS (SELECT doc_id, unnest(s) AS x FROM g),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS m FROM n UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.v)
SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id FROM n JOIN r ON r.v = n.doc_id GROUP BY ALL
"""
