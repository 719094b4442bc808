"""Query of the benchmark decontamination, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstats.llm.decontaminate import benchmark_matches
from clickstats.llm.tables import load


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the best window."""
    found = benchmark_matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "similarity")


OP5_SQL = r"""
WITH src AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (
  SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM src
), s AS (
  SELECT side, id, len(ws) AS n, CASE WHEN len(ws) < 5 THEN []
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END AS sh FROM w
), i AS (SELECT id AS item_id, n AS m, sh AS ish FROM s WHERE side = 'i' AND n >= 5),
ix AS (SELECT item_id, m, unnest(list_distinct(ish)) AS x FROM i),
dx AS (SELECT id AS doc_id, n, unnest(range(0, len(sh))) AS p, unnest(sh) AS x FROM s WHERE side = 'd'),
hit AS (SELECT doc_id, item_id, m, n, p FROM dx JOIN ix USING (x)),
win AS (
  SELECT DISTINCT doc_id, item_id, m, unnest(range(greatest(0, p - m + 5), least(p, greatest(0, n - m)) + 1)) AS start FROM hit
), two AS (
  SELECT win.doc_id, win.item_id, start, d.sh[start + 1:start + win.m - 4] AS a, i.ish AS b
  FROM win JOIN s d ON d.side = 'd' AND d.id = win.doc_id JOIN i ON i.item_id = win.item_id
), c AS (
  SELECT doc_id, item_id, start, len(a) + len(b) AS t, list_sum(list_transform(list_intersect(a, b), lambda x:
    least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))))) AS common FROM two
), ok AS (SELECT *, common / (t - common)::DOUBLE AS similarity FROM c WHERE common * 100 >= (t - common) * 80)
SELECT doc_id, item_id, min_by(start, (-similarity, start))::INTEGER AS start, max(similarity) AS similarity
FROM ok GROUP BY doc_id, item_id
"""
