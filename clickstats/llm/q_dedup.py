"""Queries of the two substring dedups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstats.llm.phrase_dedup import remove_repeated_phrases
from clickstats.llm.suffix_dedup import remove_repeated_bytes
from clickstats.llm.tables import load


def op2_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 13-word passages of earlier documents."""
    return remove_repeated_phrases(load(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier documents."""
    return remove_repeated_bytes(load(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), m AS (SELECT x, min(doc_id) AS o FROM win GROUP BY x),
hit AS (
  SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i FROM win JOIN m USING (x) WHERE o < doc_id), range(13) t(k)
), word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
win AS (
  SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS x FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS i FROM b)
), m AS (SELECT x, min(doc_id) AS o FROM win GROUP BY x),
hit AS (
  SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i FROM win JOIN m USING (x) WHERE o < doc_id), range(50) t(k)
), byte AS (SELECT doc_id, p, substr(h, 2 * p - 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(1, n + 1)) AS p FROM b)),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(x, '' ORDER BY p) AS t FROM byte ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id
), runs AS (
  SELECT doc_id, count(*) AS n_spans FROM (SELECT doc_id, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM hit)
  WHERE gap IS NULL OR gap > 1 GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, (n - coalesce(n_kept, 0))::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
