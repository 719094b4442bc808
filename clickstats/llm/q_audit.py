"""Query of the filter interaction audit, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.filter_audit import audit_orders, failure_counts, few_words, holds_any, many_capitals, repeated_words
from clickstats.llm.tables import load

FILTERS = {"A": few_words(200), "B": repeated_words(50), "C": many_capitals(3), "D": holds_any("#$%&*|")}
REPEATS = "E"


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five quality filters over all documents: what each removes, per language and in each of the 120 orders."""
    marks = ("good", "toxic")
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"), "toxic")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counts = failure_counts(docs, FILTERS, REPEATS, labels=labels, marks=marks)
    return audit_orders(counts, "".join([*FILTERS, REPEATS]), marks)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), e AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
      coalesce(first_id < d.doc_id, false)] AS fail, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d JOIN e USING (t) LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (SELECT part, fail, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM f GROUP BY ALL),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM range(1, 6) a(i), range(1, 6) b(i), range(1, 6) c(i), range(1, 6) d(i), range(1, 6) e(i)
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS (
  SELECT part, o, step, n, g, x, fail[o[step]] AS own, list_bool_or(list_transform(o[1:step - 1], lambda j: fail[j])) AS gone,
    len(list_filter(fail, lambda y: y)) AS k
  FROM c, o, range(1, 6) t(step)
), r AS (SELECT * REPLACE (coalesce(gone, false) AS gone) FROM s)
SELECT part, list_aggregate(list_transform(o, lambda j: substr('ABCDE', j, 1)), 'string_agg', '') AS filter_order, step::INTEGER AS step,
  coalesce(sum(n) FILTER (WHERE NOT own AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE own AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE own AND k = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(g) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(x) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(k, 1)) FILTER (WHERE own), 0)::BIGINT AS shapley
FROM r GROUP BY part, o, step
"""
