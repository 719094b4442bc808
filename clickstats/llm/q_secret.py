"""Query of the secret scan, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.secret_scan import (
    RULES, Rule, _KEY_END, _KEY_HEADER, _KEY_LAST, _KEY_TOKEN, span_digest, with_secret_spans)
from clickstats.llm.tables import load

BASE_KINDS = ("assign", "access", "hex")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and spans, found through the trigram index."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secret_spans(docs)
    s = F.col("secret_spans")

    def count(kind):
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE_KINDS],
                        F.sha2(span_digest(s, BASE_KINDS), 256).alias("base_sha256"), span_digest(s).alias("spans"))


def _sql_leading(parts: str, pattern: str, sep: str) -> str:
    bad = f"list_position(list_transform({parts}, lambda x: regexp_matches(x, '{pattern}')), false)"
    return f"array_to_string(CASE WHEN coalesce({bad}, 0) > 0 THEN {parts}[1:{bad} - 1] ELSE {parts} END, {sep})"


def _sql_key_tails(pieces: str) -> str:
    """The private-key tail of each piece of a list, in steps that keep one value per piece."""
    heads = f"list_transform({pieces}, lambda p: struct_pack(p := p, h := {_sql_leading('string_split(p, chr(10))', _KEY_HEADER, 'chr(10)')}))"
    body = f"list_transform({heads}, lambda a: struct_pack(p := a.p, h := length(a.h), b := substring(a.p, length(a.h) + 1)))"
    tokens = _sql_leading("string_split_regex(a.b, '[\\x20\\t\\r\\n]')", _KEY_TOKEN, "' '")
    lead = f"list_transform({body}, lambda a: struct_pack(p := a.p, h := a.h, b := a.b, n := length(rtrim({tokens}))))"
    last = f"rtrim(translate(regexp_extract(substring(a.b, a.n + 1), '{_KEY_LAST}', 0), chr(9) || chr(13) || chr(10), '   '))"
    end = f"length(regexp_extract(a.p, '{_KEY_END}', 0))"
    return f"""list_transform({lead}, lambda a: CASE WHEN {end} > 0 THEN {end}
      WHEN a.n > 0 THEN a.h + a.n + length({last}) ELSE 0 END)"""


def _sql_spans(rank: int, rule: Rule) -> str:
    p = rule.pattern.replace("'", "''")
    more = _sql_key_tails("g[2:]") if rule.tail else "list_transform(m, lambda x: 0)"
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind,
        unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(g[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS s,
        unnest(list_transform(m, lambda x: length(x))) AS n, unnest({more}) AS more,
        unnest(list_transform(v, lambda x: length(x) >= {rule.least})) AS ok
      FROM (SELECT doc_id, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', 0) AS m,
            regexp_extract_all(text, '{p}', {rule.group}) AS v FROM documents WHERE text IS NOT NULL) WHERE len(m) > 0"""


OP7_SQL = f"""
WITH found AS (
  {" UNION ALL ".join(_sql_spans(i, r) for i, r in enumerate(RULES))}
), kept AS (
  SELECT doc_id, rank, kind, s, kind || ':' || s::BIGINT || ':' || (s + n + more)::BIGINT AS d FROM found WHERE ok
), per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    coalesce(string_agg(d, ',' ORDER BY s, rank) FILTER (WHERE rank < 3), '') AS base,
    string_agg(d, ',' ORDER BY s, rank) AS spans FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""
