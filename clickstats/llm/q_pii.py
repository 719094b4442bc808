"""Query of the personal data finder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.pii import KINDS, find_personal_data
from clickstats.llm.secret_scan import span_digest
from clickstats.llm.tables import load


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: strict matches and what bootstrapped patterns add."""
    found = find_personal_data(load(spark, sf_dir, "documents").select("doc_id", "text"))
    seeds = F.filter("pii_spans", lambda x: x["seed"])

    def count(kind):
        return F.size(F.filter(seeds, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(span_digest(seeds), 256).alias("base_sha256"),
                        span_digest(F.col("pii_spans")).alias("spans"))
