"""Query of the quality model. No SQL: it is tested by its accuracy on held-out labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.quality import fit_from_labels, learns_from, score_texts
from clickstats.llm.tables import load


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, from a model that never saw the held-out labels."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_from_labels(docs, load(spark, sf_dir, "labels"))
    s = F.col("quality_score")
    return score_texts(docs, model).select("doc_id", (~learns_from()).alias("held_out"), s.alias("score"),
                                           F.when(s >= 0.5, 1).otherwise(0).alias("predicted"))
