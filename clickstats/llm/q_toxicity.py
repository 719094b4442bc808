"""Query of the toxicity model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.tables import load
from clickstats.llm.toxicity import fit_from_labels, learns_from, score_texts


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, from a model that never saw the held-out labels."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_from_labels(docs, load(spark, sf_dir, "labels"))
    s = F.col("toxicity_score")
    return score_texts(docs, model).select("doc_id", (~learns_from()).alias("held_out"), s.alias("score"),
                                           F.when(s >= 0.5, 1).otherwise(0).alias("predicted"))
