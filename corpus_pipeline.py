"""A training corpus from ``documents``: five stages, each an operator of ``clickstats.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. Null counts as an empty text, and
equal rows are rows of their own unless a stage says otherwise; an empty table
gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.decontaminate import drop_contaminated
from clickstats.llm.mixing import mix_sources
from clickstats.llm.ngram_join import keep_one_per_component
from clickstats.llm.q_mixing import BLOCK_ROWS, TARGET_WEIGHTS
from clickstats.llm.secret_scan import redact
from clickstats.llm.tables import load
from clickstats.llm.toxicity import fit_from_labels, score_texts
from clickstats.session import state_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go. A null or empty text has the score of the bias alone; a repeated row goes or
    stays with its like; an id with two texts or two labels: see ``toxicity.fit_from_labels``."""
    model = fit_from_labels(docs, load(spark, sf_dir, "labels"))
    scored = score_texts(docs, model, out="toxicity_score_")
    return scored.where(F.col("toxicity_score_") < 0.5).drop("toxicity_score_")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, equal rows included. Texts without words,
    null among them, are duplicates of nothing and stay."""
    return keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; texts without words stay. Rows that share an id are judged by their own text."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every row stays, a null text as null. ``n_chars`` follows the text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its place in the mix of sources (``ORDER BY slot, block_row``); a null source is one of the rest."""
    return mix_sources(docs, TARGET_WEIGHTS, block_rows=BLOCK_ROWS)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", near_duplicates),
    ("decontaminate", decontamination),
    ("secret_scan", secrets),
    ("mix_sources", mixture),
]

#: No SQL: the first stage trains a model. tests/llm/test_pipeline.py checks each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table; what a stage returns is written to the shared folder."""
    docs = load(spark, sf_dir, "documents")
    place = state_path(spark, f"corpus-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{place}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
