"""Query of the source mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstats.llm.mixing import mix_sources
from clickstats.llm.tables import load

#: Target weights in hundredths: the hot source is held to 24, some sources are raised.
TARGET_WEIGHTS = {"src0": 24, **{f"src{i}": 4 + (i % 2) - (i % 10 == 0) * 1 for i in range(1, 20)}}
BLOCK_ROWS = 64


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule of every document of the corpus in the mix."""
    docs = load(spark, sf_dir, "documents")
    mixed = mix_sources(docs, TARGET_WEIGHTS, block_rows=BLOCK_ROWS)
    return mixed.select("doc_id", "source", "mix_source", "block", "block_row", "release", "deadline", "slot")
