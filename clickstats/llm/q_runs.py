"""Query of the periodic runs. No SQL: it is tested against a brute-force search."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstats.llm.periodic_runs import word_runs
from clickstats.llm.tables import load


def looped_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a document whose tail repeats, for every tenth checksum of an id; None for the others."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document: how many, the strongest one, and the text without the repeats."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = word_runs(docs, key="doc_id", rewrite=looped_tail)
    runs = F.col("word_runs")
    # By exact length / period; of equal ones the first, since runs are sorted by start, then period.
    best = F.reduce(runs, F.element_at(runs, 1), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    found = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), F.when(F.size(runs) > 0, best).alias("best"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
