"""Registered queries against their DuckDB SQL on the smallest tables."""

import os
import sys

import pytest

from clickstats.llm.registered import LLM_ORACLE, LLM_QUERIES
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    from oracle_check import duck, rows_of
    df = LLM_QUERIES[name](spark, SF_SMALL)
    names = df.columns
    got = rows_of(names, [tuple(r) for r in df.collect()])
    cur = duck(SF_SMALL).execute(LLM_ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(names)
    assert rows_of(cols, cur.fetchall()) == got


def test_names():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_native_plans_run_no_python(spark):
    for name in ("op5_decontaminate", "op7_secret_scan", "op8_mix_sources"):
        plan = LLM_QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan, name
