"""Each stage of the corpus pipeline against a plain version of its operator, on the small table with awkward rows added."""

import duckdb
import numpy as np

import corpus_pipeline
from clickstats.llm.q_decontaminate import OP5_SQL
from clickstats.llm.tables import load
from clickstats.llm.toxicity import bags, fit_from_labels
from conftest import SF_SMALL
from llm_data import COLUMNS, jaccard_components
from test_secrets_mix import brute


def plain_redaction(text):
    spans, out, at = brute(text), "", 0
    for s, _, e, _ in spans:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + (text or "")[at:] if spans else text


def test_stages_equal_plain_versions(spark):
    source = load(spark, SF_SMALL, "documents")
    awkward = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "password: hunter22 é", "en", None, 20), (-4, "  \n", "en", "s", 4)]
    first = source.collect()[0]
    source = source.unionByName(spark.createDataFrame([*awkward, tuple(first), (10**9, *first[1:])], source.schema)).checkpoint()
    rows = [tuple(r) for r in source.collect()]
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, source, SF_SMALL).checkpoint()
    model = fit_from_labels(source, load(spark, SF_SMALL, "labels"))
    score = {}
    for r in rows:
        (b, share), = bags([(r[1] or "").encode()])
        score[r] = model.score(np.array([(model.weight[b] * share).sum()]), np.array([1 if len(b) else 0]))[0]
    rows = [r for r in rows if score[r] < 0.5]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, rows)) and len(rows) < source.count()

    unique = stages["ngram_jaccard"](spark, kept, SF_SMALL).checkpoint()
    rows.sort()
    found = jaccard_components([r[1] for r in rows])
    rows = [r for i, r in enumerate(rows) if found[i][1] == i]  # rows are in the order of their ids
    assert sorted(map(repr, map(tuple, unique.collect()))) == sorted(map(repr, rows))

    clean = stages["decontaminate"](spark, unique, SF_SMALL).checkpoint()
    con = duckdb.connect()
    con.register("documents", unique.select("doc_id", "text").toPandas())
    con.register("benchmark", load(spark, SF_SMALL, "benchmark").toPandas())
    cur = con.execute(OP5_SQL)
    at = [d[0] for d in cur.description].index("doc_id")
    bad = {r[at] for r in cur.fetchall()}
    rows = [r for r in rows if r[0] not in bad]
    assert sorted(map(repr, map(tuple, clean.collect()))) == sorted(map(repr, rows)) and bad

    safe = stages["secret_scan"](spark, clean, SF_SMALL).checkpoint()
    assert safe.columns == COLUMNS
    rows = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src, _ in ((i, plain_redaction(t), a, b, c) for i, t, a, b, c in rows)]
    assert sorted(map(repr, map(tuple, safe.collect()))) == sorted(map(repr, rows))

    mixed = stages["mix_sources"](spark, safe, SF_SMALL)
    got = mixed.select(*COLUMNS, "slot", "block_row").collect()
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, rows))
    assert len({(r["slot"], r["block_row"]) for r in got}) == len(got)


def test_stages_of_an_empty_table(spark):
    docs = load(spark, SF_SMALL, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).checkpoint()
        assert docs.count() == 0, name
