import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstats.llm import ngram_join
from clickstats.llm.components import connected_components
from clickstats.llm.ngram_join import divide_skip_links, jaccard_components, keep_one_per_component
from llm_data import docs, jaccard_components as brute, texts


@pytest.mark.parametrize("block,pair_list", [(1 << 20, 48), (150, 2), (400, 3)])
def test_components_equal_brute_force(spark, monkeypatch, block, pair_list):
    """The small blocks send the near copies through hub groups of many blocks, searched a second time across blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(ngram_join, "PAIR_LIST", pair_list)
    rows = texts(seed=5, n=60)
    want = brute(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs(spark, rows)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows)


def test_repeated_rows_nulls_and_empty_table(spark):
    text = "a b c d e f g h i j"
    out = jaccard_components(docs(spark, [text, text, text, None, "x y", None], [4, 4, None, 2, None, None])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in out if r["n_shingles"]) == [
        (False, 4, 6, 4), (False, 4, 6, 4), (True, 0, 1, None), (True, 0, 6, 4)]
    assert {(r["doc_id"], r["component_id"]) for r in out if not r["n_shingles"]} == {(2, 2), (None, None)}
    assert jaccard_components(docs(spark, [], [])).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = texts(seed=6, n=40)
    want = brute(rows)
    kept = keep_one_per_component(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (n, c) in want.items() if n == 0 or c == i}


def test_divide_skip_equals_all_pairs():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.r_[s[1:], [np.uint64(99)]]) for s in sets if len(s) > 12]

    def roots(links):
        p = list(range(len(sets)))

        def find(x):
            while p[x] != x:
                x = p[x]
            return x
        for a, b in links:
            p[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(sets))]

    pairs = [(i, j) for i in range(len(sets)) for j in range(i) for c in [len(np.intersect1d(sets[i], sets[j]))]
             if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c)]
    assert roots(divide_skip_links(sets)) == roots(pairs) and pairs


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_without_an_id_meet_only_their_own_classes(spark):
    """Every wanted class joins the texts by id and text hash: k texts without an id give k rows, not k times k."""
    rows = [f"one text {i} of many that have no id {i}" for i in range(50)]
    texts = docs(spark, rows, [None] * 50).select("doc_id", "text", F.xxhash64("text").alias("row"))
    wanted = texts.select("doc_id", "row", F.lit(1).cast("long").alias("grp"), F.lit(0).cast("long").alias("cls"),
                          F.lit(True).alias("asks"), F.lit(0).cast("long").alias("comp"))
    seen = spark.sparkContext.accumulator(0)
    pair = ngram_join._each_set

    def counted(batches, column):
        for b in batches:
            seen.add(b.num_rows)
            yield from pair([b], column)

    ngram_join._each_set = counted
    try:
        assert ngram_join._sets_of(texts, wanted, ["grp"]).collect() == []  # class 0 is nobody's
    finally:
        ngram_join._each_set = pair
    assert seen.value == 50
