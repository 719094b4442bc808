import random
import zlib

from pyspark.sql import functions as F

import corpus_pipeline
from clickstats.llm.decontaminate import benchmark_matches, drop_contaminated, simhash
from clickstats.llm.secret_scan import with_secret_spans
from clickstats.llm.toxicity import ToxicityModel, bags, fit_from_labels, gram_buckets, score_texts, train
from conftest import SF_SMALL
from llm_data import COLUMNS, WORD, docs

import numpy as np


def corpus(n=300):
    rnd = random.Random(9)
    vocab = [a + b for a in ("ba", "ke", "lo", "mi", "tu", "ro") for b in ("n", "rin", "sel", "tor", "dam", "pix", "vo")]
    rows, y = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 120))]
        y.append(i % 4 == 0)
        if y[-1]:
            w.insert(rnd.randrange(len(w)), rnd.choice(["scoundrel", "blockhead"]))
        rows.append(" ".join(w))
    return rows, [int(v) for v in y]


def test_model_learns_and_scores_misspellings(spark):
    rows, y = corpus()
    extra = ["the old scoundrell sat", "ban ker lo", None, "", "x" * 100_000, rows[0]]
    d = docs(spark, rows + extra, [*range(len(rows) + 5), None])
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(y)] + [(None, 1), (1, None), (5000, 1), (2, 7)], "doc_id long, toxic int")
    model = fit_from_labels(d, labels)
    out = {r["doc_id"]: r for r in score_texts(d, model).collect()}
    assert len(out) == len(rows) + 6 and score_texts(d, model).columns[:-1] == d.columns
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((out[i]["toxicity_score"] >= 0.5) == bool(y[i]) for i in held)
    assert right >= 0.95 * len(held)
    assert out[300]["toxicity_score"] > 0.5 > out[301]["toxicity_score"]
    assert out[302]["toxicity_score"] == out[303]["toxicity_score"] and 0 <= out[304]["toxicity_score"] <= 1
    # the batch form equals the plain sum over all n-grams of a text
    for i in (0, 7, 304):
        (b, share), = bags([(rows + extra)[i].encode()])
        want = model.score(np.array([(model.weight[b] * share).sum()]), np.array([1]))[0]
        assert abs(out[i]["toxicity_score"] - want) < 1e-4


def test_held_out_labels_are_never_read(spark):
    rows, y = corpus(120)
    d = docs(spark, rows)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(120)]
    a = fit_from_labels(d, spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int"))
    b = fit_from_labels(d, spark.createDataFrame([(i, 1 - v if h else v) for i, (v, h) in enumerate(zip(y, held))], "doc_id long, toxic int"))
    assert (a.weight == b.weight).all() and a.bias == b.bias


def test_repeated_ids_give_one_model_in_any_order(spark):
    """Two texts under an id, repeated and conflicting labels: two orders and partitionings give the same numbers."""
    rows, y = corpus(120)
    given = [*enumerate(rows), (4, "another text of four"), (4, rows[4]), (None, "no id"), (8, None)]
    labels = [*enumerate(y), (4, y[4]), (6, 1 - y[6]), (None, 1)]
    schema = "doc_id long, toxic int"
    a = fit_from_labels(docs(spark, [t for _, t in given], [i for i, _ in given]).repartition(2), spark.createDataFrame(labels, schema))
    given, labels = given[::-1], labels[::-1]
    b = fit_from_labels(docs(spark, [t for _, t in given], [i for i, _ in given]).repartition(5), spark.createDataFrame(labels, schema).repartition(3))
    assert (a.weight == b.weight).all() and a.bias == b.bias and a.weight.any()


def test_training_without_both_classes(spark):
    m = train([b"a b"], [0])
    assert m.score(np.zeros(1), np.zeros(1))[0] < 0.01 and isinstance(m, ToxicityModel)
    empty = fit_from_labels(docs(spark, [], []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert score_texts(docs(spark, [], []), empty).collect() == []
    assert gram_buckets(np.frombuffer(b" ab ", np.uint8))[0].tolist() == [0, 1]


def brute_leaks(rows, items):
    def shingles(w):
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])

    out = {}
    for d, t in enumerate(rows):
        w = WORD.findall((t or "").lower())
        for k, item in enumerate(items):
            iw = WORD.findall((item or "").lower())
            if not iw:
                continue
            width = min(5, len(iw))
            b = [tuple(iw[i:i + width]) for i in range(len(iw) - width + 1)]
            for s in range(max(1, len(w) - len(iw) + 1)):
                x = w[s:s + len(iw)]
                a = [tuple(x[i:i + width]) for i in range(len(x) - width + 1)]
                both = sum(min(a.count(g), b.count(g)) for g in set(a))
                either = len(a) + len(b) - both
                if both * 100 >= either * 80 and both / either > out.get((d, k), (0, 0))[0]:
                    out[(d, k)] = (both / either, s)
    assert shingles([]) == []
    return out


def leaks():
    rnd = random.Random(4)
    vocab = [a + b for a in "bdfgklmnprst" for b in ("a", "en", "or", "ish")]
    items = [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (30, 30, 17, 45, 8, 3)] + [None, "", "A  b\nc d e F g h"]
    rows = [None, "", "b c", "x " * 20_000]
    for i in range(40):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 80))]
        if i % 2:
            x = (items[i % 6] or "").split()
            if i % 3 == 0 and len(x) > 20:
                x[rnd.randrange(5, 15)] = "other"
            if i % 5 == 0 and len(x) > 20:
                x.pop(rnd.randrange(5, 15))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = x
        rows.append(" ".join(w))
    return rows + ["a B c d e f g h"], items


def test_leaks_equal_brute_force(spark):
    rows, items = leaks()
    it = spark.createDataFrame([(k, t, 1) for k, t in enumerate(items)], "item_id long, text string, m int")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in benchmark_matches(docs(spark, rows), it).collect()}
    want = brute_leaks(rows, items)
    assert got == want and len(want) > 10
    kept = drop_contaminated(docs(spark, rows + [rows[5]], [*range(len(rows)), None]), it)
    assert kept.columns == docs(spark, []).columns
    bad = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [i for i in range(len(rows)) if i not in bad]
    assert benchmark_matches(docs(spark, [], []), it).collect() == []
    assert benchmark_matches(docs(spark, rows), it.where("false")).collect() == []


def test_leaks_of_a_shuffled_benchmark_and_of_a_long_text(spark, monkeypatch):
    """A benchmark too large to broadcast gives the same rows; a text of 200,000 words is read in seconds."""
    import time

    from clickstats.llm import decontaminate
    rows, items = leaks()
    it = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    want = sorted(map(tuple, benchmark_matches(docs(spark, rows), it).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    plan = benchmark_matches(docs(spark, rows), it)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan
    assert sorted(map(tuple, benchmark_matches(docs(spark, rows), it).collect())) == want
    monkeypatch.undo()
    took = []
    for n in (20_000, 200_000):
        long = docs(spark, [" ".join(f"w{i % 5_003}" for i in range(n)) + " " + items[0]])
        t0 = time.time()
        assert [(r["item_id"], r["similarity"]) for r in benchmark_matches(long, it).collect()] == [(0, 1.0)]
        took.append(time.time() - t0)
    assert took[1] < 30 * max(took[0], 1)


def test_simhash_bits(spark):
    rng = random.Random(1)
    lists = [[rng.randrange(-2**63, 2**63) for _ in range(n)] for n in (1, 2, 7, 40, 300, 33_000)] + [[], [-1] * 31_999, [1 << 63 - 1] * 9]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, h array<long>").orderBy("i").select(
        simhash(F.col("h"))).collect()]
    for x, fp in zip(lists, got):
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in x) > len(x))
        assert fp & (2**64 - 1) == want


def test_pipeline_stages(spark):
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontaminate", "secret_scan", "mix_sources"]
    docs_now, before = source, source.count()
    for name, stage in corpus_pipeline.STAGES:
        docs_now = stage(spark, docs_now, SF_SMALL).checkpoint()
        if name != "mix_sources":
            assert docs_now.columns == COLUMNS, name
        n = docs_now.count()
        assert 0 < n <= before and (name not in ("secret_scan", "mix_sources") or n == before), name
        before = n
        if name == "secret_scan":
            assert with_secret_spans(docs_now).where("size(secret_spans) > 0").count() == 0
            assert docs_now.where("n_chars <> length(text)").count() == 0
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs_now.collect()}
