import random
import zlib

import numpy as np
from clickstats.llm import quality
from clickstats.llm.q_quality import op11_quality
from clickstats.llm.tables import load
from conftest import SF_MID
from llm_data import docs

LABELS = "doc_id long, quality int"


def corpus(n=240, seed=4):
    rnd = random.Random(seed)
    vocab = [rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") + rnd.choice(["n", "r", "sh", "é"]) for _ in range(80)]
    rows, y = [], []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 300))]
        y.append(int(rnd.random() < .7))
        rows.append(" ".join(words) if y[-1] else " | ".join(w.upper() + "$$" for w in words))
    return rows, y


def learnt(i):
    return zlib.crc32(str(i).encode()) % 3 != 1


def test_model_tells_unseen_texts_apart(spark):
    rows, y = corpus()
    d = docs(spark, [*rows, None, "", "x " * 60_000], [*range(240), 1000, None, 1001])
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(y)], LABELS)
    model = quality.fit_from_labels(d, labels)
    out = quality.score_texts(d, model)
    assert out.columns == [*d.columns, "quality_score"] and out.count() == 243
    assert quality.score_texts(out, model).columns == out.columns
    got = {r["doc_id"]: r["quality_score"] for r in out.collect()}
    held = [i for i in range(240) if not learnt(i)]
    assert sum((got[i] >= .5) == (y[i] == 1) for i in held) >= .97 * len(held) and len(held) > 50
    assert got[1000] == got[None] and all(0 <= s <= 1 for s in got.values())


def test_fit_reads_each_id_once_in_any_order(spark):
    """Repeated ids, conflicting labels and held-out labels: two orders and partitionings give one model."""
    rows, y = corpus()
    more = [(5, "another text of five"), (5, rows[5]), (None, "no id"), (9, None)]
    given = [*enumerate(rows), *more]
    labels = [*enumerate(y), (7, 1 - y[7]), (5, y[5]), (None, 1), (999, 1), (11, None), (13, 2)]
    a = quality.fit_from_labels(docs(spark, [t for _, t in given], [i for i, _ in given]).repartition(2), spark.createDataFrame(labels, LABELS))
    rnd = random.Random(1)
    rnd.shuffle(given)
    rnd.shuffle(labels)
    b = quality.fit_from_labels(docs(spark, [t for _, t in given], [i for i, _ in given]).repartition(7), spark.createDataFrame(labels, LABELS).repartition(3))
    assert a == b
    flipped = [(i, v if i is None or learnt(i) or v not in (0, 1) else 1 - v) for i, v in labels]
    assert quality.fit_from_labels(docs(spark, [t for _, t in given], [i for i, _ in given]), spark.createDataFrame(flipped, LABELS)) == a


def test_scores_equal_compressing_every_block(spark):
    import zstandard
    rows, y = corpus(80)
    rows[3] = rows[3] * 40
    d = docs(spark, rows)
    model = quality.fit_from_labels(d, spark.createDataFrame(list(enumerate(y)), LABELS))
    make = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(x), write_content_size=False, write_checksum=False,
                                     write_dict_id=False) for x in (model.good, model.bad)]

    def size(c, t):
        return sum(len(c.compress(t[i:i + quality.BLOCK])) - len(c.compress(b"")) for i in range(0, len(t), quality.BLOCK))

    raw = [t.encode() for t in rows]
    want = model.score(np.array([size(make[1], t) - size(make[0], t) for t in raw]), np.array([len(t) for t in raw]))
    got = {r["doc_id"]: r["quality_score"] for r in quality.score_texts(d, model).collect()}
    assert np.allclose([got[i] for i in range(len(rows))], want)


def test_without_labels_or_rows(spark):
    d, none = docs(spark, ["a b c", None]), spark.createDataFrame([], LABELS)
    share = quality.fit_from_labels(d, none)
    assert [r["quality_score"] for r in quality.score_texts(d, share).collect()] == [.5, .5]
    one = quality.fit_from_labels(docs(spark, ["a b c"] * 40), spark.createDataFrame([(i, 1) for i in range(40)], LABELS))
    assert all(r["quality_score"] > .5 for r in quality.score_texts(d, one).collect())
    assert quality.score_texts(docs(spark, [], []), share).collect() == []


def test_held_out_accuracy(spark):
    label = {r["doc_id"]: r["quality"] for r in load(spark, SF_MID, "labels").collect()}
    rows = [r for r in op11_quality(spark, SF_MID).collect() if r["held_out"] and r["doc_id"] in label]
    assert all(r["held_out"] == (not learnt(r["doc_id"])) for r in rows)
    good = [r["predicted"] for r in rows if label[r["doc_id"]] == 1]
    bad = [r["predicted"] for r in rows if label[r["doc_id"]] == 0]
    assert sum(good) >= .95 * len(good) and sum(bad) <= .2 * len(bad) and len(bad) >= 10
