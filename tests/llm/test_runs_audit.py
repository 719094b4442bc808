import random
import zlib

import numpy as np
from clickstats.llm.filter_audit import audit_orders, failure_counts, few_words, holds_any, many_capitals, repeated_words, repeats_earlier_text
from clickstats.llm.periodic_runs import automaton_runs, repeated_stretches, runs_of, word_runs
from clickstats.llm.q_runs import looped_tail, op13_periodic_runs
from clickstats.llm.q_audit import FILTERS, op12_filter_audit
from clickstats.llm.tables import load
from conftest import SF_SMALL
from itertools import permutations
from llm_data import SCHEMA, WORD, docs, sha, texts


def brute_runs(w):
    """All runs by sliding every period along the words."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if size >= max(6, 4 * q) and not any(all(w[j] == w[j + r] for j in range(s, s + size - r)) for r in range(1, q)):
                out.append((s, size, q))
    return sorted(out)


def random_words(rnd):
    k, n = rnd.choice([1, 2, 3, 5]), rnd.randrange(0, 80)
    w = [rnd.randrange(k) for _ in range(n)]
    if rnd.random() < .5 and n > 8:
        p, a = rnd.randrange(1, 9), rnd.randrange(n)
        w = [w[i] if i < a else w[min(n - 1, a + (i - a) % p)] for i in range(n)]
    return w


def test_automaton_equals_sliding_every_period():
    rnd = random.Random(5)
    for _ in range(1500):
        w = random_words(rnd)
        assert sorted(automaton_runs(w)) == brute_runs(w), w
        assert runs_of(np.array(w, np.int64)) == brute_runs(w), w
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for w in (b, [0] * 300, [i % 37 for i in range(300)], [0] * 20 + [1] + [0] * 20, [0, 1] * 30 + [0, 0] * 30):
        assert runs_of(np.array(w, np.int64)) == brute_runs(w)


def test_runs_lie_whole_in_one_stretch():
    rnd = random.Random(6)
    for _ in range(300):
        w = [rnd.randrange(50) for _ in range(40)] + random_words(rnd) + [rnd.randrange(50) for _ in range(40)]
        stretches = repeated_stretches(np.array(w, np.int64))
        for s, n, _ in brute_runs(w):
            assert any(a <= s and s + n <= z for a, z in stretches)


def test_steps_grow_with_the_words():
    """A hot loop: 100,000 equal words and 100,000 words of period 997 take seconds, not a square of that."""
    for w in ([7] * 100_000, [i % 997 for i in range(100_000)]):
        assert automaton_runs(w) == [(0, 100_000, max(w) + 1 if w[0] == 0 else 1)]


def expected_row(doc_id, text):
    words = WORD.findall(text or "")
    order = looped_tail(doc_id, len(words))
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    else:
        assert order is None
    runs = brute_runs(words)
    gone = {j for s, n, q in runs for j in range(s + q, s + n)}
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(" ".join(w for j, w in enumerate(words) if j not in gone).encode()))


def test_runs_query_equals_brute_force(spark, scratch):
    rows = [*texts(n=30), "a " * 5, "a " * 6, "b\x0bb\x0cb\tb\nb\rb", "x\xa0y " * 9, "a b a b a b a b c " * 6, "é ü " * 8]
    ids = [*range(len(rows) - 2), None, 3]
    data = docs(spark, rows, ids)
    data.repartition(3).write.parquet(f"{scratch}/documents.parquet")
    got = sorted((tuple(r) for r in op13_periodic_runs(spark, scratch).collect()), key=repr)
    assert got == sorted((expected_row(i, t) for i, t in zip(ids, rows)), key=repr)
    assert any(r[1] > 1 for r in got)
    out = word_runs(data)
    assert out.columns == [*data.columns, "word_runs", "word_count", "collapsed_text"]
    assert word_runs(out).columns == out.columns  # its own columns are replaced
    assert word_runs(data.where("false")).collect() == []


def test_runs_query_on_the_small_tables(spark):
    d = load(spark, SF_SMALL, "documents").select("doc_id", "text").where("length(text) < 4000").collect()
    got = {r["doc_id"]: tuple(r) for r in op13_periodic_runs(spark, SF_SMALL).collect()}
    for r in d:
        assert got[r["doc_id"]] == expected_row(r["doc_id"], r["text"])


AUDIT_TEXTS = [None, "", "  ", "word " * 250, "word " * 250, "A B C d e f", "100% true", "plain words only", "plain words only", "plain words only",
               " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(300)), " ".join(f"W{i}" for i in range(300)) + " #", ""]


def brute_audit(rows):
    """rows: (doc_id, text, lang, good, toxic) -> {(part, order, step): counts}, by walking every document through every order."""
    fails = []
    for i, t, _, _, _ in rows:
        t = t or ""
        w = WORD.findall(t)
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                      "D": any(c in "#$%&*|" for c in t), "E": i is not None and any((o[1] or "") == t and o[0] is not None and o[0] < i for o in rows)})
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r, f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(r, f) for r, f in left if f[x]]
                left = [(r, f) for r, f in left if not f[x]]
                total[x] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f[x] for _, f in mine) - len(gone),
                                                   sum(f[x] and sum(f.values()) == 1 for _, f in mine), sum(r[3] for r, _ in gone), sum(r[4] for r, _ in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def test_audit_equals_walking_every_order(spark, scratch):
    rnd = random.Random(2)
    n = len(AUDIT_TEXTS) * 2
    rows = [(rnd.choice([i, i, i, 3, None]), AUDIT_TEXTS[i % len(AUDIT_TEXTS)], rnd.choice(["en", "de", None, ""])) for i in range(n)]
    rows += rows[:3]  # repeated rows are documents too
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, n, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    spark.createDataFrame([(i, t, lg, "s", 0, 1, "r", 2.0, "k") for i, t, lg in rows], SCHEMA).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    want = brute_audit([(i, t, lg, i in good, i in toxic) for i, t, lg in rows])
    got = {(r["part"], r["filter_order"], r["step"]): list(r[3:]) for r in op12_filter_audit(spark, scratch).collect()}
    assert got == want


def test_repeats_of_large_groups_and_without_ids(spark, monkeypatch):
    monkeypatch.setattr("clickstats.llm.filter_audit.LOT_ROWS", 7)
    rows = ["same text"] * 200 + ["other"] * 3 + [None, ""]
    ids = [*range(100, 300), 5, 5, None, 7, 6]
    d = docs(spark, rows, ids)
    got = repeats_earlier_text(d)
    assert got.columns == d.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [7, *range(101, 300)]
    assert repeats_earlier_text(d.where("false")).count() == 0


def test_audit_without_rows_or_labels(spark):
    d = docs(spark, [], [])
    assert audit_orders(failure_counts(d, FILTERS, "E"), "ABCDE").collect() == []
    one = failure_counts(docs(spark, ["x"]), {"A": few_words(3), "C": many_capitals(3), "D": holds_any("#"), "B": repeated_words(50)}, None)
    assert [tuple(r) for r in one.collect()] == [("en", 1, 1)]
