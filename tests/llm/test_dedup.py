from dataclasses import replace
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstats.llm import repeats, suffix_dedup, textops
from clickstats.llm.phrase_dedup import automaton_matcher, remove_repeated_phrases
from clickstats.llm.suffix_dedup import deep_shallow_sort, remove_repeated_bytes
from llm_data import WORD, docs, repeats as brute, sha, texts

NULL_ID = (1 << 63) - 1


def cases():
    rows = texts()
    ids = list(range(len(rows)))
    rows += [rows[10], rows[12], rows[6]]
    ids += [10, 13, None]  # a repeated row, an id with two texts, a row without an id
    return rows, ids


@pytest.fixture(params=["plain", "hot", "small zones"])
def setting(request, monkeypatch):
    if request.param == "hot":  # every key takes the hot route
        monkeypatch.setattr(repeats, "HOT_IN_FLUSH", 2)
        monkeypatch.setattr(repeats, "HOT_IN_BUCKET", 1)
    if request.param == "small zones":
        monkeypatch.setattr(repeats, "ZONE_WINDOWS", 3)
        monkeypatch.setattr(repeats, "FLUSH", 50)
    return request.param


def test_phrases_equal_brute_force(spark, setting):
    rows, ids = cases()
    units = [WORD.findall(t or "") for t in rows]
    masks = brute(units, [NULL_ID if i is None else i for i in ids], 13)
    want = sorted((i if i is not None else -1, len(u), sum(m), sha(" ".join(w for w, x in zip(u, m) if not x).encode()))
                  for i, u, m in zip(ids, units, masks))
    got = remove_repeated_phrases(docs(spark, rows, ids)).collect()
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got) == want
    assert any(w[2] for w in want)


def test_bytes_equal_brute_force(spark, setting):
    rows, ids = cases()
    rows = [t if t is None else t[:3000] for t in rows]
    units = [(t or "").encode() for t in rows]
    masks = brute(units, [NULL_ID if i is None else i for i in ids], 50)
    want = sorted((i if i is not None else -1, len(u), sum(m), sum(x and not y for x, y in zip(m, [False] + m[:-1])),
                   sha(bytes(b for b, x in zip(u, m) if not x))) for i, u, m in zip(ids, units, masks))
    got = remove_repeated_bytes(docs(spark, rows, ids)).collect()
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got) == want
    assert any(w[2] for w in want)


def test_empty_table(spark):
    assert remove_repeated_phrases(docs(spark, [], [])).collect() == []
    assert remove_repeated_bytes(docs(spark, [], [])).collect() == []


@pytest.mark.parametrize("size,shallow", [(50, 2), (13, 1), (8, 1), (24, 3), (50, 7)])
def test_deep_shallow_order_is_the_sorted_order(size, shallow):
    rng = np.random.default_rng(size)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    data[200:300] = data[:100]
    data[400:500] = data[:100]
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    at = np.arange(len(data) - size)
    order, group = deep_shallow_sort(padded, at, size, shallow)
    strings = [data[a:a + size].tobytes() for a in at]
    assert [strings[i] for i in order] == sorted(strings)
    assert all((group[i] == group[i + 1]) == (strings[order[i]] == strings[order[i + 1]]) for i in range(len(at) - 1))
    assert suffix_dedup.UNITS.size == 50


def test_equal_hashes_are_not_equal_contents(spark, setting, monkeypatch):
    """With hashes of few values, contents still decide which windows are equal."""
    weak = SimpleNamespace(**{k: v for k, v in vars(textops).items() if callable(v)})
    weak.span_hashes = lambda data, starts, ends: textops.span_hashes(data, starts, ends) & np.uint64(15 << 60)
    monkeypatch.setattr(repeats, "textops", weak)
    rows, ids = cases()
    rows = [t if t is None else t[:600] for t in rows]
    for remove, units, size in ((remove_repeated_phrases, [WORD.findall(t or "") for t in rows], 13),
                                (remove_repeated_bytes, [(t or "").encode() for t in rows], 50)):
        masks = brute(units, [NULL_ID if i is None else i for i in ids], size)
        want = sorted((i if i is not None else -1, len(u), sum(m)) for i, u, m in zip(ids, units, masks))
        got = sorted((r[0] if r[0] is not None else -1, r[1], r[2]) for r in remove(docs(spark, rows, ids)).collect())
        assert got == want


def test_automaton_decides_by_words(monkeypatch):
    rnd = np.random.default_rng(4)
    words = [rnd.choice(["ab", "ba", "longer-word-x", "longer-word-y"], 30).tolist() for _ in range(12)]
    words[7][3:20] = words[2][10:27]
    text = [" ".join(w).encode() for w in words]
    end = np.cumsum([len(t) for t in text])
    begin = end - [len(t) for t in text]
    few = np.uint64(1 << 63)
    spans, grams = textops.span_hashes, textops.gram_hashes
    monkeypatch.setattr(textops, "span_hashes", lambda *a: spans(*a) & few)
    monkeypatch.setattr(textops, "gram_hashes", lambda *a: grams(*a) & few)
    piece, window = automaton_matcher(np.frombuffer(b"".join(text), np.uint8), begin, end, np.full(12, 18), np.arange(12), 13)
    masks = brute(words, list(range(12)), 13)
    got = [[False] * 30 for _ in words]
    for p, w in zip(piece, window):
        got[p][w:w + 13] = [True] * 13
    assert got == masks and any(map(any, masks))


@pytest.mark.parametrize("shared_id", [None, 7])
def test_many_texts_under_one_id_keep_their_own_ranges(spark, shared_id):
    """The passage starts elsewhere in each text, so a row that took the ranges of another would lose more or less than it."""
    passage = " ".join(f"passage{k}" for k in range(15))
    rows = [passage] + [" ".join(f"w{i}x{k}" for k in range(1 + i % 29)) + "\n" + passage for i in range(2000)]
    ids = [0] + [shared_id] * 2000
    words = remove_repeated_phrases(docs(spark, rows, ids)).where("n_removed > 0")
    assert {(r["n_removed"], r["n"]) for r in words.groupBy("n_removed").agg(F.count("*").alias("n")).collect()} == {(15, 2000)}
    by_bytes = remove_repeated_bytes(docs(spark, rows, ids)).where("n_removed > 0")
    got = by_bytes.groupBy("n_removed", "n_spans").agg(F.count("*").alias("n")).collect()
    assert {tuple(r) for r in got} == {(len(passage), 1, 2000)}


def test_a_gram_shared_by_chance_sends_no_text(spark):
    """Every text has the same 20 bytes again and again, but only two hold the same 50; what one text repeats is not shared."""
    rng = np.random.default_rng(11)
    rows = ["".join("the same twenty byte" + "".join(map(chr, rng.integers(97, 123, 40))) for _ in range(12)) for _ in range(60)]
    rows[41] += rows[7][200:300]
    rows[50] += rows[50]
    source = docs(spark, rows).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("row"), "text")
    u = suffix_dedup.UNITS
    by_key, found = ({r["k_doc"] for r in repeats._shared_keys(repeats._scan(source, x), x).collect()} for x in (replace(u, prints=False), u))
    assert len(by_key) == 60
    assert {7, 41} <= found and len(found) < 10  # prints of 16 bits may agree by chance
    got = remove_repeated_bytes(docs(spark, rows)).where("n_removed > 0").collect()
    assert [(r["doc_id"], r["n_spans"]) for r in got] == [(41, 1)] and got[0]["n_removed"] >= 100


def test_bytes_of_periodic_texts_equal_brute_force(spark, setting):
    """A gram that recurs inside a window, or fills the text, has the same first place in equal windows."""
    rng = np.random.default_rng(12)
    rows = ["a" * 49, "a" * 50, "a" * 300, "b" + "a" * 60 + "b", "-" * 200 + "a" * 55]
    for period in (1, 2, 3, 7, 12, 13, 30, 38, 39, 49, 50, 51):
        unit = "".join(map(chr, rng.integers(97, 99, period)))
        for k in range(3):
            noise = "".join(map(chr, rng.integers(97, 123, int(rng.integers(0, 30)))))
            rows.append(noise + (unit * 140)[int(rng.integers(0, period)):][:int(rng.integers(45, 140))] + noise[::-1])
    ids = rng.permutation(len(rows)).tolist()
    units = [t.encode() for t in rows]
    masks = brute(units, ids, 50)
    want = sorted((i, len(u), sum(m), sha(bytes(b for b, x in zip(u, m) if not x))) for i, u, m in zip(ids, units, masks))
    got = remove_repeated_bytes(docs(spark, rows, ids)).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == want and sum(w[2] > 0 for w in want) > 15
