"""Small inputs with the awkward cases, and brute-force forms of the operators."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, row string, doc double, key string"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(seed=3, n=40):
    """Texts with near copies, shared passages, repeated lines, a long one, blanks and nulls."""
    rnd = random.Random(seed)
    vocab = [rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") + rnd.choice(["n", "r", "sh", "é", ""]) for _ in range(60)]

    def prose(k):
        return " ".join(rnd.choice(vocab) for _ in range(k))

    shared = [prose(20) for _ in range(3)]
    base = prose(90)
    out = [None, "", "  \t\n ", "one two three", "one two three", "ONE  two\nthree", base]
    for _ in range(n):
        kind = rnd.randrange(5)
        if kind == 0:
            w = base.split()
            for _ in range(rnd.randrange(3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append(" ".join(w))
        elif kind == 1:
            out.append(prose(rnd.randrange(5, 60)) + " " + rnd.choice(shared) + "\n" + prose(rnd.randrange(0, 30)))
        elif kind == 2:
            out.append("same line here again and again it goes on and on for ever\n" * rnd.randrange(1, 5))
        else:
            out.append(prose(rnd.randrange(1, 120)))
    out.append(prose(4000))
    out.append(out[-1])
    return out


def docs(spark, rows=None, ids=None):
    """A documents table with extra columns whose names clash with helper columns; the last rows repeat an id and lack one."""
    rows = texts() if rows is None else rows
    ids = list(range(len(rows))) if ids is None else ids
    data = [(i, t, "en", f"src{(i or 0) % 3}" if (i or 1) % 7 else None, len(t or ""), 1, "r", 2.0, "k") for i, t in zip(ids, rows)]
    return spark.createDataFrame(data, SCHEMA)


def jaccard_components(rows):
    """{index: (shingles, component)} by comparing all pairs."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(rows))}


def repeats(units, ids, size):
    """Mask of the covered units of each row: windows of ``size`` that also start in a row with a smaller id."""
    first = {}
    for u, d in zip(units, ids):
        for i in range(len(u) - size + 1):
            w = tuple(u[i:i + size])
            first[w] = min(first.get(w, d), d)
    out = []
    for u, d in zip(units, ids):
        mask = [False] * len(u)
        for i in range(len(u) - size + 1):
            if first[tuple(u[i:i + size])] < d:
                mask[i:i + size] = [True] * size
        out.append(mask)
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()
