"""Personal data by bootstrapped contextual extraction.

Strict expressions find the seeds: e-mail and IP addresses, card and phone
numbers. The words around seeds are lexical patterns. Patterns and the
identifiers they stand at form a bipartite graph, which Spark scores in
rounds: a pattern is worth the share of its identifiers that are believed to
be of a kind, an identifier is believed as far as any of its patterns is.
Loose expressions give identifiers that the strict ones miss; those at a
high-confidence pattern of their kind are added. Seeds always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, BooleanType, StringType, StructField, StructType

from clickstats.llm.tables import cut, fresh, text_column

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern adds identifiers if it is at least this sure of a kind; SMOOTHING unknown identifiers are added to each pattern.
CONFIDENT = 0.8
SMOOTHING = 2.0

# The expressions of the contract.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# The same matches as ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``: no match starts inside a run of digits, and a run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Loose forms of each kind. An e-mail is ``[\w.%+-]+(?:@|\(at\)|\[at\])[\w.-]*\w``, looked for from its sign.
_AT = re.compile(r"@|\(at\)|\[at\]")
_NAME = re.compile(r"[\w.%+-]")
_HOST = re.compile(r"[\w.-]*\w")
_LOOSE = (
    ("ip", re.compile(r"(?<![\w.:-])[0-9]{1,3}(?:[.:-][0-9]{1,3}){3}(?![\w:-])")),
    ("card", re.compile(r"(?<![\w.])[0-9](?:[\x20./-]?[0-9]){11,18}(?![\w])")),
    ("phone", re.compile(r"(?<![\w.+])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20./-]{1,2}[0-9]{2,5}){1,4}(?![\w])")),
)
_WORD = re.compile(r"\S+")
_EDGE = "\"'()[]{}<>,;"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = 2 * x - 9 * (x > 4)
        total += x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the seeds: leftmost, non-overlapping per kind; a match that fails its test is dropped."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:  # a local part is the longest run before an @, so the search may start from the @
        m = _DOMAIN.match(text, at + 1)
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if m and start < at:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", at + 1)
        while 0 <= at < end:
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and _luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _loose_emails(text: str):
    end = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > end and _NAME.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, m.end())
        if host and end <= start < m.start():
            yield start, host.end()
            end = host.end()


def loose_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of looser matches that touch no seed and no earlier loose match."""
    starts, ends = [], []  # what is covered, as disjoint spans in order
    for a, z in sorted((a, z) for _, a, z in taken):
        if starts and a < ends[-1]:
            ends[-1] = max(ends[-1], z)
        else:
            starts.append(a)
            ends.append(z)
    out = []
    found = [("email", a, z) for a, z in _loose_emails(text)]
    found += [(kind, m.start(), m.end()) for kind, pattern in _LOOSE for m in pattern.finditer(text)]
    for kind, a, z in found:
        if kind == "phone" and not 7 <= len(_digits(text[a:z])) <= 15:
            continue
        i = bisect_left(ends, a + 1)  # the first covered span that ends after a
        if i == len(starts) or starts[i] >= z:
            out.append((kind, a, z))
            starts.insert(i, a)
            ends.insert(i, z)
    return out


def _instance(kind: str, found: str) -> str:
    return found.lower() if kind == "email" else _digits(found)


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns at a span: the word before, the two before, the words on both sides."""
    left = [w.strip(_EDGE).lower() for w in text[max(0, start - 80):start].split()[-2:]]
    m = _WORD.search(text, end, end + 43)  # no more of the next word is used
    right = m.group()[:40].strip(_EDGE).lower() if m and m.start() - end <= 3 else ""
    out = []
    if left and left[-1]:
        out.append("1 " + left[-1])
        if len(left) == 2:
            out.append("2 " + " ".join(left))
        if right:
            out.append("3 " + left[-1] + " _ " + right)
    return out


_MENTION = StructType([
    StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("seed", BooleanType()), StructField("instance", StringType()),
    StructField("patterns", ArrayType(StringType())),
])


def with_mentions(docs: DataFrame, text: str = "text", out: str = "mentions") -> DataFrame:
    """``docs`` without ``text``, with ``out``: all strict and loose matches of each whole text, with their contexts."""
    (t,) = fresh(docs, "mention_text")
    kept = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(f"`{c}`") for c in kept], text_column(text).alias(t))
    schema = StructType([*plain.drop(t).schema.fields, StructField(out, ArrayType(_MENTION))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()),
                               ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))

    def mentions(x: str) -> list[dict]:
        strict = strict_spans(x)
        spans = [(k, a, z, True) for k, a, z in strict] + [(k, a, z, False) for k, a, z in loose_spans(x, strict)]
        return [{"kind": k, "start": a, "end": z, "seed": s, "instance": _instance(k, x[a:z]),
                 "patterns": _patterns(x, a, z)} for k, a, z, s in spans]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                got = pa.array([mentions(x) for x in part.column(len(kept)).to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(kept)], got], names=[*kept, out])

    return plain.mapInArrow(run, schema)


def confident_patterns(mentions: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENT) -> DataFrame:
    """(kind, pattern): the patterns whose identifiers are of one kind with confidence ``least``, after ``rounds`` rounds.

    ``mentions``: rows of kind, seed, instance, patterns. Copies of a text count once: edges are distinct.
    """
    edges = mentions.select(F.explode("patterns").alias("pattern"), "kind", "instance", "seed")
    edges = cut(edges.groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed")))
    belief = edges.select("kind", "instance", "pattern", F.col("seed").cast("double").alias("s"), "seed")
    total = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("n"))

    def patterns(scored):
        per = scored.groupBy("pattern", "kind").agg(F.sum("s").alias("s"))
        return per.join(total, "pattern").select("pattern", "kind", (F.col("s") / (F.col("n") + SMOOTHING)).alias("conf"))

    for _ in range(rounds):
        conf = patterns(belief).where(F.col("conf") > 0)
        doubt = (edges.join(conf, ["pattern", "kind"])
                 .groupBy("kind", "instance").agg(F.sum(F.log(1.0 - F.col("conf"))).alias("doubt")))
        belief = cut(edges.join(doubt, ["kind", "instance"], "left").select(
            "kind", "instance", "pattern", "seed",
            F.when(F.col("seed"), 1.0).otherwise(1.0 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("s")))
    return patterns(belief).where(F.col("conf") >= least).select("kind", "pattern")


def find_personal_data(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """``docs`` without ``text``, with ``out``: array of (start, rank, end, kind, seed), sorted by start, then kind.

    Every row is judged on its own text: equal rows get equal spans. Null and empty texts have none.
    """
    m, uid, p_kind, p_pat, hits = fresh(docs, "pii_mentions", "pii_row", "pii_kind", "pii_pattern", "pii_added")
    found = cut(with_mentions(docs, text, m)).withColumn(uid, F.monotonically_increasing_id())
    each = found.select(uid, F.explode(m).alias("x")).select(uid, "x.*")
    good = confident_patterns(each).select(F.col("kind").alias(p_kind), F.col("pattern").alias(p_pat))
    loose = each.where(~F.col("seed")).withColumn("pattern", F.explode("patterns"))
    added = (loose.join(good, (F.col("kind") == F.col(p_kind)) & (F.col("pattern") == F.col(p_pat)), "left_semi")
             .groupBy(uid).agg(F.collect_set(F.struct("start", "end", "kind")).alias(hits)))
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def span(x, seed):
        return F.struct(x["start"].alias("start"), rank[x["kind"]].alias("rank"), x["end"].alias("end"),
                        x["kind"].alias("kind"), F.lit(seed).alias("seed"))

    kind = "array<struct<start:int,rank:int,end:int,kind:string,seed:boolean>>"
    seeds = F.transform(F.filter(m, lambda x: x["seed"]), lambda x: span(x, True)).cast(kind)
    more = F.coalesce(F.transform(hits, lambda x: span(x, False)).cast(kind), F.array().cast(kind))
    return found.join(added, uid, "left").withColumn(out, F.array_sort(F.concat(seeds, more))).drop(m, uid, hits)
