"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression. From the expression a Boolean query of
trigrams is derived: a disjunction of conjunctions that every matching text
must satisfy. The index holds a posting (trigram, document) for the trigrams
that some rule's query names; the postings of a query are intersected per
document, and only the documents left are read with the expression. A rule
from which no mandatory trigram follows reads every document.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstats.llm.tables import fresh, text_column

#: Above this many alternatives a run of literals is cut: its query so far is kept, a new run starts.
_MAX_STRINGS = 64


def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """The trigrams (lower case) any match must contain, as a set of alternatives.

    Each alternative is a set of trigrams that all occur in the lower-cased
    text. None: no trigram is mandatory.
    """
    clauses = [q for q in _clauses(re._parser.parse(pattern)) if q is not None]
    if not clauses:
        return None
    out = {frozenset().union(*choice) for choice in product(*clauses)}
    return frozenset(a for a in out if not any(b < a for b in out))


def _alternatives(strings) -> frozenset[frozenset[str]] | None:
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(a for a in sets if not any(b < a for b in sets))


def _strings(op, arg) -> set[str] | None:
    """All lower-cased strings a node matches, or None if there are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        if any(str(o) != "LITERAL" for o, _ in arg) or len(arg) > 8:
            return None
        return {chr(a).lower() for _, a in arg}
    if name == "SUBPATTERN":
        return _sequence_strings(arg[3])
    if name == "BRANCH":
        parts = [_sequence_strings(p) for p in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] is not None and int(arg[1]) <= 4:
        inner = _sequence_strings(arg[2])
        if inner is None:
            return None
        out: set[str] = set()
        for n in range(arg[0], int(arg[1]) + 1):
            out |= {"".join(p) for p in product(inner, repeat=n)}
        return out if len(out) <= _MAX_STRINGS else None
    return {""} if name == "AT" else None


def _sequence_strings(seq) -> set[str] | None:
    out = {""}
    for op, arg in seq:
        s = _strings(op, arg)
        if s is None or len(out) * len(s) > _MAX_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _clauses(seq) -> list:
    """Queries of the literal runs of a sequence; all of them hold together."""
    found, run = [], {""}
    for op, arg in seq:
        s = _strings(op, arg)
        if s is not None and len(run) * len(s) <= _MAX_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        found.append(_alternatives(run))
        run = s if s is not None else {""}
        if s is None and str(op) == "SUBPATTERN":
            found += _clauses(arg[3])
        elif s is None and str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            found += _clauses(arg[2])
    found.append(_alternatives(run))
    return found


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    ``pattern`` must mean the same to Python's parser (for the query) and to
    Java (for the search). A match counts if group ``group`` has at least
    ``least`` characters; a match that fails is dropped and the search goes
    on after it. ``tail``, if given, says by how many characters a match
    reaches into the text between it and the rule's next match.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    tail: Callable[[Column], Column] | None = None
    query: frozenset | None = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "query", trigram_query(self.pattern))


# The three kinds of the contract. The least lengths of access
# and hex are inside the expression, which finds the same spans, since both
# match the longest run from its first possible start.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: A token (no white space) of a private key's body, and what else stands before the body.
_KEY_END = r"^(?s:.*?)-----END [A-Z ]*PRIVATE KEY-----"
_KEY_TOKEN = r"^(?:[A-Za-z0-9+/=]{16,})?$"
_KEY_HEADER = r"^[\x20\t]*[A-Za-z][A-Za-z0-9-]*:|^[\x20\t\r]*$"
_KEY_LAST = r"^[\x20\t]*\r?\n[A-Za-z0-9+/=]{1,15}[\x20\t\r]*(?:\n|$)"


def _leading(parts: Column, pattern: str, sep: str) -> Column:
    """The parts before the first that does not match, joined again."""
    bad = F.array_position(F.transform(parts, lambda x: ~x.rlike(pattern)), F.lit(True)).cast("int")
    return F.array_join(F.when(bad > 0, F.slice(parts, F.lit(1), bad - 1)).otherwise(parts), sep)


def private_key_tail(after: Column) -> Column:
    """How many characters of the text after a BEGIN line belong to the key.

    All through the END line, if there is one before the next BEGIN. Else the header lines (``Name: value``), if
    base64 follows them, and the tokens of 16 or more base64 characters that follow each other, with a shorter last
    line. No expression here repeats a group, so neither the number of dashes nor that of lines is bounded.
    """
    through = F.length(F.regexp_extract(after, _KEY_END, 0))
    heads = _leading(F.split(after, "\n"), _KEY_HEADER, "\n")
    body = F.substring(after, F.length(heads) + 1, F.length(after))
    lead = F.length(F.rtrim(_leading(F.split(body, r"[\x20\t\r\n]"), _KEY_TOKEN, " ")))
    last = F.regexp_extract(F.substring(body, lead + 1, F.length(body)), _KEY_LAST, 0)
    open_end = F.when(lead > 0, F.length(heads) + lead + F.length(F.rtrim(F.translate(last, "\t\r\n", "   ")))).otherwise(0)
    return F.when(through > 0, through).otherwise(open_end)


MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", tail=private_key_tail),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES


def trigram_postings(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: (trigram, key, row), one row per document and trigram that a rule's query names.

    ``row`` is a hash of the text, so documents without an id, or with the same, are told apart.
    """
    grams = sorted({g for r in rules if r.query for a in r.query for g in a})
    low = docs.select(F.col(key).alias("key"), F.xxhash64(text_column(text)).alias("row"), F.lower(text_column(text)).alias("low"))
    if not grams:
        return low.select(F.lit("").alias("trigram"), "key", "row").where(F.lit(False))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", "row", F.explode(found).alias("trigram"))


def rule_candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """(key, row, rules): the documents that satisfy a rule's query, with the kinds of those rules."""
    grams = sorted({g for r in rules if r.query for a in r.query for g in a})
    words = -(-len(grams) // 60)

    def mask(w):  # the bit of a trigram in word w
        pairs = [(F.lit(g), F.lit(1 << (i % 60) if i // 60 == w else 0).cast("long")) for i, g in enumerate(grams)]
        return F.bit_or(F.create_map(*[x for p in pairs for x in p])[F.col("trigram")]).alias(f"m{w}")

    masks = [mask(w) for w in range(words)]
    if not grams:
        return postings.select("key", "row", F.array().cast("array<string>").alias("rules"))
    per_doc = postings.groupBy("key", "row").agg(*masks)

    def holds(alternative) -> Column:
        need = [0] * words
        for g in alternative:
            i = grams.index(g)
            need[i // 60] |= 1 << (i % 60)
        out = F.lit(True)
        for w, n in enumerate(need):
            out = out & (F.col(f"m{w}").bitwiseAND(F.lit(n).cast("long")) == F.lit(n).cast("long"))
        return out

    kinds = []
    for r in rules:
        if r.query:
            hit = F.lit(False)
            for a in sorted(r.query, key=sorted):
                hit = hit | holds(a)
            kinds.append(F.when(hit, F.lit(r.kind)))
    return per_doc.select("key", "row", F.array_compact(F.array(*kinds)).alias("rules")).where(F.size("rules") > 0)


def _rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start, rank, end, kind>> of one rule's matches in ``text`` (code points, end exclusive)."""
    pieces = F.split(text, rule.pattern, -1)
    gaps = F.transform(pieces, F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length)
    sized = (F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length)
             if rule.group else whole)
    more = (F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), rule.tail) if rule.tail
            else F.transform(whole, lambda x: F.lit(0)))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["len"] + x["more"]).alias("end"),
                        F.lit(rule.kind).alias("kind"))
        return F.struct((start + x["len"]).alias("at"),
                        F.when(x["size"] >= rule.least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    names = ("gap", "len", "size", "more")
    steps = F.transform(F.arrays_zip(*[c.alias(n) for c, n in zip((gaps, whole, sized, more), names)]),
                        lambda x: F.struct(*[x[n].alias(n) for n in names]))
    return F.aggregate(F.filter(steps, lambda x: x["len"].isNotNull()),
                       F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def with_secret_spans(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text",
                      out: str = "secret_spans") -> DataFrame:
    """``docs`` with ``out``: all secrets of each whole text, sorted by start, then rule order.

    Null and empty texts have no spans. Rows with equal or null keys each keep
    their own spans: candidates are found per key and text hash, then every
    such row is verified on its own text. All other columns stay as they are.
    """
    k, r, hits, c, own = fresh(docs, "candidate_key", "candidate_row", "candidate_rules", "candidate_text", "own_row")
    candidates = rule_candidates(trigram_postings(docs, rules, key, text), rules)
    candidates = candidates.select(F.col("key").alias(k), F.col("row").alias(r), F.col("rules").alias(hits))
    mine = docs.withColumn(own, F.xxhash64(text_column(text)))
    joined = mine.join(candidates, F.col(f"`{key}`").eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left")
    joined = joined.withColumn(c, text_column(text))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    parts = []
    for rank, rule in enumerate(rules):
        spans = _rule_spans(F.col(c), rule, rank)
        if rule.query:
            spans = F.when(F.array_contains(F.coalesce(F.col(hits), F.array().cast("array<string>")), rule.kind),
                           spans).otherwise(none)
        parts.append(spans)
    return joined.withColumn(out, F.array_sort(F.flatten(F.array(*parts)))).drop(k, r, hits, c, own)


def redact(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping secrets by one mark each start).

    Documents without a secret keep their text as it is; null stays null.
    """
    (s,) = fresh(docs, "found_spans")
    found = with_secret_spans(docs, rules, key, text, s)
    whole = F.col(text)
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        kept = F.concat(acc["out"], F.substring(whole, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        inside = x["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(kept).alias("out"))

    done = F.aggregate(F.col(s), first, step,
                       lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.length(whole))))
    return found.withColumn(text, F.when(F.size(s) > 0, done).otherwise(whole)).drop(s)


def span_digest(spans: Column, kinds=None) -> Column:
    """``kind:start:end`` of the spans, comma-joined (only of ``kinds``, if given)."""
    if kinds is not None:
        spans = F.filter(spans, lambda x: x["kind"].isin(list(kinds)))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
