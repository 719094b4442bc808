"""Substring dedup by words: repeated-phrase automata.

Passages that recur across documents are confirmed, compiled into
sharded Aho-Corasick automata over word numbers, and the text pieces that can
hold them are streamed through the automaton of their shard, which reports
every occurrence of every phrase with the first document that has it. The
shards are hash buckets (``repeats``), so none grows with the corpus.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickstats.llm import repeats, textops

WORDS = 13
GRAM = 4
UNITS = repeats.Units(True, WORDS, GRAM)


def confirmed_phrases(numbers: np.ndarray, first: np.ndarray, count: np.ndarray, doc: np.ndarray, size: int):
    """(phrases, first id): the windows of ``size`` word numbers that pieces of two or more documents hold.

    ``first`` and ``count``: the first window of each piece in ``numbers`` and its windows. ``phrases``: positions, one of
    each different window.
    """
    piece = np.repeat(np.arange(len(first)), count)
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    h = textops.gram_hashes(numbers.astype(np.uint64), size)[at]
    same = textops.equal_spans(h, np.ascontiguousarray(numbers, np.int64).view(np.uint8), 8 * at, 8 * (at + size))
    order = np.lexsort((doc[piece], same))
    hs, docs = same[order], doc[piece][order]
    start = np.flatnonzero(np.r_[True, hs[1:] != hs[:-1]])
    ends = np.r_[start[1:], len(hs)]
    recurs = docs[start] != docs[ends - 1]
    return at[order[start[recurs]]], docs[start[recurs]]


def automaton_matcher(content, begin, end, windows, doc, size):
    """(piece, window) of the windows that a piece with a smaller id holds too."""
    # Each piece is a text of words joined by single spaces.
    length = end - begin
    off = np.r_[0, np.cumsum(length)]
    data = np.concatenate([content[a:z] for a, z in zip(begin, end)])
    starts, ends, first = textops.word_spans(data, off)
    numbers = textops.equal_spans(textops.span_hashes(data, starts, ends), data, starts, ends)
    phrases, owner = confirmed_phrases(numbers, first[:-1], windows, doc, size)
    none = np.zeros(0, np.int64)
    if not len(phrases):
        return none, none
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    as_list = numbers.tolist()
    for at, o in zip(phrases.tolist(), owner.tolist()):
        automaton.add_word(tuple(as_list[at:at + size]), o)
    automaton.make_automaton()
    piece, window = [], []
    for i, (a, z, d) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), doc.tolist())):
        for last, o in automaton.iter(tuple(as_list[a:z])):
            if o < d:
                piece.append(i)
                window.append(last - size + 1)
    return np.array(piece, np.int64), np.array(window, np.int64)


def remove_repeated_phrases(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) of every row of ``docs``.

    A word goes if it lies in a window of 13 words that also starts in a document with a smaller id; windows are judged on
    the input. The kept words are joined by one space. Null and empty texts have no words. A null id counts as larger than
    every other; rows that share an id are one document, and judged row by row. An empty table gives an empty result.
    """
    found = repeats.with_repeats(docs, UNITS, automaton_matcher, key, text)
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    def run(batches):
        for batch in batches:
            n, gone, sha, kept = [], [], [], []
            data, off = textops.column_buffer(batch.column(2))
            for _, i, ranges in repeats.each_row([batch]):
                raw = data[off[i]:off[i + 1]]
                starts, ends, _ = textops.word_spans(raw, np.array([0, len(raw)]))
                away = repeats.covered_units(ranges, len(starts))
                whole = raw.tobytes()
                left = b" ".join([whole[a:z] for a, z in zip(starts[~away].tolist(), ends[~away].tolist())])
                n.append(len(starts))
                gone.append(int(away.sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                if keep_text:
                    kept.append(left.decode())
            cols = [batch.column(4), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * keep_text, names=names)

    return found.mapInArrow(run, schema)
