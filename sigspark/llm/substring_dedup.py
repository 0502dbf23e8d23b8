"""Substring dedup over words: suffix automata of reference shards, matching statistics, removal.

The reference is the corpus itself. Shipping an automaton of every shard to every document would
grow with the square of the corpus, so a shard holds the segments of a range of anchors (see
``repeats``) and the segments with those anchors are streamed through it, no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c
from .repeats import Windows, covered, repeated_spans

WINDOW_WORDS = 35
ANCHOR_WORDS = 8


class SuffixAutomaton:
    """All substrings of several sequences, with the number of places each one ends."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A state for the shorter strings of ``q`` that end after ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence, count: int) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            q = nexts[last].get(symbol)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, symbol, q)
            else:
                state = self._state(length[last] + 1, {}, 0)
                p = last
                while p >= 0 and symbol not in nexts[p]:
                    nexts[p][symbol] = state
                    p = link[p]
                if p >= 0:
                    q = nexts[p][symbol]
                    link[state] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
                last = state
            self.count[last] += count

    def finish(self) -> None:
        """Every state also ends where the states linked to it end."""
        for state in np.argsort(-np.array(self.length), kind="stable")[:-1].tolist():
            self.count[self.link[state]] += self.count[state]

    def repeated(self, sequence, length: int) -> np.ndarray:
        """For each window of ``length`` symbols of a sequence: does it occur twice or more?"""
        flags = np.zeros(max(0, len(sequence) - length + 1), bool)
        state = 0
        for i, symbol in enumerate(sequence):
            state = self.next[state][symbol]
            while self.length[self.link[state]] >= length:
                state = self.link[state]
            if i >= length - 1:
                flags[i - length + 1] = self.count[state] > 1
        return flags


def automaton_index(units: list, counts: list, length: int) -> list:
    """Repeated windows of the sequences of one shard; a sequence counted twice repeats whole."""
    automaton = SuffixAutomaton()
    lists = [u.tolist() for u in units]
    for sequence, count in zip(lists, counts):
        automaton.add(sequence, count)
    automaton.finish()
    return [
        automaton.repeated(s, length) if n < 2 else np.ones(len(s) - length + 1, bool)
        for s, n in zip(lists, counts)
    ]


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, spans = batch.column("doc_id"), batch.column("spans").to_pylist()
        for at, rows, data, offsets in c.slices(batch, "text"):
            starts, ends, first = c.find_words(data, offsets)
            gone = covered(spans[at : at + rows], first, len(starts))
            blob = data.tobytes()
            texts, removed = [], []
            for row in range(rows):
                a, b = first[row], first[row + 1]
                keep = a + np.flatnonzero(~gone[a:b])
                texts.append(" ".join(blob[s:e].decode() for s, e in zip(starts[keep].tolist(), ends[keep].tolist())))
                removed.append(int(b - a - len(keep)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, rows), pa.array(np.diff(first)), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): texts without any word of a repeated window.

    A window is ``window`` consecutive words of one document; it repeats if the same words also
    start anywhere else, in the same document or in another row. ``kept`` has the other words,
    joined by one space. A null or empty text has no words and an empty ``kept``; texts shorter
    than the window keep all words; rows that repeat are copies of each other, whatever their ids;
    a null id is kept as null. Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", *c.row_key())
    spans = repeated_spans(rows, Windows("word", window, min(ANCHOR_WORDS, window)), automaton_index)
    return (
        rows.join(spans, ["did", "th"], "left")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
        .mapInArrow(_clean, "doc_id long, n_words long, n_removed long, kept string")
    )
