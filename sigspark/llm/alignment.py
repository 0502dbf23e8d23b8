"""Alignment of two tokenizers' ids over the same texts, by whitespace-token anchors.

A text is tokenised as a whole by both. An anchor is a byte offset where both have a token that starts with a space;
as tokens follow each other without gaps, both also end a token there. Anchors cut a document into windows of ids.
How a window is aligned depends on its two id tuples alone, so it is worked out once for each pair of tuples and
kept in a memo: the groups between shared ends, and the linked ids (those that end a group).

``align`` gives one row a document, with ids and groups, and for every slice of documents the id pairs it links and
how often. ``pair_counts`` adds them up over the corpus. ``rate`` sends each slice only the counts of its own pairs, so
nothing that grows with the corpus is broadcast or meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c
from . import tokens as tk

SLICE = 1 << 20
MEMO = 300_000
ALIGNED = (
    "doc_id long, slice long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>, "
    "links array<int>, times array<int>, pairs array<long>, counts array<long>"
)


def pair_id(a, b):
    return (a << 32) | b


class Windows:
    """Alignments of windows by id tuples, in a bounded memo."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.lengths = tuple(np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.spaced = tuple(np.array([x[:1] == b" " for x in side], bool) for side in (a, b))
        self.flat = tuple(np.frombuffer(b"".join(side), np.uint8) for side in (a, b))
        self.starts = tuple(np.cumsum(x) - x for x in self.lengths)
        self.plain = tuple(x.tolist() for x in self.lengths)
        self.memo = tk.Memo(self, MEMO)

    def spelling(self, side: int, ids: np.ndarray) -> np.ndarray:
        return self.flat[side][c.spread(self.starts[side][ids], self.lengths[side][ids])]

    def encode(self, keys: list[bytes]) -> list[list[int]]:
        """For windows (ids of a, -1, ids of b): each group's tokens in a, tokens in b, and the two ids that end it."""
        return [self._align(np.frombuffer(key, np.int32).tolist()) for key in keys]

    def _align(self, ids: list[int]) -> list[int]:
        length_a, length_b = self.plain
        end, n, out = ids.index(-1), len(ids), []
        i, j = 0, end + 1
        p, q, ahead = i, j, 0  # bytes of a minus bytes of b so far
        while i < end:
            ahead += length_a[ids[i]]
            i += 1
            while ahead > 0 and j < n:
                ahead -= length_b[ids[j]]
                j += 1
            if ahead == 0:
                out += (i - p, j - q, ids[i - 1], ids[j - 1])
                p, q = i, j
        return out

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in a, in b) where windows start: tokens that start with a space, at the same byte, so that both
        sides end a token before it. Every document begins with a space, so none is crossed."""
        at = [np.flatnonzero(self.spaced[side][ids]) for side, ids in ((0, a), (1, b))]
        begins = [
            (np.cumsum(self.lengths[side][ids]) - self.lengths[side][ids])[at[side]] for side, ids in ((0, a), (1, b))
        ]
        _, i, j = np.intersect1d(*begins, assume_unique=True, return_indices=True)
        return at[0][i], at[1][j]

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a_sizes, b_sizes, pairs) of all groups of ids that spell the same bytes."""
        i, j = self.anchors(a, b)
        i_sizes, j_sizes = np.diff(np.append(i, len(a))), np.diff(np.append(j, len(b)))
        # Each window's key: its ids of a, -1, its ids of b.
        sizes = i_sizes + j_sizes + 1
        ends = np.cumsum(sizes)
        keys = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int32)
        keys[c.spread(ends - sizes, i_sizes)] = a
        keys[c.spread(ends - j_sizes, j_sizes)] = b
        bounds = np.append(0, ends).astype(np.int64) * 4
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(keys)]
        ).dictionary_encode()
        flat, starts, sizes = self.memo.encode(array.dictionary.to_pylist())
        index = array.indices.to_numpy(zero_copy_only=False)
        rows = flat[c.spread(starts[index], sizes[index])].reshape(-1, 4)
        return rows[:, 0], rows[:, 1], pair_id(rows[:, 2].astype(np.int64), rows[:, 3].astype(np.int64))


_windows: dict[tuple, Windows] = {}


def _of_worker(a_path: str, b_path: str) -> tuple[tk.Memo, tk.Memo, Windows]:
    a, b = tk.memo(tk.ByteBpe, a_path, True, limit=MEMO), tk.memo(tk.PieceBpe, b_path, limit=MEMO)
    if (a_path, b_path) not in _windows:
        _windows[a_path, b_path] = Windows(a.tokenizer.token_bytes(), b.tokenizer.token_bytes())
    return a, b, _windows[a_path, b_path]


def _spelled(windows: Windows, side: int, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each document whether its ids spell its bytes."""
    sums = np.append(0, np.cumsum(windows.lengths[side][ids]))[at]
    right = np.diff(sums) == np.diff(offsets)
    spelt = windows.spelling(side, ids)
    if len(spelt) == len(data) and right.all():
        wrong = np.append(0, np.cumsum(spelt != data))
        return wrong[offsets[1:]] == wrong[offsets[:-1]]
    for i in np.flatnonzero(right):
        right[i] = np.array_equal(spelt[sums[i] : sums[i + 1]], data[offsets[i] : offsets[i + 1]])
    return right


def _kept(ids: np.ndarray, at: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the documents kept; the others are empty."""
    sizes = np.diff(at) * keep
    return ids[c.spread(at[:-1], sizes)], np.append(0, np.cumsum(sizes))


def align_slice(
    data: np.ndarray, offsets: np.ndarray, memo_a: tk.Memo, memo_b: tk.Memo, windows: Windows
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For texts with their spaces: (values, offsets by document) of a's ids, b's ids, group sizes in a, in b, pairs."""
    pieces = tk.Pieces(data, offsets)
    (a, a_at), (b, b_at) = pieces.ids(memo_a), pieces.ids(memo_b)
    keep = _spelled(windows, 0, a, a_at, data, offsets) & _spelled(windows, 1, b, b_at, data, offsets)
    (a, a_at), (b, b_at) = _kept(a, a_at, keep), _kept(b, b_at, keep)
    a_sizes, b_sizes, pairs = windows.groups(a, b)
    at = np.searchsorted(np.cumsum(a_sizes), a_at, "left") + (a_at > 0) * 1
    at = np.where(a_at > 0, at, 0)
    return [(a, a_at), (b, b_at), (a_sizes, at), (b_sizes, at), (pairs, at)]


def _column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values).cast(kind))


def _head(values: np.ndarray, rows: int) -> pa.ListArray:
    """A list in the first row, nulls below."""
    offsets = pa.array([0, *[len(values)] * rows], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64()), mask=pa.array([False] + [True] * (rows - 1)))


DIGESTED = (
    "doc_id long, slice long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "links array<int>, times array<int>, pairs array<long>, counts array<long>"
)


def align(docs: DataFrame, a_path: str, b_path: str, *, digest: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): ids of both tokenizers (``tokens.ByteBpe``, ``tokens.PieceBpe``),
    ``a_sizes`` and ``b_sizes`` (tokens of each group in them), and ``links`` with ``times``: places in its slice's list of
    id pairs, and how often the document links each. ``slice`` names the slice; its first row has that list,
    ``pairs`` with ``counts``, null on the others.

    With ``digest`` the ids and sizes, several times the text, stay in the task, and ``n_a``, ``n_b``, ``n_groups`` and
    ``groups_sha256`` are in their place: the SHA-256 of the groups written as ``a1,a2|b1;a3|b2,b3``, or '' without tokens.

    Texts get a space before them. A null or empty text, and one whose tokens do not spell the text in both,
    has no tokens. Other columns are ignored; rows that repeat are aligned each; an empty table gives no rows.
    """
    schema = DIGESTED if digest else ALIGNED
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo_a, memo_b, windows = _of_worker(a_path, b_path)
        number, spellings = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            for first, rows, data, offsets in c.slices(batch, "text", SLICE):
                *parts, (pairs, at) = align_slice(*tk.with_space(data, offsets), memo_a, memo_b, windows)
                distinct, where, counts = np.unique(pairs, return_inverse=True, return_counts=True)
                # A document and one of its pairs as one number, sorted by both.
                owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(at))
                found, times = np.unique(owner * (len(distinct) + 1) + where, return_counts=True)
                links_at = np.searchsorted(found, np.arange(rows + 1, dtype=np.int64) * (len(distinct) + 1))
                if digest:
                    texts = group_texts(*parts, spellings)
                    hashes = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
                    own = [*(pa.array(np.diff(parts[k][1])) for k in (0, 1, 2)), pa.array(hashes, pa.string())]
                else:
                    own = [_column(*part, pa.int32()) for part in parts]
                columns = [
                    batch.column("doc_id").slice(first, rows),
                    pa.array(np.full(rows, number)),
                    *own,
                    _column(found % (len(distinct) + 1), links_at, pa.int32()),
                    _column(times, links_at, pa.int32()),
                    _head(distinct, rows),
                    _head(counts, rows),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _values(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def group_texts(a: tuple, b: tuple, a_sizes: tuple, b_sizes: tuple, spellings: dict | None = None) -> list[str]:
    """The groups of each document as text, from (values, offsets by document) of ids and group sizes."""
    spellings = {} if spellings is None else spellings

    def spelt(ids: np.ndarray, end: str) -> np.ndarray:
        table, need = spellings.get(end, ()), int(ids.max()) + 1 if len(ids) else 0
        if len(table) < need:
            table = spellings[end] = np.array([f"{i}{end}" for i in range(need)], object)
        return table[ids] if need else np.zeros(0, object)

    sizes = a_sizes[0] + b_sizes[0]
    begins = np.cumsum(sizes) - sizes
    out = np.empty(len(a[0]) + len(b[0]), object)
    for (ids, _), (n, _), skip, end in ((a, a_sizes, 0, "|"), (b, b_sizes, a_sizes[0], ";")):
        words = spelt(ids, ",")
        last = np.cumsum(n) - 1
        words[last] = spelt(ids[last], end)
        out[c.spread(begins + skip, n)] = words
    at = a[1] + b[1]
    return ["".join(out[at[i] : at[i + 1]].tolist())[:-1] for i in range(len(at) - 1)]


def _slice_pairs(aligned: DataFrame) -> DataFrame:
    heads = aligned.filter("pairs is not null").select("slice", F.arrays_zip("pairs", "counts").alias("z"))
    return heads.select("slice", F.posexplode("z").alias("place", "p")).select(
        "slice", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): how many links of the corpus join the two ids, and whether no id has more links
    with b. Slices have added their links up before the shuffle."""
    counts = c.store(_slice_pairs(aligned).groupBy("pair").agg(F.sum("n").alias("count")))
    counts = counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(0xFFFFFFFF)})
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def rate(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` (any of its columns, with slice, links and times) with ``n_best``, the links whose count is the highest of
    their b id, and ``count_sum``, the sum of the links' counts; without links, times, pairs and counts.

    The counts of a slice's pairs come back to it as lists in the order of its pairs, so a frequent pair is one
    row a slice in the join, not one a link; a slice is a bounded run of texts, or one text."""
    asked = _slice_pairs(aligned).select("slice", "place", "pair").join(counts.select("pair", "count", "best"), "pair")
    entries = F.array_sort(F.collect_list(F.struct("place", "count", "best")))
    answers = asked.groupBy("slice").agg(entries.alias("e")).select(F.col("slice").alias("of"), "e.count", "e.best")
    rows = aligned.drop("pairs", "counts")
    kept = [f for f in rows.schema.fields if f.name not in ("links", "times", "n_best", "count_sum")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = right.num_rows == 0
        count = np.zeros(0, np.int64) if empty else right["count"].combine_chunks().flatten().to_numpy()
        best = np.zeros(0, bool) if empty else right["best"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        (links, at), (times, _) = (_values(left[k].combine_chunks()) for k in ("links", "times"))
        sums = (np.append(0, np.cumsum(values))[at] for values in (times * best[links], times * count[links]))
        out = left.select([f.name for f in kept])
        for name, total in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(np.diff(total), pa.int64()))
        return out

    return rows.groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(score, schema)
