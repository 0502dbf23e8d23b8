"""Which windows of a fixed length start at two or more places of the whole corpus.

Shared by the two substring operators, which differ in their unit (words or bytes) and in the index
they build over a reference shard.

1. Every window has an anchor: the gram with the least hash in it, the leftmost of equals. Equal
   windows have equal anchors at equal offsets. Neighbouring windows with one anchor form a
   segment, so a text has about two segments per window length.
2. Segments are counted by anchor. An anchor that occurs once has no repeated window. Where all
   segments of an anchor are equal, all their windows repeat.
3. What is left goes to reference shards by anchor, each distinct segment once with its count. A
   shard's index gives matching statistics for its segments.
4. An anchor with more than ``BLOCK`` different segments is dealt over several shards. Windows that
   a shard has only once are then compared over all shards of the anchor by a 128-bit hash.

No step holds all occurrences of an anchor, nor all segments of one, in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

BLOCK = 4096
SHARD_UNITS = 1 << 17

# (segments, their counts, window length) -> for each segment, whether its windows repeat
Index = Callable[[list, list, int], list]


@dataclass(frozen=True)
class Windows:
    """A window of ``length`` units; ``gram`` is the length of an anchor."""

    unit: str
    length: int
    gram: int

    def read(self, data: np.ndarray, offsets: np.ndarray):
        """(hash of each unit, first unit of each document, start and end byte of each unit)."""
        if self.unit == "byte":
            at = np.arange(len(data) + 1)
            return c.BYTE_HASH[data], offsets, at[:-1], at[1:]
        starts, ends, first = c.find_words(data, offsets)
        return c.hash_words(data, starts, ends), first, starts, ends


def least_gram(grams: np.ndarray, width: int) -> np.ndarray:
    """Position of the least gram of every ``width`` neighbours; the leftmost of equals.

    The 40 leading bits of the hash decide, packed with the position in a chunk."""
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    low = np.uint64((1 << 24) - 1)
    chunk = (1 << 24) - width
    for first in range(0, n, chunk):
        part = grams[first : first + min(chunk, n - first) + width - 1]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        out[first : first + len(least)] = (least & low).astype(np.int64) + first
    return out


def segments(values: np.ndarray, first: np.ndarray, windows: Windows):
    """(start, end, anchor hash, content hash) of every segment, in order."""
    starts = c.gram_rows(first, windows.length)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    roll = c.Rolling(values)
    grams = roll.grams(windows.gram, 1)
    anchors = least_gram(grams, windows.length - windows.gram + 1)[starts]
    heads = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    tails = np.append(heads[1:], len(anchors)) - 1
    begin, end = starts[heads], starts[tails] + windows.length
    return begin, end, c.signed(grams[anchors[heads]]), c.signed(roll.ranges(begin, end, 2))


def merged(begin, end, anchor, content, row):
    """Runs of equal segments that touch, as periodic texts have them: (first segment, end of the
    last one, how many). A run of two or more repeats whole."""
    same = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1]) & (row[1:] == row[:-1])
    same &= begin[1:] <= end[:-1]
    head = np.flatnonzero(np.append(True, ~same)) if len(begin) else np.zeros(0, np.int64)
    after = np.append(head[1:], len(begin)).astype(np.int64)
    return head, end[after - 1], after - head


def _segment_rows(windows: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did = batch.column("did").to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for at, rows, data, offsets in c.slices(batch, "text"):
                values, first, _, _ = windows.read(data, offsets)
                begin, end, anchor, content = segments(values, first, windows)
                row = np.searchsorted(first, begin, "right") - 1
                head, until, times = merged(begin, end, anchor, content, row)
                begin, end, anchor, content, row = (x[head] for x in (begin, end, anchor, content, row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(did[at + row]),
                        pa.array(th[at + row]),
                        pa.array((begin - first[row]).astype(np.int32)),
                        pa.array((end - begin).astype(np.int32)),
                        pa.array((until - first[row]).astype(np.int32)),
                        pa.array(times),
                        pa.array(anchor),
                        pa.array(content),
                    ],
                    names=["did", "th", "pos", "len", "end", "times", "anchor", "seg"],
                )

    return run


def _contents(windows: Windows):
    """Bytes of the segments a document was chosen to supply; words joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted").to_pylist()
            anchor, seg, count, kinds, content = [], [], [], [], []
            for at, rows, data, offsets in c.slices(batch, "text"):
                _, first, starts, ends = windows.read(data, offsets)
                blob = data.tobytes()
                for row in range(rows):
                    for w in wanted[at + row]:
                        a = first[row] + w["pos"]
                        b = a + w["len"]
                        if windows.unit == "byte":
                            content.append(blob[a:b])
                        else:
                            content.append(b" ".join(blob[starts[i] : ends[i]] for i in range(a, b)))
                        anchor.append(w["anchor"])
                        seg.append(w["seg"])
                        count.append(w["w"])
                        kinds.append(w["d"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor, pa.int64()),
                    pa.array(seg, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(kinds, pa.int64()),
                    pa.array(content, pa.binary()),
                ],
                names=["anchor", "seg", "w", "d", "content"],
            )

    return run


SOLVED = (
    "anchor long, seg long, spans array<struct<start:int,end:int>>, "
    "open array<struct<start:int,h1:long,h2:long,n:int>>"
)


def runs_of(flags: np.ndarray, length: int) -> list[dict]:
    """Units covered by the flagged windows, as merged ranges."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    spans: list[dict] = []
    for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1 + length):
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = int(b)
        else:
            spans.append({"start": int(a), "end": int(b)})
    return spans


def _solve(windows: Windows, index: Index):
    length = windows.length

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        texts, seen, kept = [], set(), []
        for anchor, seg, w, d, content in rows:
            if (anchor, seg) not in seen:  # equal rows of the input supply a segment twice
                seen.add((anchor, seg))
                kept.append((anchor, seg, w, d))
                texts.append(content)
        names: dict[bytes, int] = {}
        if windows.unit == "byte":
            units = [np.frombuffer(t, np.uint8).astype(np.int64) for t in texts]
        else:
            units = [np.array([names.setdefault(x, len(names)) for x in t.split(b" ")]) for t in texts]
        flags = index(units, [k[2] for k in kept], length)
        spans = [runs_of(f, length) for f in flags]
        opened: list[list[dict]] = [[] for _ in kept]
        split = [i for i, k in enumerate(kept) if k[3] > BLOCK]
        if split:
            _open(split, texts, units, flags, opened)
        return pa.RecordBatch.from_pylist(
            [
                {"anchor": k[0], "seg": k[1], "spans": s, "open": o}
                for k, s, o in zip(kept, spans, opened)
            ],
            pa.schema(
                [
                    ("anchor", pa.int64()),
                    ("seg", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    (
                        "open",
                        pa.list_(
                            pa.struct(
                                [("start", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32())]
                            )
                        ),
                    ),
                ]
            ),
        )

    def _open(split, texts, units, flags, opened) -> None:
        """One entry for each different window of the split anchors: n is 2 if it repeats here."""
        values, owner, start, twice = [], [], [], []
        for i in split:
            if windows.unit == "byte":
                hashes = c.BYTE_HASH[units[i]]
            else:
                data = np.frombuffer(texts[i], np.uint8)
                hashes = c.hash_words(data, *c.find_words(data, np.array([0, len(data)]))[:2])
            one = c.Rolling(hashes).grams(length, 3)
            two = c.Rolling(c.mix(hashes, 4)).grams(length, 5)
            values.append(np.stack([c.signed(one), c.signed(two)], 1))
            owner.append(np.full(len(one), i))
            start.append(np.arange(len(one)))
            twice.append(flags[i])
        pairs, at = np.unique(np.concatenate(values), axis=0, return_index=True)
        owner, start, twice = np.concatenate(owner)[at], np.concatenate(start)[at], np.concatenate(twice)[at]
        for (h1, h2), i, s, t in zip(pairs.tolist(), owner.tolist(), start.tolist(), twice.tolist()):
            opened[i].append({"start": s, "h1": h1, "h2": h2, "n": 2 if t else 1})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for anchor, block, seg, w, d, content in zip(*(x.to_pylist() for x in batch.columns)):
                if size >= SHARD_UNITS and (anchor, block) != last:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append((anchor, seg, w, d, content))
                size += len(content) if windows.unit == "byte" else content.count(b" ") + 1
                last = (anchor, block)
        if rows:
            yield shard(rows)

    return run


def repeated_spans(docs: DataFrame, windows: Windows, index: Index) -> DataFrame:
    """(did, th, spans): for each document with repeated windows, the unit ranges they cover.

    ``docs`` has ``did, th, text`` (see ``common.row_key``). Ranges may overlap."""
    found = c.store(
        docs.select("did", "th", "text").mapInArrow(
            _segment_rows(windows), "did long, th long, pos int, len int, end int, times long, anchor long, seg long"
        )
    )
    # Stored before each join: a join that shares a stage with the aggregate could not be split
    # where one anchor has a large share of the rows.
    anchors = c.store(
        found.groupBy("anchor")
        .agg(F.sum("times").alias("n"), F.min("seg").alias("a"), F.max("seg").alias("b"))
        .filter("n > 1")
        .select("anchor", (F.col("a") != F.col("b")).alias("multi"))
    )
    again = c.store(found.join(anchors, "anchor"))
    # Different segments around one anchor: counts, and the document that supplies the content.
    kinds = c.store(
        again.filter("multi")
        .groupBy("anchor", "seg")
        .agg(F.sum("times").alias("w"), F.min(F.struct("did", "th", "pos", "len")).alias("rep"))
    )
    sizes = c.store(
        kinds.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("d"), F.min("w").alias("least"))
        .filter("least = 1")
    )
    wanted = (
        kinds.join(sizes, "anchor")
        .select("rep.*", "anchor", "seg", "w", "d")
        .groupBy("did", "th")
        .agg(F.collect_list(F.struct("pos", "len", "anchor", "seg", "w", "d")).alias("wanted"))
    )
    block = F.pmod(F.xxhash64("seg"), F.ceil(F.col("d") / F.lit(BLOCK))).cast("int").alias("block")
    contents = (
        docs.select("did", "th", "text")
        .join(wanted, ["did", "th"])
        .select("text", "wanted")
        .mapInArrow(_contents(windows), "anchor long, seg long, w long, d long, content binary")
        .select("anchor", block, "seg", "w", "d", "content")
    )
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = c.store(
        contents.repartition(shards, "anchor", "block")
        .sortWithinPartitions("anchor", "block")
        .mapInArrow(_solve(windows, index), SOLVED)
    )
    # Windows that occur once in each of several shards of one anchor.
    opened = solved.select("anchor", "seg", F.explode("open").alias("o")).select("anchor", "seg", "o.*")
    across = opened.groupBy("h1", "h2").agg(F.sum("n").alias("total")).filter("total > 1")
    late = (
        opened.filter("n = 1")
        .join(across, ["h1", "h2"])
        .select("anchor", "seg", "start", (F.col("start") + windows.length).cast("int").alias("end"))
    )
    inside = solved.select("anchor", "seg", F.explode("spans").alias("s")).select("anchor", "seg", "s.*")
    whole = again.filter("not multi").select("did", "th", "pos", "end")
    split = again.filter("multi").join(kinds.select("anchor", "seg", "w"), ["anchor", "seg"])
    whole = whole.unionByName(
        split.filter("w > 1").select("did", "th", "pos", "end")
    )
    parts = (
        split.filter("w = 1")
        .drop("end")
        .join(inside.unionByName(late), ["anchor", "seg"])
        .select("did", "th", (F.col("pos") + F.col("start")).alias("pos"), (F.col("pos") + F.col("end")).alias("end"))
    )
    spans = F.collect_list(F.struct(F.col("pos").alias("start"), F.col("end")))
    return whole.unionByName(parts).distinct().groupBy("did", "th").agg(spans.alias("spans"))


def covered(rows: list, first: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``n`` units of a slice lie in a span of their document."""
    starts, ends = [], []
    for row, spans in enumerate(rows):
        for s in spans or ():
            starts.append(first[row] + s["start"])
            ends.append(first[row] + s["end"])
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.array(starts, np.int64), 1)
    np.add.at(steps, np.array(ends, np.int64), -1)
    return np.cumsum(steps[:-1]) > 0
