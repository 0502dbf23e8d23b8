"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap on whole texts.

Test items are cut into pieces of up to PIECE words, the units of the inverted index. The impacts of
a piece's terms are its BM25 parts divided by their sum, so a score is the share of the piece's own
score that a passage reaches, between 0 and 1. Every passage of every document (PASSAGE words, one
every STRIDE) is a query; any PIECE words in a row lie whole in some passage. All pieces scoring at
least THRESHOLD name an item. Its words that lie in runs of SHINGLE words of the document are counted,
and by their BM25 weights, so an edit costs the words it touches; the item counts if enough of it, of
its question or of its answer is there, or a long enough run.

Most passages are ruled out for whole slices at once. The commonest terms of a piece, up to a share
of COMMON, cannot lift it to the threshold, so the other, essential postings must reach what is
missing: first by the sum of each word's largest essential impact, then by sums of block maxima of
the distinct words. Block-max WAND runs over the blocks that are left, on all postings.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

PIECE = 32
PASSAGE = 64
STRIDE = 32
THRESHOLD = 0.6
COMMON = 0.3
SHINGLE = 3
OVERLAP = 0.8
ANSWER = 0.25  # share of an item's words, at its end, that is taken as the answer
ALONE = 10  # words of a question or answer that counts without the other
ALONE_OVERLAP = 0.9
RUN = 80  # words in a row that count whatever the rest of the item
K1, B = 1.2, 0.75
BLOCK = 4
SHARD_BYTES = 4 << 20


@dataclass
class Index:
    """Postings by term, in order of pieces, and the largest impact of each block of BLOCK pieces;
    the same maxima over essential postings, and what these must reach in a block."""

    terms: np.ndarray  # sorted hashes
    start: np.ndarray  # postings of term t: start[t] to start[t + 1]
    piece: np.ndarray
    impact: np.ndarray
    block_start: np.ndarray
    block: np.ndarray
    block_impact: np.ndarray
    largest: np.ndarray
    ess_start: np.ndarray
    ess_block: np.ndarray
    ess_impact: np.ndarray
    ess_largest: np.ndarray
    need: np.ndarray  # of each block
    item_of: np.ndarray  # item of each piece
    sides: list  # of each item: (shingle length, shingle hashes, weight of each word)

    @classmethod
    def build(cls, texts: list, idf, mean_length: float) -> Index:
        """``idf`` gives the weight of an array of term hashes."""
        data, offsets = c.text_bytes(pa.array(texts, pa.string()))
        hashes, first = c.plain_words(data, offsets)
        rows, item_of, sides, piece = [], [], [], 0
        for item in range(len(texts)):
            words = hashes[first[item] : first[item + 1]]
            n = max(1, min(SHINGLE, len(words)))
            sides.append((n, c.Rolling(words).grams(n, 30), idf(words)))
            for a, b in _pieces(len(words)):
                terms, tf = np.unique(words[a:b], return_counts=True)
                length = K1 * (1 - B + B * (b - a) / mean_length)
                part = idf(terms) * tf * (K1 + 1) / (tf + length)
                rows.append((terms, np.full(len(terms), piece), part / part.sum()))
                item_of.append(item)
                piece += 1
        term, pieces, impact = (
            np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, kind)
            for i, kind in enumerate((np.uint64, np.int64, np.float64))
        )
        order = np.lexsort((pieces, term))
        term, pieces, impact = term[order], pieces[order], impact[order]
        terms, start, number = np.unique(term, return_index=True, return_inverse=True)
        start = np.append(start, len(term))
        # The commonest terms of each piece while their shares add up to COMMON or less.
        by = np.lexsort((term, -np.diff(start)[number], pieces))
        share = np.cumsum(impact[by])
        heads = np.flatnonzero(np.diff(pieces[by], prepend=-1))
        share -= np.repeat(np.append(0, share)[heads], np.diff(np.append(heads, len(by))))
        common = np.zeros(len(term), bool)
        common[by] = share <= COMMON
        missing = THRESHOLD - np.bincount(pieces, impact * common, piece)
        need = np.minimum.reduceat(missing, np.arange(0, piece, BLOCK)) if piece else missing
        return cls(
            terms, start, pieces, impact, *_maxima(number, pieces, impact, len(terms)),
            *_maxima(number[~common], pieces[~common], impact[~common], len(terms)), need,
            np.array(item_of, np.int64), sides,
        )

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term, -1 for words of no item."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def wand(self, terms: list, threshold: float, blocks: list) -> list[tuple[int, float]]:
        """All pieces of some blocks with a score of at least ``threshold`` for distinct terms.

        Cursors stay sorted by piece. The pivot is the first piece that the largest impacts could
        lift to the threshold; if the maxima of its block cannot, all cursors skip the block. Blocks
        that are not asked for are skipped too."""
        found = []
        cursors = [[int(self.piece[self.start[t]]), int(self.start[t]), t] for t in terms]
        self._advance(cursors, len(cursors), blocks[0] * BLOCK)
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                total += self.largest[t]
                if total >= threshold - 1e-12:
                    pivot = i
                    break
            if pivot < 0:
                break
            piece = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == piece:
                pivot += 1
            block = piece // BLOCK
            at = bisect_left(blocks, block)
            if at == len(blocks):
                break
            if blocks[at] != block:
                self._advance(cursors, len(cursors), blocks[at] * BLOCK)
                continue
            bound = sum(self._block_max(t, block) for _, _, t in cursors[: pivot + 1])
            if bound < threshold - 1e-12:
                after = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    after = min(after, cursors[pivot + 1][0])
                self._advance(cursors, pivot + 1, max(after, piece + 1))
            elif cursors[0][0] == piece:
                score = sum(self.impact[i] for _, i, _ in cursors[: pivot + 1])
                if score >= threshold - 1e-12:
                    found.append((piece, float(score)))
                self._advance(cursors, pivot + 1, piece + 1)
            else:
                self._advance(cursors, pivot, piece)
        return found

    def _block_max(self, term: int, block: int) -> float:
        a, b = self.block_start[term], self.block_start[term + 1]
        at = a + np.searchsorted(self.block[a:b], block)
        return self.block_impact[at] if at < b and self.block[at] == block else 0.0

    def _advance(self, cursors: list, count: int, piece: int) -> None:
        """Move the first cursors to their first posting at or after ``piece``; drop finished ones."""
        for cursor in cursors[:count]:
            a, b = cursor[1], self.start[cursor[2] + 1]
            at = a + int(np.searchsorted(self.piece[a:b], piece))
            cursor[0], cursor[1] = (int(self.piece[at]), at) if at < b else (-1, at)
        cursors[:] = [x for x in cursors if x[0] >= 0]

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple]:
        """(document, item, best score) over all passages of the documents of a slice."""
        if not len(self.need):
            return []
        starts, ends = passages(first)
        term = self.lookup(hashes)
        total = np.append(0, np.cumsum(np.where(term >= 0, self.ess_largest[term], 0.0)))
        alive = np.flatnonzero(total[ends] - total[starts] >= self.need.min() - 1e-9)
        if not len(alive):
            return []
        document = np.searchsorted(first, starts, "right") - 1
        best: dict[tuple[int, int], float] = {}
        for a in range(0, len(alive), 512):
            some = alive[a : a + 512]
            for passage, piece, score in self._search(term, starts[some], ends[some]):
                pair = (int(document[some[passage]]), int(self.item_of[piece]))
                best[pair] = max(best.get(pair, 0.0), score)
        return [(d, i, s) for (d, i), s in best.items()]

    def _search(self, term, starts, ends) -> Iterator[tuple[int, int, float]]:
        """Pieces found by some passages: sums of block maxima over distinct terms, then WAND."""
        words = term[c.spread(starts, ends - starts)]
        owner = np.repeat(np.arange(len(starts)), ends - starts)[words >= 0]
        pairs = np.unique(owner * len(self.terms) + words[words >= 0])
        owner, words = pairs // len(self.terms), pairs % len(self.terms)
        counts = self.ess_start[words + 1] - self.ess_start[words]
        at = c.spread(self.ess_start[words], counts)
        blocks = len(self.need)
        key, where = np.unique(np.repeat(owner, counts) * blocks + self.ess_block[at], return_inverse=True)
        sums = np.bincount(where, self.ess_impact[at], len(key))
        key = key[sums >= self.need[key % blocks] - 1e-9]
        for passage in np.unique(key // blocks).tolist():
            a, b = np.searchsorted(owner, [passage, passage + 1])
            x, y = np.searchsorted(key, [passage * blocks, (passage + 1) * blocks])
            for piece, score in self.wand(words[a:b].tolist(), THRESHOLD, (key[x:y] % blocks).tolist()):
                yield passage, piece, score


def _maxima(term, piece, impact, terms: int) -> tuple:
    """(start of each term, block, largest impact in the block, largest of the term)."""
    block = piece // BLOCK
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    heads = np.flatnonzero(new)
    most = np.maximum.reduceat(impact, heads) if len(heads) else impact
    largest = np.zeros(terms)
    np.maximum.at(largest, term[heads], most)
    return np.searchsorted(term[heads], np.arange(terms + 1)), block[heads], most, largest


def _pieces(words: int) -> list[tuple[int, int]]:
    """Cuts of an item into pieces of about equal length, none above PIECE."""
    count = -(-words // PIECE)
    cuts = [round(i * words / count) for i in range(count + 1)] if count else []
    return list(zip(cuts[:-1], cuts[1:]))


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end word of every passage; a document's last passage may be shorter."""
    counts = np.diff(first)
    many = np.where(counts > 0, np.maximum(1, -(-(counts - (PASSAGE - STRIDE)) // STRIDE)), 0)
    row = np.repeat(np.arange(len(counts)), many)
    turn = c.spread(np.zeros(len(many), np.int64), many)
    starts = first[row] + turn * STRIDE
    return starts, np.minimum(starts + PASSAGE, first[row + 1])


def _overlap(shingles: np.ndarray, weight: np.ndarray, n: int, of: np.ndarray) -> tuple[float, float, float, bool]:
    """(share of the question, of the answer, of both, whether it counts) for an item and the shingles
    of a document. A share is that of the words or of their weights, whichever is less."""
    hit = np.isin(shingles, of)
    there = np.zeros(len(weight), bool)
    for i in range(n):
        there[i : i + len(hit)] |= hit

    def share(part: slice) -> float:
        own, w = there[part], weight[part]
        return float(min(own.mean(), w[own].sum() / w.sum())) if len(own) else 1.0

    cut = len(weight) - int(len(weight) * ANSWER)
    q, a, whole = share(slice(cut)), share(slice(cut, None)), share(slice(None))
    gaps = np.flatnonzero(np.concatenate([[True], ~there, [True]]))
    alone = any(
        x >= ALONE_OVERLAP - 1e-12 and words >= ALONE for x, words in ((q, cut), (a, len(weight) - cut))
    )
    return q, a, whole, whole >= OVERLAP - 1e-12 or alone or int(np.diff(gaps).max()) > RUN


def leaks(index: Index, batch: pa.RecordBatch) -> list[tuple]:
    """(row of the batch, item, score, overlap of the question, of the answer, of both)."""
    out = []
    for at, _, data, offsets in c.slices(batch, "text"):
        hashes, first = c.plain_words(data, offsets)
        sets: dict[tuple[int, int], np.ndarray] = {}
        for doc, item, score in index.candidates(hashes, first):
            n, shingles, weight = index.sides[item]
            if (doc, n) not in sets:
                sets[doc, n] = np.unique(c.Rolling(hashes[first[doc] : first[doc + 1]]).grams(n, 30))
            q, a, whole, counts = _overlap(shingles, weight, n, sets[doc, n])
            if counts:
                out.append((at + doc, item, score, q, a, whole))
    return out


FOUND = "doc_id long, item_id long, score double, question double, answer double, overlap double"


def _report(model, ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = leaks(model.value, batch)
            docs = batch.column("doc_id").to_pylist()
            columns = [[docs[r[0]] for r in rows], [ids[r[1]] for r in rows], *([r[i] for r in rows] for i in range(2, 6))]
            kinds = [pa.int64()] * 2 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                names=[x.split()[0] for x in FOUND.split(", ")],
            )

    return run


def _drop(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r[0] for r in leaks(model.value, batch)]] = False
            yield batch.filter(pa.array(keep))

    return run


def _piece_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each piece of each item."""
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        for at, rows, data, offsets in c.slices(batch, "text"):
            hashes, first = c.plain_words(data, offsets)
            parts = [(at + r, hashes[first[r] + a : first[r] + b]) for r in range(rows) for a, b in _pieces(first[r + 1] - first[r])]
            terms = [np.unique(words) for _, words in parts]
            sizes = [len(t) for t in terms]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([shard[r] for r, _ in parts], sizes).astype(np.int64)),
                    pa.array(c.signed(np.concatenate([np.zeros(0, np.uint64), *terms]))),
                ],
                names=["shard", "term"],
            )


def _indexes(items: DataFrame):
    """(broadcast index, item ids) of each shard of the items; a shard has about SHARD_BYTES of text.

    Term weights come from all items, whatever their shard."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = size // SHARD_BYTES + 1
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    terms = c.store(
        items.select("shard", "text").mapInArrow(_piece_terms, "shard long, term long").groupBy("shard", "term").count()
    )
    counts = terms.groupBy("term").agg(F.sum("count").alias("df"))
    words = F.size(F.filter(F.split("text", "[^0-9A-Za-z\\x{80}-\\x{10ffff}]+"), lambda w: w != ""))
    total = items.select(words.alias("n")).filter("n > 0").agg(
        F.sum(F.ceil(F.col("n") / PIECE)).alias("pieces"), F.sum("n").alias("words")
    ).first()
    pieces = total["pieces"] or 1
    mean_length = (total["words"] or 1) / pieces
    for shard in range(shards):
        own = terms.filter(F.col("shard") == shard).select("term").join(counts, "term").collect()
        known = np.array([r["term"] for r in own], np.int64).view(np.uint64)
        df = np.array([r["df"] for r in own], np.float64)
        order = np.argsort(known)
        known, weight = known[order], np.log(1 + (pieces - df[order] + 0.5) / (df[order] + 0.5))

        def idf(hashes: np.ndarray, known=known, weight=weight) -> np.ndarray:
            return weight[np.searchsorted(known, hashes)]

        rows = items.filter(F.col("shard") == shard).orderBy("item_id", "text").select("item_id", "text").collect()
        index = Index.build([r["text"] for r in rows], idf, mean_length)
        yield spark.sparkContext.broadcast(index), [r["item_id"] for r in rows]


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question, answer, overlap): items that documents contain.

    ``score`` is the best passage's share of a piece's own BM25 score; the others are shares of the
    words, or of their weights if that is less, of the item's question, answer (its last quarter) and
    whole, in runs of three words (of all, if an item has fewer) that occur anywhere in the document.
    An item counts with 0.8 of the whole, 0.9 of a question or an answer of ten words or more, or a run
    of 80 words. Words are runs of letters and digits, A-Z folded. Every passage of every text is a query; one row for each pair of a row of ``docs``
    and a row of ``items``, so repeated rows are answered each. Null or empty texts and items match
    nothing; null ids stay null. Other columns are ignored; an empty table gives no rows. Items
    beyond one shard's size take one pass over the documents for each shard.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = [docs.mapInArrow(_report(model, ids), FOUND) for model, ids in _indexes(items)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain an item (see ``find_leaks``); columns unchanged."""
    for model, _ in _indexes(items):
        docs = docs.mapInArrow(_drop(model), docs.schema)
    return docs
