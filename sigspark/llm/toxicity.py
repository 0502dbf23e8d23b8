"""Toxicity: a convolutional text classifier trained in numpy inside tasks, scored inside tasks.

A word is the sum of the embeddings of its hash and of the hashes of its first bytes, which carry
stems; hashes find their embedding in an open table of those that lean to a class, others add
nothing. Filters of several widths slide over the words, each keeps
its largest response in the text, and a logistic layer adds them up. All labelled texts are learnt, whole: they are dealt
into shards, each trains the network for a pass, and the moves of the shards are averaged. The raw score is calibrated on
a part of the labelled texts that the network has not seen, where each language also gets its threshold.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import common as c

WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
PREFIXES = (4, 5, 6)
PARTS = 1 + len(PREFIXES)
# Words whose vectors a training step holds at once.
PIECE = 1 << 16
# Moves are added up as integers, so that their sum does not depend on the order of the shards.
FIXED = float(1 << 40)
EXACT = "decimal(28,12)"
GRID = np.linspace(0.3, 0.9, 25)
THRESHOLD = 0.7


@dataclass(frozen=True)
class Settings:
    """The labelled texts are dealt into shards of about ``shard`` texts and at most about ``shard_words`` words; both bound what a
    task holds, not what is learnt. Hashes in fewer than ``min_texts`` of them, or spread over both classes
    alike to ``min_lean`` standard errors, count as unknown, as do a share ``drop`` of all
    words while training, which takes ``epochs`` passes and at least ``steps`` batches."""

    shard: int = 3000
    shard_words: int = 1 << 21
    min_texts: int = 3
    min_lean: float = 2.5
    dim: int = 12
    filters: int = 8
    epochs: int = 8
    steps: int = 400
    batch: int = 64
    rate: float = 0.01
    drop: float = 0.1
    decay: float = 1e-4
    calibration: float = 0.25
    seed: int = 7


@dataclass
class Network:
    keys: np.ndarray  # hashes; row i + 1 of the embeddings belongs to keys[i], row 0, all 0, to others
    embed: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, dim, filters)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    slope: float = 1.0  # calibration of the raw score
    offset: float = 0.0
    thresholds: dict = field(default_factory=dict)

    def __post_init__(self):
        """An open table of hashes with at most a quarter of its slots in use."""
        self.bits = max(10, int(len(self.keys) * 4).bit_length())
        self.slots = np.zeros(1 << self.bits, np.int32)
        for i, key in enumerate(self.keys.tolist()):
            slot = key & (len(self.slots) - 1)
            while self.slots[slot]:
                slot = (slot + 1) & (len(self.slots) - 1)
            self.slots[slot] = i + 1

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding row of each hash; 0 for those that the network does not have."""
        flat = hashes.reshape(-1)
        mask = len(self.slots) - 1
        slot = (flat & np.uint64(mask)).astype(np.int64)
        keys = np.append(np.uint64(0), self.keys)
        row = self.slots[slot]
        wrong = np.flatnonzero((row > 0) & (keys[row] != flat))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & mask
            row[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(row[wrong] > 0) & (keys[row[wrong]] != flat[wrong])]
        return row.reshape(hashes.shape)

    def padded(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts one after the other, each with an unknown word before and PAD of them after it."""
        n = len(first) - 1
        starts = first[:-1] + np.arange(n) * (1 + PAD)
        out = np.zeros((len(ids) + n * (1 + PAD), PARTS), np.int32)
        out[c.spread(starts + 1, np.diff(first))] = ids
        return out, starts

    def pooled(self, ids: np.ndarray, starts: np.ndarray, tables: dict | None = None) -> np.ndarray:
        """Largest response of every filter in each text."""
        if not len(starts):
            return np.zeros((0, len(self.bias)), np.float32)
        ends = np.append(starts[1:], len(ids)) - PAD
        cuts = np.stack([starts, ends], 1).reshape(-1)
        # One more unknown word, so that the last text's end is a place of every width.
        ids = np.concatenate([ids, np.zeros((1, PARTS), ids.dtype)])
        tables = tables or self.tables()
        parts = [np.maximum.reduceat(self.responses(ids, tables[w]), cuts, axis=0)[::2] for w in WIDTHS]
        return np.maximum(np.concatenate(parts, axis=1) + self.bias, 0)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Response of each filter to each word at each place of the filter."""
        return {w: [self.embed @ f for f in self.filters[w]] for w in WIDTHS}

    @staticmethod
    def responses(ids: np.ndarray, table: list[np.ndarray]) -> np.ndarray:
        n = len(ids) - len(table) + 1
        total = np.zeros((n, table[0].shape[1]), np.float32)
        for place, response in enumerate(table):
            for part in range(PARTS):
                total += response[ids[place : place + n, part]]
        return total

    def raw(self, ids: np.ndarray, starts: np.ndarray, tables: dict | None = None) -> np.ndarray:
        return self.pooled(ids, starts, tables) @ self.out + self.shift

    def score(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw.astype(np.float64) + self.offset, -30, 30)))


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.state = rate, 0, {}

    def update(self, name, weight: np.ndarray, grad: np.ndarray, rows=None) -> None:
        """Move ``weight`` (or some rows of it) against the gradient."""
        if name not in self.state:
            self.state[name] = np.zeros_like(weight), np.zeros_like(weight)
        m, v = self.state[name]
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad**2
        weight[at] -= self.rate * m[at] / (np.sqrt(v[at]) + 1e-8)


def _empty(settings: Settings, keys: np.ndarray) -> Network:
    rng = np.random.default_rng(settings.seed)
    total = settings.filters * len(WIDTHS)
    embed = rng.normal(0, 0.1, (len(keys) + 1, settings.dim)).astype(np.float32)
    embed[0] = 0
    return Network(
        keys,
        embed,
        {w: rng.normal(0, 0.5 / w, (w, settings.dim, settings.filters)).astype(np.float32) for w in WIDTHS},
        np.zeros(total, np.float32),
        rng.normal(0, 0.3, total).astype(np.float32),
        0.0,
    )


def _step(net: Network, adam: Adam, ids, starts, labels, weights, decay: float) -> None:
    """One pass forward and back over a batch; only the pooled windows get a gradient."""
    n, wide = len(starts), net.filters[WIDTHS[0]].shape[2]
    ends = np.append(starts[1:], len(ids)) - PAD
    place = np.zeros((n, len(net.bias)), np.int64)
    best = np.full((n, len(net.bias)), -np.inf, np.float32)
    for lo in range(0, len(ids), PIECE):
        hi = min(lo + PIECE, len(ids))
        words = ids[lo : hi + PAD]
        vectors = sum(net.embed[words[:, part]] for part in range(PARTS))
        for k, w in enumerate(WIDTHS):
            m = len(words) - w + 1
            value = sum(vectors[o : o + m] @ net.filters[w][o] for o in range(w))
            for i in range(np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi)):
                first = max(starts[i], lo)
                part = value[first - lo : min(ends[i], hi) - lo]
                top = part.argmax(axis=0)
                found = part[top, np.arange(wide)]
                more = np.flatnonzero(found > best[i, k * wide : (k + 1) * wide])
                place[i, k * wide + more] = first + top[more]
                best[i, k * wide + more] = found[more]
    hidden = best + net.bias
    pooled = np.maximum(hidden, 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.shift, -30, 30)))
    delta = ((p - labels) * weights / weights.sum()).astype(np.float32)
    back = delta[:, None] * net.out[None, :] * (hidden > 0)
    grads: dict[int, np.ndarray] = {}
    rows, moves = [], []
    for k, w in enumerate(WIDTHS):
        cols = slice(k * wide, (k + 1) * wide)
        grads[w] = np.zeros_like(net.filters[w])
        for o in range(w):
            word = ids[place[:, cols] + o]
            grads[w][o] = np.einsum("nf,nfd->df", back[:, cols], net.embed[word].sum(axis=2))
            rows.append(word.reshape(-1))
            move = (back[:, cols][:, :, None] * net.filters[w][o].T[None]).reshape(-1, net.embed.shape[1])
            moves.append(np.repeat(move, PARTS, axis=0))
    adam.step += 1
    touched, slot = np.unique(np.concatenate(rows), return_inverse=True)
    grad = np.zeros((len(touched), net.embed.shape[1]), np.float32)
    np.add.at(grad, slot, np.concatenate(moves))
    known = touched > 0
    adam.update("embed", net.embed, (grad + decay * net.embed[touched])[known], touched[known])
    for w in WIDTHS:
        adam.update(w, net.filters[w], grads[w] + 1e-4 * net.filters[w])
    adam.update("bias", net.bias, back.sum(axis=0))
    adam.update("out", net.out, pooled.T @ delta + 1e-3 * net.out)
    shift = np.array([net.shift], np.float32)
    adam.update("shift", shift, np.array([delta.sum()], np.float32))
    net.shift = float(shift[0])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, hashes of words and stems, first word of each text), a slice of texts at a time."""
    for at, _, data, offsets in c.slices(batch, "text", c.SLICE_BYTES // 4):
        yield at, *c.plain_words(data, offsets, PREFIXES)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts with each hash, by part; key 0 counts the texts."""
    for batch in batches:
        label, learn = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("label", "learn"))
        kind = 2 * learn + label
        for at, hashes, first in _slices(batch):
            n = len(first) - 1
            rows = np.repeat(np.arange(n), np.diff(first) * PARTS)
            seen, ends = c.distinct_per_row(hashes.reshape(-1), rows, n)
            of = np.repeat(kind[at : at + n], np.diff(ends))
            of, seen = np.append(of[seen > 0], kind[at : at + n]), np.append(seen[seen > 0], np.zeros(n, np.uint64))
            keys, place = np.unique(seen, return_inverse=True)
            counts = np.bincount(4 * place + of, minlength=4 * len(keys)).reshape(-1, 2, 2)
            for part in (0, 1):
                use = counts[:, part].any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.signed(keys[use])), pa.array(np.full(use.sum(), bool(part))), pa.array(counts[use, part, 1]), pa.array(counts[use, part, 0])],
                    names=["key", "learn", "toxic", "other"],
                )


def _short(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in which no more than ``max(WIDTHS)`` unknown words follow each other. They have the same windows, and only those
    count, not how often or where they are."""
    unknown = ~ids.any(axis=1)
    run = unknown.copy()
    for back in range(1, max(WIDTHS) + 1):
        run[back:] &= unknown[:-back]
        run[:back] = False
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    within = np.arange(len(ids)) - first[of]
    keep = ~(run & (within >= max(WIDTHS)))
    return ids[keep], np.append(0, np.cumsum(np.bincount(of[keep], minlength=len(first) - 1)))


def _numbered(net):
    """Texts as embedding rows of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, hashes, first in _slices(batch):
                n = len(first) - 1
                ids, first = _short(net.value.ids(hashes), first)
                rest = [batch.column(k).slice(at, n) for k in ("turn", "th", "label", "lang", "learn")]
                words = pa.array([ids[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*rest, words, pa.array(np.diff(first))], names=["turn", "th", "label", "lang", "learn", "ids", "words"]
                )

    return run


def _texts(batch: pa.RecordBatch | pa.Table, net: Network, rows) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(batch.column("ids")[int(i)].as_py(), np.int32).reshape(-1, PARTS) for i in rows]
    return net.padded(np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts])))


def _dense(net: Network) -> np.ndarray:
    """All weights but the embeddings, in rows as wide as those."""
    flat = np.concatenate([*(net.filters[w].reshape(-1) for w in WIDTHS), net.bias, net.out, [net.shift]])
    wide = net.embed.shape[1]
    return np.append(flat, np.zeros(-len(flat) % wide)).astype(np.float64).reshape(-1, wide)


def _set_dense(net: Network, rows: np.ndarray) -> None:
    flat, at = rows.reshape(-1), 0
    for array in (*(net.filters[w] for w in WIDTHS), net.bias, net.out):
        array[...] = flat[at : at + array.size].reshape(array.shape)
        at += array.size
    net.shift = float(flat[at])


def _moved(net, settings: Settings, rates: list, weight: dict, salt: int):
    """A pass for each of ``rates`` over a shard: how far every row of weights moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).combine_chunks()
        table = table.sort_by([("turn", "ascending"), ("th", "ascending"), ("label", "ascending")])
        own, n = copy.deepcopy(net.value), table.num_rows
        labels = table.column("label").to_numpy().astype(np.float64)
        weights = np.where(labels > 0, weight[1], weight[0])
        adam, rng = Adam(settings.rate), np.random.default_rng((settings.seed, salt, table.column("turn")[0].as_py() & 0xFFFFFFFF))
        for rate in rates:
            adam.rate = rate
            order = rng.permutation(n)
            for a in range(0, n, settings.batch):
                rows = order[a : a + settings.batch]
                words, starts = _texts(table, own, rows)
                words = words * (rng.random((len(words), 1)) >= settings.drop)  # some words become unknown
                _step(own, adam, words, starts, labels[rows], weights[rows], settings.decay)
        moves = own.embed.astype(np.float64) - net.value.embed
        touched = np.flatnonzero(moves.any(axis=1))
        dense = _dense(own) - _dense(net.value)
        rows = np.append(touched, -1 - np.arange(len(dense)))
        fixed = np.rint(np.concatenate([moves[touched], dense]) * FIXED).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows), *map(pa.array, fixed.T.copy())], names=["row", *(f"d{i}" for i in range(fixed.shape[1]))])

    return run


def _learn(shards: DataFrame, net: Network, settings: Settings, rates: list, weight: dict, salt: int) -> None:
    """Add to the network the mean move of the shards that move a row of weights."""
    names = [f"d{i}" for i in range(settings.dim)]
    sent = shards.sparkSession.sparkContext.broadcast(net)
    moves = shards.mapInArrow(_moved(sent, settings, rates, weight, salt), "row long, " + ", ".join(f"{x} long" for x in names))
    sums = moves.groupBy("row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in names]).toArrow()
    row, n = (sums.column(k).to_numpy() for k in ("row", "n"))
    mean = np.stack([sums.column(x).to_numpy() for x in names], 1) / FIXED / n[:, None]
    net.embed[row[row > 0]] += mean[row > 0].astype(np.float32)
    dense = _dense(net)
    dense[-1 - row[row < 0]] += mean[row < 0]
    _set_dense(net, dense)
    sent.destroy()


def _calibrate(scored: DataFrame) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the raw scores of (raw, label): Newton steps with a prior that
    keeps the slope small, halved while they do not help. Sums are exact, so that reruns agree."""
    exact = lambda x: F.sum(x.cast(EXACT)).cast("double")
    n, positives, total = scored.agg(F.count(F.lit(1)), F.sum("label"), exact(F.col("raw"))).first()
    mean = total / n
    scale = float(np.sqrt(scored.agg(exact((F.col("raw") - mean) ** 2)).first()[0] / n)) + 1e-6
    x = (F.col("raw") - F.lit(mean)) / F.lit(scale)
    soft = F.when(F.col("label") > 0, (positives + 1) / (positives + 2)).otherwise(1 / (n - positives + 2))
    prior = np.array([0.05, 1e-6])

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = F.col("x") * F.lit(float(w[0])) + F.lit(float(w[1]))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
        more = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        gap, curve = F.col("p") - F.col("soft"), F.col("p") * (1 - F.col("p"))
        sums = (
            scored.select(x.alias("x"), soft.alias("soft")).withColumns({"loss": more - F.col("soft") * z, "p": p})
            .agg(exact(F.col("loss")), *(exact(e) for e in (gap * F.col("x"), gap, curve * F.col("x") ** 2, curve * F.col("x"), curve))).first()
        )
        gradient = np.array(sums[1:3]) + prior * w
        return sums[0] + float((prior * w * w).sum()) / 2, gradient, np.array([sums[3:5], sums[4:6]]) + np.diag(prior + 1e-9)

    w = np.array([1.0, 0.0])
    loss, gradient, curve = at(w)
    for _ in range(100):
        move, step = np.linalg.solve(curve, gradient), 1.0
        while (tried := at(w - step * move))[0] > loss and step > 1e-6:
            step /= 2
        w = w - step * move
        loss, gradient, curve = tried
        if np.abs(step * move).max() < 1e-6 or step <= 1e-6:
            break
    slope = max(float(w[0]) / scale, 1e-6)
    return slope, float(w[1]) - slope * mean


def _thresholds(scored: DataFrame, net: Network) -> dict:
    """For each language the threshold with the best F1 on the calibration part, of several equal
    ones the nearest to THRESHOLD; a language with fewer than ten toxic texts keeps that."""
    z = F.col("raw") * F.lit(float(net.slope)) + F.lit(float(net.offset))
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    above = [F.col("score") >= F.lit(float(t)) for t in GRID]
    counts = (
        scored.filter("lang is not null").withColumn("score", score).groupBy("lang")
        .agg(
            F.sum("label").alias("toxic"), F.array(*[F.count_if(a & (F.col("label") > 0)) for a in above]).alias("hits"),
            F.array(*[F.count_if(a) for a in above]).alias("called"),
        )
        .filter("toxic >= 10")
    )
    out = {}
    for r in sorted(counts.collect(), key=lambda r: r["lang"]):
        f1 = [2 * h / max(1, n + r["toxic"]) for h, n in zip(r["hits"], r["called"])]
        best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-12)
        out[r["lang"]] = float(GRID[best[np.abs(GRID[best] - THRESHOLD).argmin()]])
    return out


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Network:
    """Fit on all documents whose label may be learnt, whole texts; a part of them by a hash of the id calibrates.

    ``labels`` has (doc_id, toxic); rows with a null label or a null text are not used. Without two classes every score
    is 1 or 0, what most labels are (0 without labels)."""
    turn = F.xxhash64(F.lit(settings.seed), "doc_id")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") > 0).cast("int").alias("label"))
        .filter("label is not null")
        .filter(~F.coalesce(held_out(), F.lit(True)))
    )
    # One join for every size, stored: texts that cannot be learnt stay out of it, the others move once.
    rows = c.store(
        docs.filter(~F.coalesce(held_out(), F.lit(True))).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
        .filter("text is not null")
        .join(marks.hint("merge"), "doc_id")
        .select(
            turn.alias("turn"), F.xxhash64("text").alias("th"), "label", "lang", "text",
            (F.pmod(turn, F.lit(1000)) >= int(1000 * settings.calibration)).alias("learn"),
        )
    )
    counted = rows.select("label", "learn", "text").mapInArrow(_counted, "key long, learn boolean, toxic long, other long")
    counts = c.store(counted.groupBy("key", "learn").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    totals = {r["learn"]: (r["toxic"], r["other"]) for r in counts.filter("key = 0").collect()}
    apart = len(totals) == 2 and all(min(both) > 0 for both in totals.values())  # else all texts are learnt, and calibrate
    toxic, other = totals[True] if apart else np.sum([(0, 0), *totals.values()], axis=0).tolist()
    if not toxic or not other:
        net = _empty(settings, np.zeros(0, np.uint64))
        net.out[:] = 0
        net.shift, net.slope, net.offset = 0.0, 0.0, 30.0 if toxic else -30.0
        return net
    train_rows = toxic + other
    kept = counts.filter("key <> 0")
    kept = kept.filter("learn") if apart else kept.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    share = (F.col("toxic") + F.col("other")) / F.lit(train_rows)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * F.lit(1 / toxic + 1 / other))
    kept = kept.withColumn("lean", (F.col("toxic") / F.lit(toxic) - F.col("other") / F.lit(other)) / error)
    kept = kept.filter((F.abs("lean") >= settings.min_lean) & (F.col("toxic") + F.col("other") >= settings.min_texts))
    table = kept.select("key", "lean").toArrow().sort_by("key")  # the model's hashes
    net = _empty(settings, table.column("key").to_numpy().astype(np.int64).view(np.uint64))
    # The more texts, the more standard errors a lean is.
    lean = table.column("lean").to_numpy() * min(1.0, np.sqrt(settings.shard / train_rows))
    net.embed[1:, 0] = np.clip(lean / 10, -1, 1)

    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = "turn long, th long, label int, lang string, learn boolean, ids binary, words long"
    texts = c.store(rows.mapInArrow(_numbered(sent), schema))
    own = texts.filter("learn") if apart else texts
    words = own.agg(F.sum("words")).first()[0] or 0
    n = max(1, -(-train_rows // settings.shard), -(-words // settings.shard_words))
    epochs = max(settings.epochs, -(-settings.steps * settings.batch // train_rows))
    rates = [settings.rate * (1 - epoch / epochs) for epoch in range(epochs)]
    weight = {1: 0.5 * train_rows / toxic, 0: 0.5 * train_rows / other}
    dealt = own.select("turn", "th", "label", "ids", F.pmod(F.shiftrightunsigned("turn", 12), F.lit(n)).cast("int").alias("_shard"))
    shards = dealt.repartitionById(n, "_shard").drop("_shard").persist(StorageLevel.DISK_ONLY)
    # A single shard takes all passes in one task.
    for k, some in enumerate([rates] if n == 1 else [[r] for r in rates]):
        _learn(shards, net, settings, some, weight, k)
    shards.unpersist()

    last = docs.sparkSession.sparkContext.broadcast(net)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = last.value.tables()
        for batch in batches:
            starts = range(0, batch.num_rows, 64)
            found = [last.value.raw(*_texts(batch, last.value, range(a, min(a + 64, batch.num_rows))), tables) for a in starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0), *found])), batch.column("label"), batch.column("lang")], names=["raw", "label", "lang"]
            )

    unseen = texts.filter("NOT learn") if apart else texts
    scored = c.store(unseen.select("label", "lang", "ids").mapInArrow(raw, "raw double, label int, lang string"))
    net.slope, net.offset = _calibrate(scored)
    net.thresholds = _thresholds(scored, net)
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """Add ``score`` (0 to 1) and ``flagged`` (at or above the threshold of the row's language).

    Only the text decides the score; every word of it counts. A null or empty text gets the score of
    a text without known words. Rows that repeat get equal scores. Columns named score or flagged
    are replaced; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)  # the words that lean to a class
    docs = docs.drop("score", "flagged")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        tables = net.tables()
        for batch in batches:
            parts = [np.zeros(0)]
            for _, _, data, offsets in c.slices(batch, "text", c.SLICE_BYTES // 2):
                hashes, first = c.plain_words(data, offsets, PREFIXES)
                parts.append(net.score(net.raw(*net.padded(net.ids(hashes), first), tables)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(parts))], names=[*batch.schema.names, "score"]
            )

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    scored = docs.mapInArrow(run, schema)
    return scored.withColumn("flagged", F.col("score") >= _threshold(net))


def _threshold(net: Network) -> Column:
    out = F.lit(THRESHOLD)
    for lang, value in net.thresholds.items():
        out = F.when(F.col("lang") == lang, value).otherwise(out)
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1

