"""Near-duplicate documents by MinHash with tensored banding; every link is confirmed on full sets.

Two small collections of ``SIDE`` keys each, a key being ``PART`` minhashes, are combined pairwise
into ``SIDE * SIDE`` table keys of ``2 * PART`` minhashes: 2 * SIDE * PART minhashes do the work of
SIDE * SIDE * 2 * PART. Documents meet if a key of each collection agrees, so two documents of
similarity s are missed with a chance of about 2 * (1 - s ** PART) ** SIDE: 5e-6 at 0.85, 4e-5
at 0.8.

Equal sets are one class before any key is made. In a bucket not all pairs are compared, only as
many as decide which members are connected: a pivot takes its links, members that are connected
by then need no more comparison, and the rest gets new pivots, GROWTH times as many in each round.
Buckets of few members compare all pairs that are not connected yet.

Before full sets are fetched, an odd sketch rules pairs out: one bit for each of ODD_BITS parts of the
hash range, set if the set has an odd number of members in it. The bits in which two sketches
differ are at most as many as the shingles that only one document has, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

SIDE = 10
PART = 2
SMALL_BUCKET = 64
PIVOTS, GROWTH = 16, 8
ODD_BITS = 512
ODD = [f"o{i}" for i in range(ODD_BITS // 64)]

SEEDS = c.mix(np.arange(2 * SIDE * PART, dtype=np.uint64), 11)
FACTORS = c.mix(np.arange(2 * SIDE * PART, dtype=np.uint64), 12) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, and their offsets. Words are folded to
    lower case (A-Z); a document with fewer words than a shingle has its whole sequence as one."""
    starts, ends, first = c.find_words(data, offsets)
    hashes = c.hash_words(data, starts, ends, lower=True)
    counts = np.diff(first)
    at = c.spread(first[:-1], np.where(counts >= words, counts - words + 1, np.minimum(counts, 1)))
    row = np.searchsorted(first, at, "right") - 1
    values = c.Rolling(hashes).ranges(at, at + np.minimum(words, counts[row]), 2)
    return c.distinct_per_row(values, row, len(offsets) - 1)


def signatures(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the set, 2 * SIDE keys) of each document; zeros for an empty set."""
    n = len(offsets) - 1
    node = np.zeros(n, np.uint64)
    keys = np.zeros((n, 2 * SIDE), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return node, keys
    at = offsets[full]
    node[full] = c.mix(np.add.reduceat(c.mix(values, 5), at), 6)
    for i in range(2 * SIDE):
        key = np.full(len(full), i, np.uint64)
        for j in range(i * PART, (i + 1) * PART):
            key = c.mix(key ^ np.minimum.reduceat((values ^ SEEDS[j]) * FACTORS[j], at), 8)
        keys[full, i] = key
    return node, keys


def odd_sketches(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Parity of the number of members in each part of the hash range, as 64-bit words."""
    n = len(offsets) - 1
    out = np.zeros((n, len(ODD)), np.uint64)
    part = (c.mix(values, 9) >> np.uint64(64 - ODD_BITS.bit_length() + 1)).astype(np.int64)
    for a in range(0, n, 1024):
        b = min(n, a + 1024)
        row = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
        counts = np.bincount(row * ODD_BITS + part[offsets[a] : offsets[b]], minlength=(b - a) * ODD_BITS)
        out[a:b] = np.packbits((counts & 1).astype(np.uint8)).view(np.uint64).reshape(b - a, -1)
    return out


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, data, offsets in c.slices(batch, "text"):
                values, ends = shingles(data, offsets, words)
                node, keys = signatures(values, ends)
                odd = c.signed(odd_sketches(values, ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(at, rows) for k in ("doc_id", "did", "th")),
                        pa.array(np.diff(ends)),
                        pa.array(c.signed(node)),
                        c.list_array(c.signed(keys.reshape(-1)), np.arange(rows + 1) * 2 * SIDE),
                        *(pa.array(np.ascontiguousarray(odd[:, i])) for i in range(len(ODD))),
                    ],
                    names=["doc_id", "did", "th", "n", "node", "keys", *ODD],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, data, offsets in c.slices(batch, "text"):
                values, ends = shingles(data, offsets, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(at, rows), c.list_array(c.signed(values), ends)],
                    names=["node", "items"],
                )

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node reachable, for every node of the links ``(a, b)``.

    Nodes take the least label next to them and then the label of their label, until nothing
    changes; only counts reach the driver."""
    both = c.store(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = c.store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        moved = c.store(
            lower.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        )
        done = moved.filter("label <> old").isEmpty()
        labels = moved.select("node", "label")
        if done:
            return labels


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``(a, b)``, those whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - F.col("common")
    return (
        pairs.select("a", "b")
        .join(right, "b")
        .join(left, "a")
        .select("a", "b", common.alias("common"), "x", "y")
        .filter(F.col("common") * 100 >= union * percent)
        .select("a", "b")
        .distinct()
    )


def _may_link(percent: int, a: str, b: str):
    """Whether sizes and odd sketches of the structs ``a`` and ``b`` allow a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{o}").bitwiseXOR(F.col(f"{b}.{o}"))) for o in ODD), F.lit(0))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (
        apart * (100 + percent) <= (na + nb) * (100 - percent)
    )


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the labels at the two ends of each link were joined."""
    of = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    to = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    ends = links.join(of, "a").join(to, "b").filter("la <> lb")
    merged = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("joined"))
    return c.store(
        labels.join(merged, "label", "left").select("node", F.coalesce("joined", "label").alias("label"))
    )


def _connect(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) for the nodes of all buckets; ``members`` has ``key, node, n`` and the sketch."""
    own = F.struct("node", "n", *ODD)
    # First each node against the least node of most of its buckets.
    hubs = members.groupBy("key").agg(F.min(own).alias("p"))
    first = (
        members.select("key", own.alias("m"))
        .join(hubs, "key")
        .filter("m.node <> p.node")
        .filter(_may_link(percent, "m", "p"))
        .groupBy(F.col("m.node").alias("b"), F.col("p.node").alias("a"))
        .count()
        .groupBy("b")
        .agg(F.max(F.struct("count", "a")).alias("best"))
        .select(F.least("best.a", "b").alias("a"), F.greatest("best.a", "b").alias("b"))
    )
    tested = [c.store(first)]
    labels = c.store(members.select("node", F.col("node").alias("label")).distinct())
    labels = _relabel(labels, _confirm(tested[0], sets, percent))
    pivots = PIVOTS
    while True:
        live = members.join(labels, "node")
        size = c.store(
            live.groupBy("key")
            .agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low <> high")
            .select("key", "size")
        )
        chance = F.abs(F.xxhash64("node", F.lit(pivots))) / F.lit(float(2**63))
        small = F.col("size") <= SMALL_BUCKET
        live = c.store(
            live.join(size, "key").withColumn("pivot", small | (chance < F.lit(float(pivots)) / F.col("size")))
        )
        if live.isEmpty():
            return labels
        sides = live.select("key", F.struct("node", "n", "label", *ODD).alias("m"), "pivot")
        ends = sides.filter("pivot").select("key", F.col("m").alias("p"))
        pairs = (
            ends.join(
                sides,
                (ends["key"] == sides["key"])
                & F.expr("p.node <> m.node and p.label <> m.label")
                & _may_link(percent, "m", "p"),
            )
            .select(F.least("p.node", "m.node").alias("a"), F.greatest("p.node", "m.node").alias("b"))
            .distinct()
        )
        for old in tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        pairs = c.store(pairs)
        tested.append(pairs)
        labels = _relabel(labels, _confirm(pairs, sets, percent))
        # A pivot was compared with its whole bucket, or is connected to what it skipped.
        members = live.filter("not pivot").select("key", "node", "n", *ODD)
        pivots *= GROWTH


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, did, th): groups of near-duplicate documents.

    A document's set has its distinct ``words``-word shingles, A-Z folded. Two documents are linked
    if 100 * intersection >= percent * union; a component is all that links reach. ``component_id``
    is the least id of the component, ``kept`` marks the row that has it. A null or empty text, or
    one of separators only, has no shingles, is linked with nothing and kept. Rows that repeat an
    id and text are kept together. Null ids count as larger than all others; if a component has
    only null ids, ``component_id`` is null and its rows are kept. ``did`` and ``th`` name the row
    (``common.row_key``). Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *c.row_key())
    signed = c.store(
        rows.mapInArrow(
            _sign(words),
            "doc_id long, did long, th long, n long, node long, keys array<long>, " + ", ".join(f"{o} long" for o in ODD),
        )
    )
    classes = c.store(
        signed.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("did", "th", "n")).alias("rep"),
            F.first("keys").alias("keys"),
            *(F.first(o).alias(o) for o in ODD),
        )
    )
    table = F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))
    keys = F.transform(
        table,
        lambda t: F.xxhash64(
            t,
            F.get("keys", (t / SIDE).cast("int")),
            F.get("keys", (F.lit(SIDE) + t % SIDE).cast("int")),
        ),
    )
    entries = classes.select("node", F.explode(keys).alias("key"))
    shared = c.store(entries.groupBy("key").count().filter("count > 1").select("key"))
    members = entries.join(shared, "key")
    members = c.store(members.join(classes.select("node", F.col("rep.n").alias("n"), *ODD), "node"))
    wanted = members.select("node").distinct().join(classes, "node").select("node", "rep.did", "rep.th")
    sets = c.store(
        rows.join(wanted, ["did", "th"]).select("node", "text").mapInArrow(_sets(words), "node long, items array<long>")
    )
    labels = _connect(members, sets, percent)
    classes = classes.select("node", "least").join(labels, "node", "left")
    classes = c.store(classes.select("node", "least", F.coalesce("label", "node").alias("label")))
    lowest = classes.groupBy("label").agg(F.min("least").alias("lowest"))
    ids = classes.join(lowest, "label").select("node", "lowest", F.lit(True).alias("linked"))
    component = F.when(F.col("linked"), F.col("lowest")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", "did", "th", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(ids, "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "did", "th")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept", "did", "th")
    )


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the least id.

    Of rows that repeat id and text one stays; rows of a group that share the least id but not the
    text all stay, as do rows of a group with null ids only, which no id names. Documents without
    words stay. Columns are unchanged, but for _did and _th, which are dropped."""
    did, th = c.row_key()
    rows = docs.drop("_did", "_th").withColumns({"_did": did, "_th": th})
    kept = near_duplicates(docs, words, percent).filter("kept")
    keys = kept.select(F.col("did").alias("_did"), F.col("th").alias("_th"))
    return rows.join(keys, ["_did", "_th"], "left_semi").dropDuplicates(["_did", "_th"]).drop("_did", "_th")
