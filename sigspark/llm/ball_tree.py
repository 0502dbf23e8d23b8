"""Exact top-k inner-product search: a ball tree per shard, branch and bound, a shared k-th score.

Vectors are dealt into shards of bounded size, queries into blocks of bounded size. Every block
first meets one shard, which gives each query a k-th score; with it as the score to beat it then
meets the other shards, most of whose balls cannot reach it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as c

SHARD = 4096
BLOCK = 4096
LEAF = 64
NONE = -(1 << 63)
EXACT = float(1 << 52)


class BallTree:
    """Balls around halves of halves of the vectors; leaves hold up to LEAF, or equal ones."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        if len(vectors):
            self._grow(np.arange(len(vectors)))

    def _grow(self, rows: np.ndarray) -> int:
        points = self.vectors[rows]
        center = points.mean(axis=0)
        far = np.sqrt(((points - center) ** 2).sum(axis=1))
        node = len(self.rows)
        self.center.append(center)
        self.radius.append(float(far.max()))
        self.rows.append(rows)
        self.children.append(None)
        if len(rows) > LEAF:
            a = points[far.argmax()]
            to_a = ((points - a) ** 2).sum(axis=1)
            b = points[to_a.argmax()]
            left = to_a <= ((points - b) ** 2).sum(axis=1)
            if left.all():
                return node
            if min(left.sum(), len(left) - left.sum()) * 16 < len(left):
                # A lopsided cut makes deep trees: cut the same direction at its median.
                along = points @ (b - a)
                half = np.argsort(along, kind="stable")
                left = np.zeros(len(rows), bool)
                left[half[: len(rows) // 2]] = True
            self.children[node] = (self._grow(rows[left]), self._grow(rows[~left]))
        return node


class TopK:
    """The best k of each query so far; ties go to the smaller id, then the smaller row."""

    def __init__(self, tree: BallTree, ids, rows, queries, own, floor, k: int):
        self.tree, self.ids, self.rows, self.queries, self.own, self.k = tree, ids, rows, queries, own, k
        self.norm = np.sqrt((queries**2).sum(axis=1))
        self.score = np.full((len(queries), k), -np.inf)
        self.at = np.full((len(queries), k), -1)
        self.floor = floor.copy()
        if len(ids) and len(queries):
            self.rank = np.empty(len(ids), np.int64)  # place of each vector among the ties
            self.rank[np.lexsort((rows, ids))] = np.arange(len(ids))
            self.visit(0, np.arange(len(queries)))

    def bound(self, node: int, active: np.ndarray) -> np.ndarray:
        reach = self.norm[active] * self.tree.radius[node]
        value = self.queries[active] @ self.tree.center[node] + reach
        return value + 1e-9 * (np.abs(value) + reach) + 1e-3

    def visit(self, node: int, active: np.ndarray) -> None:
        """Depth first, for all queries that the ball can still help; each goes to the child with
        the larger bound first."""
        active = active[self.bound(node, active) >= self.floor[active]]
        if not len(active):
            return
        if self.tree.children[node] is None:
            self.leaf(self.tree.rows[node], active)
            return
        one, two = self.tree.children[node]
        first = self.bound(one, active) >= self.bound(two, active)
        self.visit(one, active[first])
        self.visit(two, active[~first])
        self.visit(two, active[first])
        self.visit(one, active[~first])

    def leaf(self, members: np.ndarray, active: np.ndarray) -> None:
        scores = self.queries[active] @ self.tree.vectors[members].T
        scores[self.rows[members][None, :] == self.own[active][:, None]] = -np.inf
        scores[scores < self.floor[active][:, None]] = -np.inf
        some = np.isfinite(scores).any(axis=1)
        active, scores = active[some], scores[some]
        if not len(active):
            return
        both = np.concatenate((self.score[active], scores), axis=1)
        at = np.concatenate((self.at[active], np.broadcast_to(members, scores.shape)), axis=1)
        order = np.lexsort((self.rank[at], -both), axis=1)[:, : self.k]
        self.score[active] = np.take_along_axis(both, order, 1)
        self.at[active] = np.take_along_axis(at, order, 1)
        self.floor[active] = np.maximum(self.floor[active], self.score[active, -1])


def _matrix(table: pa.Table, column: str, exact: bool) -> np.ndarray:
    values = table.column(column).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    flat = np.asarray(values.flatten()).reshape(len(table), -1)
    return flat.astype(np.float64 if exact else object)


FOUND = "qrow long, query_id long, row long, vec_id long, score long"
FOUND_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in FOUND.split(", ")])


def _search(k: int):
    def run(key, shard: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(shard) or not len(queries):
            return FOUND_ARROW.empty_table()
        largest = max(
            float(np.abs(np.asarray(t.column("v").combine_chunks().flatten(), np.float64)).max(initial=0))
            for t in (shard, queries)
        )
        if largest**2 * max(1, key[0].as_py()) > EXACT:
            return _plain(shard, queries, k)
        tree = BallTree(_matrix(shard, "v", True))
        ids, rows = (shard.column(x).to_numpy() for x in ("vec_id", "row"))
        floor = queries.column("floor").to_numpy().astype(np.float64)
        floor[queries.column("floor").to_numpy() == NONE] = -np.inf
        best = TopK(tree, ids, rows, _matrix(queries, "v", True), queries.column("qrow").to_numpy(), floor, k)
        q, j = np.nonzero(np.isfinite(best.score))
        at = best.at[q, j]
        return pa.Table.from_arrays(
            [
                pa.array(queries.column("qrow").to_numpy()[q]),
                pa.array(queries.column("query_id").to_numpy()[q]),
                pa.array(rows[at]),
                pa.array(ids[at]),
                pa.array(best.score[q, j].astype(np.int64)),
            ],
            schema=FOUND_ARROW,
        )

    return run


def _plain(shard: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """Scores beyond the exact range of doubles: whole numbers of any size, cut to a long."""
    ids, rows = (shard.column(x).to_pylist() for x in ("vec_id", "row"))
    vectors = shard.column("v").to_pylist()
    out = []
    for q in queries.to_pylist():
        scores = [
            (-max(NONE, min(-NONE - 1, sum(a * b for a, b in zip(q["v"], v)))), i, r)
            for v, i, r in zip(vectors, ids, rows)
            if r != q["qrow"]
        ]
        for s, i, r in sorted(scores)[:k]:
            out.append({"qrow": q["qrow"], "query_id": q["query_id"], "row": r, "vec_id": i, "score": -s})
    return pa.Table.from_pylist(out, FOUND_ARROW)


def whole_components(embedding: str = "embedding", scale: int = 1024) -> Column:
    """floor(scale * x) of every component as long; null if the vector takes no part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= 2.0**1000))
    far = F.lit(2.0**62)
    whole = F.transform(
        embedding,
        lambda x: F.floor(F.least(far, F.greatest(-far, x.cast("double") * F.lit(float(scale))))).cast("long"),
    )
    return F.when(F.col(embedding).isNotNull() & finite, whole)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, without its own row.

    ``vectors`` has vec_id and v (whole components); rows with a null v take no part. Only vectors of
    the same length are compared; two empty vectors score 0. Ties go to the smaller vec_id, null
    first. A query with fewer than k others returns all. Rows that repeat are rows of their own:
    each is answered, and each is a candidate for the others. Components are cut to 2**62 and scores
    to a long. Other columns are ignored; an empty table gives no rows.
    """
    rows = c.store(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            "v",
            F.size("v").alias("dim"),
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        ).filter("v is not null")
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    shards, blocks = max(1, math.ceil(size["n"] / SHARD)), max(1, math.ceil(size["q"] / BLOCK))

    queries = rows.filter("asks").select(
        "dim", F.col("row").alias("qrow"), F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    )
    shard = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards))
    key = ["dim", "shard", "block"]
    dealt = rows.select("dim", "row", "vec_id", "v", shard.alias("shard"))

    def search(asked: DataFrame, met: DataFrame) -> DataFrame:
        # Fresh names on one side: both come from the same rows.
        asked, met = (x.select(*[F.col(n).alias(n) for n in x.columns]) for x in (asked, met))
        return met.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_search(k), FOUND)

    home = F.pmod(F.col("block"), F.lit(shards))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    met = dealt.withColumn("block", every(blocks))
    start = c.store(
        search(
            queries.withColumns({"shard": home, "floor": F.lit(NONE)}), met.filter(F.col("shard") == home)
        )
    )
    floors = start.groupBy("qrow").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(NONE)).alias("floor")
    )
    again = (
        queries.join(floors, "qrow", "left")
        .withColumn("floor", F.coalesce("floor", F.lit(NONE)))
        .withColumn("shard", every(shards))
        .filter(F.col("shard") != home)
    )
    found = start.unionByName(search(again, met.filter(F.col("shard") != home)))
    order = Window.partitionBy("qrow").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_first(), "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
