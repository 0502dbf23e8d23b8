"""Merkle manifest of a dataset: content-addressed records, and proofs by descent from the root.

``H`` is the lowercase hex SHA-256 of its inputs joined; digests enter as hex text. Every row is a leaf. The leaves of
a source, by ascending doc_id, are the bottom of a 16-ary tree whose top is the source's subroot; the subroots,
by source, are the bottom of another tree with the root on top. A level's nodes are stored as records
(digest, children). A proof is made top down: leaf requests enter at the root, at each record the rank's
hexadecimal digit picks a child, the children that it doesn't pick are collected, and the segments of the
path are reversed at the end. Requests that share a prefix of their digits travel as one row, so each record
is met once, however many leaves below it are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
TEXT, INTEGER = "text", "integer"
FIELDS = {"doc_id": INTEGER, "source": TEXT, "lang": TEXT, "n_chars": INTEGER, "text": TEXT}
# A segment: the digests left and right of the path, each side joined.
SEGMENTS = "array<struct<left:string,right:string>>"


def leaf(fields: dict[str, Column] | None = None) -> Column:
    """Digest of a row: ``-`` for a null, else UTF-8 byte count, ``:`` and the value; integers as decimals."""
    columns = fields or {name: F.col(name) for name in FIELDS}
    texts = [columns[name].cast("string") for name in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(column: str = "text") -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _height(n: Column) -> Column:
    """Levels above n nodes."""
    powers = [1 << (FANOUT_BITS * k) for k in range(63 // FANOUT_BITS + 1)]
    return sum(((n > F.lit(p)).cast("int") for p in powers[1:]), (n > F.lit(1)).cast("int"))


@dataclass(frozen=True)
class Tree:
    """``records``: (level, digest, children) of all groups, each digest once a level. ``tops``: (grp, height, n,
    digest). ``depth``: the largest height."""

    records: dict[int, DataFrame]
    tops: DataFrame
    depth: int


def build(nodes: DataFrame) -> Tree:
    """Trees over ``nodes`` (grp, rank, n, digest): rank counts from 0 in the group, n is the group's size.

    One aggregate a level, each a sixteenth of the one below; a group ends when one node is left."""
    level, records, tops = 0, {}, []
    nodes = nodes.withColumn("height", _height(F.col("n")))
    while True:
        tops.append(nodes.filter(F.col("height") == level).select("grp", "height", "n", "digest"))
        below = nodes.filter(F.col("height") > level)
        if below.isEmpty():
            break
        level += 1
        # At most sixteen children; the sort puts them in order of rank.
        children = F.array_sort(F.collect_list(F.struct("rank", "digest")))["digest"]
        parents = below.groupBy("grp", F.shiftright("rank", FANOUT_BITS).alias("rank"), "n", "height").agg(
            children.alias("children")
        )
        nodes = c.store(parents.withColumn("digest", F.sha2(F.array_join("children", ""), 256)))
        records[level] = nodes.select("digest", "children").dropDuplicates(["digest"])
    out = tops[0]
    for top in tops[1:]:
        out = out.unionByName(top)
    return Tree(records, out, level)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the rows given, with ``leaf``, ``grp`` (place of the source), ``rank`` in the source, ``n`` (size of
    the source). ``sources``: (grp, source, n, height, subroot). ``tree`` is over the leaves, ``top`` over subroots."""

    leaves: DataFrame
    sources: DataFrame
    tree: Tree
    top: Tree
    root: str | None


def manifest(rows: DataFrame) -> Manifest:
    """Manifest of ``rows`` with doc_id, source and leaf; other columns are carried along.

    Ids ascend with nulls first; rows of one source and id go by leaf, and rows that agree in that too
    are interchangeable. A null source comes first and is a source of its own. An empty table has no root."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_row")]
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = c.running_total(rows, order, F.lit(1), "_place").drop("_row")
    sizes = c.store(placed.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    sizes = c.running_total(sizes, [F.col("source").asc_nulls_first()], F.lit(1), "_grp")
    sizes = c.running_total(sizes, ["_grp"], F.col("n"), "_until")
    sizes = c.store(
        sizes.select("source", "n", (F.col("_grp") - 1).alias("grp"), (F.col("_until") - F.col("n")).alias("_first"))
    )
    named = sizes.withColumnRenamed("source", "_source")
    leaves = c.store(
        placed.join(named, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rank", F.col("_place") - 1 - F.col("_first"))
        .drop("_place", "_first", "_source")
    )
    tree = build(leaves.select("grp", "rank", "n", F.col("leaf").alias("digest")))
    tops = c.store(tree.tops.withColumnRenamed("digest", "subroot"))
    sources = tops.join(sizes.select("grp", "source"), "grp")
    count = tops.count()
    top = build(
        tops.select(
            F.lit(0).cast("long").alias("grp"), F.col("grp").alias("rank"),
            F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"),
        )
    )
    row = top.tops.first()
    return Manifest(leaves, sources, tree, top, row["digest"] if row else None)


def _descend(frontier: DataFrame, wanted: DataFrame, records: DataFrame) -> DataFrame:
    """From nodes (grp, rank, digest, path, subroot) to the wanted ones a level below (grp, rank).

    The record of a digest gives the children; the last digit of a wanted rank picks one, the rest become
    a segment of the path."""
    digit = F.col("w.rank").bitwiseAND(FANOUT - 1).cast("int")
    picked = (
        frontier.join(records, "digest")
        .alias("f")
        .join(
            wanted.select("grp", "rank", F.shiftright("rank", FANOUT_BITS).alias("up")).alias("w"),
            (F.col("f.grp") == F.col("w.grp")) & (F.col("f.rank") == F.col("w.up")),
        )
    )
    left = F.array_join(F.slice("children", F.lit(1), digit), "")
    right = F.array_join(F.slice("children", digit + 2, F.lit(FANOUT)), "")
    segment = F.array(F.struct(left.alias("left"), right.alias("right")))
    return picked.select(
        "w.grp", "w.rank", F.get("children", digit).alias("digest"), F.concat("path", segment).alias("path"), "subroot"
    )


def prove(made: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (grp and rank of leaves, further columns pass through) with ``root``, ``subroot`` and ``siblings``:
    the segments of the path from the leaf up, each with the digests left and right of it joined.

    A lone node has no segment; a run of one has an empty one. A request for no leaf has no row."""
    spark = requests.sparkSession
    groups = requests.select("grp").distinct()
    start = spark.createDataFrame([(0, 0, made.root)] if made.root else [], "grp long, rank long, digest string")
    frontier = start.withColumns({"path": F.array().cast(SEGMENTS), "subroot": F.lit(None).cast("string")})
    for level in range(made.top.depth, 0, -1):
        below = F.shiftright("grp", FANOUT_BITS * (level - 1))
        wanted = groups.select(F.lit(0).cast("long").alias("grp"), below.alias("rank")).distinct()
        frontier = _descend(frontier, wanted, made.top.records[level])
    tops = c.store(
        frontier.select(F.col("rank").alias("grp"), "digest", "path")
        .join(made.sources.select("grp", "height", "subroot"), "grp")
        .withColumn("rank", F.lit(0).cast("long"))
    )

    def entering(level: int) -> DataFrame:
        return tops.filter(F.col("height") == level).select("grp", "rank", "digest", "path", "subroot")

    frontier = entering(made.tree.depth)
    for level in range(made.tree.depth, 1, -1):
        below = F.shiftright("rank", FANOUT_BITS * (level - 1))
        wanted = requests.select("grp", below.alias("rank")).distinct()
        frontier = _descend(frontier, wanted, made.tree.records[level]).unionByName(entering(level - 1))
        frontier = c.store(frontier)
    # The last step meets the requests themselves: the path of a run is shuffled once for its leaves.
    no_children = F.lit(None).cast("array<string>").alias("children")
    runs = entering(0).select("grp", "rank", "path", "subroot", no_children)
    if made.tree.depth:
        runs = frontier.join(made.tree.records[1], "digest").select("grp", "rank", "path", "subroot", "children").unionByName(runs)
    runs = runs.select(F.col("grp").alias("_g"), F.col("rank").alias("_up"), F.reverse("path").alias("_path"), "subroot", "children")
    digit = F.col("rank").bitwiseAND(FANOUT - 1).cast("int")
    left = F.array_join(F.slice("children", F.lit(1), digit), "")
    right = F.array_join(F.slice("children", digit + 2, F.lit(FANOUT)), "")
    lowest = F.array(F.struct(left.alias("left"), right.alias("right")))
    siblings = F.when(F.col("children").isNull(), F.col("_path")).otherwise(F.concat(lowest, F.col("_path")))
    joined = requests.join(runs, (F.col("grp") == F.col("_g")) & (F.shiftright("rank", FANOUT_BITS) == F.col("_up")))
    return joined.withColumns({"siblings": siblings, "root": F.lit(made.root)}).drop("_g", "_up", "_path", "children")


def proof_text(siblings: str = "siblings") -> Column:
    """All siblings from the leaf to the root, left to right, joined."""
    return F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), "")


def fold(digest: Column, siblings: str = "siblings") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def audit(docs: DataFrame, tampered: Column) -> DataFrame:
    """Prove every row of ``docs`` and fold it back, rows where ``tampered`` holds with their text in lower case.

    doc_id, leaf, subroot, root, siblings, folded_root and verified (the folded root is the root). A null
    ``tampered`` is false; other columns are ignored; an empty table gives no rows."""
    columns = {name: F.col(name) for name in FIELDS}
    changed = F.when(F.coalesce(tampered, F.lit(False)), leaf({**columns, "text": lower_ascii()}))
    rows = docs.select("doc_id", "source", leaf().alias("leaf"), changed.alias("_changed"))
    made = manifest(rows)
    proofs = prove(made, made.leaves.drop("source", "n"))
    folded = fold(F.coalesce("_changed", "leaf"))
    return proofs.withColumn("folded_root", folded).select(
        "doc_id", "leaf", "subroot", "root", "siblings", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle(levels: int = 8, top_levels: int = 4) -> str:
    """DuckDB SQL for ``op12_merkle_manifest``: the trees level by level, siblings by joins of levels."""

    def text(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    plain = " || ".join(text(f"CAST({n} AS VARCHAR)" if k == INTEGER else n) for n, k in FIELDS.items())
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = " || ".join(
        text(lowered if n == "text" else f"CAST({n} AS VARCHAR)" if k == INTEGER else n) for n, k in FIELDS.items()
    )
    ctes = [
        "crc_table AS (SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [0, 1, 2, 3, 4, 5, 6, 7]), "
        "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i))",
        f"rows_ AS (SELECT doc_id, source, sha256({plain}) AS leaf, sha256({changed}) AS lowered, "
        "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS codes FROM documents)",
        "hashed AS (SELECT r.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), codes), "
        "lambda a, b: xor(t[CAST((xor(a, b) & 255) AS INTEGER) + 1], a >> 8)), 4294967295) AS crc FROM rows_ r, crc_table)",
        "leaves AS (SELECT doc_id, source, leaf, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS used, "
        "dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, "
        "count(*) OVER (PARTITION BY source) AS n FROM hashed)",
        "a0 AS (SELECT grp, rank, n AS open_, leaf AS digest FROM leaves)",
    ]
    for name, depth in (("a", levels), ("b", top_levels)):
        if name == "b":
            ctes.append(
                f"b0 AS (SELECT 0 AS grp, grp AS rank, count(*) OVER () AS open_, digest FROM a{levels})"
            )
        for k in range(depth):
            ctes.append(
                f"{name}{k + 1} AS (SELECT grp, rank // 16 AS rank, (open_ + 15) // 16 AS open_, "
                f"CASE WHEN open_ > 1 THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE max(digest) END AS digest "
                f"FROM {name}{k} GROUP BY grp, rank // 16, open_)"
            )
            ctes.append(
                f"{name}{k}s AS (SELECT x.grp, x.rank, x.open_ > 1 AS hashed, "
                f"coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank < x.rank), '') AS l, "
                f"coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank > x.rank), '') AS r "
                f"FROM {name}{k} x JOIN {name}{k} y ON x.grp = y.grp AND x.rank // 16 = y.rank // 16 GROUP BY ALL)"
            )
    ctes.append("f0 AS (SELECT doc_id, leaf, grp, rank, used AS acc, '' AS proof FROM leaves)")
    step = 0
    for name, depth in (("a", levels), ("b", top_levels)):
        for k in range(depth):
            here = f"f.rank // {16**k}" if name == "a" else f"f.grp // {16**k}"
            grp = "f.grp" if name == "a" else "0"
            ctes.append(
                f"f{step + 1} AS (SELECT doc_id, leaf, f.grp, f.rank, CASE WHEN hashed THEN sha256(l || acc || r) ELSE acc END AS acc, "
                f"CASE WHEN hashed THEN proof || l || r ELSE proof END AS proof "
                f"FROM f{step} f JOIN {name}{k}s s ON s.grp = {grp} AND s.rank = {here})"
            )
            step += 1
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, a.digest AS subroot, b.digest AS root, sha256(proof) AS proof_sha256, "
        f"acc AS folded_root, acc = b.digest AS verified FROM f{step} f JOIN a{levels} a ON a.grp = f.grp, b{top_levels} b"
    )


SQL = oracle()
