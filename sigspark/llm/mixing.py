"""Mixing sources to target weights by weighted fair queueing.

Each source lists its documents in a shuffled order, up to ``PASSES`` times over. A copy's virtual
finish time is the source's words up to and with it, divided by the source's target. The copies of
all sources are sorted by that time and cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

WORD = r"[^\x20\x09-\x0D]+"
PASSES = 3
WEIGHTS = (1, 2, 3)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget: int, passes: int = PASSES) -> DataFrame:
    """Add ``target`` to sources with ``source_size`` and ``weight``: shares of the budget by weight,
    none above ``passes`` times its source; what is above is shared again by weight.

    The level, words for each unit of weight, rises until no further source reaches its limit; each
    step is one aggregate over the sources."""
    limit, level = F.col("source_size") * passes, 0.0
    while True:
        full = limit < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, limit)).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        if not row["open"]:
            return sources.withColumn("target", limit.cast("double"))
        higher = max(0, budget - (row["taken"] or 0)) / row["open"]
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))


def mix(
    docs: DataFrame, size: Column | None = None, passes: int = PASSES, weights: tuple = WEIGHTS, seed: int = 42
) -> DataFrame:
    """``docs`` with size, source_size, target and copies (times the mix takes the document).

    Sources in code point order, null last, weigh ``weights`` in turn; the budget is all words of the
    input. Sizes are whole-text word counts, 0 for a null text, unless ``size`` says otherwise. A document without words is never
    taken and a source without words has target 0. The order within a source is that of a seeded
    hash of the id, then id and size, so it does not depend on how the table is split; rows that
    agree in all of these are interchangeable. The mix ends before the first copy that would pass
    the budget. Other columns pass through, except size, source_size, target and copies, which are
    replaced. An empty table gives no rows.
    """
    names = ["size", "source_size", "target", "copies"]
    rows = docs.withColumn("_size", word_count() if size is None else size).drop(*names)
    rows = c.store(rows.withColumn("_row", F.monotonically_increasing_id()).withColumnRenamed("_size", "size"))
    kept = [k for k in rows.columns if k not in ("_row", "size")]
    small = rows.select("_row", F.col("doc_id").cast("long").alias("id"), "source", "size")

    sources = c.store(small.groupBy("source").agg(F.sum("size").alias("source_size")))
    order = [F.col("source").isNull(), F.col("source")]
    sources = c.running_total(sources, order, F.lit(1), "rank")
    sources = c.store(
        sources.withColumn(
            "weight", F.get(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights)).cast("int"))
        )
    )
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    sources = c.store(targets(sources, budget, passes))
    ends = c.running_total(sources, ["rank"], F.col("source_size"), "_until")
    ends = c.store(ends.withColumn("_first", F.col("_until") - F.col("source_size")).drop("_until", "weight"))

    shuffled = (
        small.filter("size > 0")
        .join(ends.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_h", F.xxhash64(F.lit(seed), "id"))
    )
    place = ["rank", "_h", "id", "size", "_row"]
    listed = c.running_total(
        shuffled.select(*place, "_first", "source_size", "target"), place, F.col("size"), "_words"
    )
    finish = (
        (F.col("_words") - F.col("_first") + F.col("_pass") * F.col("source_size")).cast("double") / F.col("target")
    )
    copies = listed.filter("target > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    queue = copies.select("_row", "size", "rank", "_h", finish.alias("finish"), "id", "_pass")
    mixed = c.running_total(queue, ["finish", "rank", "_h", "id", "_pass", "_row"], F.col("size"), "_total")
    taken = mixed.filter(F.col("_total") <= budget).groupBy("_row").agg(F.count(F.lit(1)).alias("copies"))
    per_source = ends.select(F.col("source").alias("_s"), "source_size", "target")
    return (
        rows.join(per_source, F.col("source").eqNullSafe(F.col("_s")))
        .join(taken, "_row", "left")
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
        .select(*kept, *names)
    )
