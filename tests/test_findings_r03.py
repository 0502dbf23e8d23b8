import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm import toxicity
from sigspark.operators import tfidf as ti
from sigspark.plans import forest, linear, text_study


def test_texts_of_one_file_are_cleaned_by_several_tasks(spark):
    df = spark.range(64).select(F.col("id").alias("doc_id"), F.lit("profit rose").alias("text")).coalesce(1)
    parts = text_study.cleaned(df).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 64


def test_few_rows_reach_their_tasks_without_the_driver(spark):
    """A fit's classes are followed by a task each, to the same coefficients as in a search's one task."""
    rng = np.random.default_rng(5)
    rows = [(int(y), [float(x) for x in rng.normal(y == np.arange(3), 1.0)]) for y in rng.integers(0, 3, 90)]
    made = linear.design(spark.createDataFrame(rows, "label int, features array<double>"))
    assert isinstance(made.held, DataFrame)
    setting = (linear.Setting(),)
    alone = linear.solve(made, made.problems(setting, [-1]))
    both = linear.solve(made, made.problems(setting, [1, -1]))  # no row is in fold 1
    assert alone.converged.all() and np.allclose(alone.w, both.w[:, 3:]) and not alone.cells
    made.free()


def test_blocks_of_texts_do_not_meet_in_a_task(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(50 * n).select(ti.block_of(spark, "id", n).alias("b")).repartition(n, "b")
    parts = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("b").alias("blocks")).collect()
    assert [r["blocks"] for r in parts] == [1] * n


def test_toxicity_learns_whole_texts_and_all_of_them(spark):
    """Words behind the first 16 KB were not learnt, and no more than 4,000 texts; several shards give what one learns."""
    rows = [(i, "plain text " * 1700 * (i % 9 == 0) + ("vile " if i % 3 == 0 else "fine ") + f"w{i % 7}", "en", int(i % 3 == 0)) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    for settings in (toxicity.Settings(steps=100), toxicity.Settings(shard=150, steps=100)):
        net = toxicity.train(df, df.select("doc_id", "toxic"), settings)
        got = {r["doc_id"]: r["score"] for r in toxicity.score(df, net).collect()}
        assert np.mean([(got[i] >= 0.7) == bool(y) for i, _, _, y in rows]) > 0.98
    again = toxicity.train(df.repartition(5), df.select("doc_id", "toxic"), toxicity.Settings(shard=150, steps=100))
    assert np.array_equal(again.embed, net.embed) and again.slope == net.slope
    held = df.withColumn("text", F.when(F.length("text") < 18000, F.col("text")).otherwise(F.concat("text", F.lit(" late"))))
    long = toxicity.train(held, df.select("doc_id", "toxic"))
    late = toxicity._slices(toxicity.pa.RecordBatch.from_pydict({"text": ["late"]}))
    assert long.ids(next(late)[1])[0, 0] > 0  # a word of long texts only, all of them toxic


def test_shortened_texts_have_the_same_windows():
    rng = np.random.default_rng(4)
    first = np.array([0, 0, 9, 60, 61, 200])
    ids = (rng.integers(1, 5, (200, toxicity.PARTS)) * (rng.random((200, 1)) < 0.2)).astype(np.int32)
    net = toxicity._empty(toxicity.Settings(), np.arange(1, 9, dtype=np.uint64))
    short, ends = toxicity._short(ids, first)
    assert len(short) < 200
    np.testing.assert_allclose(net.pooled(*net.padded(short, ends)), net.pooled(*net.padded(ids, first)), rtol=1e-6)


class Alone:
    alone = True

    def add(self, values):
        return values


def sparse_rows(n=80, width=20000, entries=12):
    """Rows of few features each, some of them copies of others with another label."""
    rng = np.random.default_rng(8)
    lists = [[{"pos": int(p), "value": float(v)} for p, v in zip(rng.choice(width, entries, False), rng.integers(-2, 4, entries)) if v] for _ in range(n)]
    lists[1::10] = lists[::10]
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("value", pa.float64())]))
    columns = {"row": np.arange(n), "key": 977 * np.arange(n), "y": rng.integers(0, 3, n), "fold": np.arange(n) % 4}
    batch = pa.RecordBatch.from_arrays([pa.array(lists, kind), *map(pa.array, columns.values())], names=["features", *columns])
    return forest._Rows(iter([batch]), width), forest._Plan(width, 3, 4, (forest.NO_LIMIT, 2), 42, entries)


def test_a_node_takes_the_best_of_its_first_features_or_the_first_that_parts(monkeypatch):
    rows, plan = sparse_rows()
    made = []
    for cost in (0, 1, 1e9):  # from features to rows, some of both, from rows to features
        monkeypatch.setattr(forest, "COLUMN_COST", cost)
        grower = forest._Grower(rows, plan, Alone())
        votes = grower.grow(forest.Unit(-1, 0, 3)), forest._Grower(rows, plan, Alone()).grow(forest.Unit(2, 0, 3))
        made.append(({k: np.concatenate([x[k] for x in grower.nodes]) for k in grower.nodes[0]}, votes))
    nodes = made[0][0]
    for other, votes in made[1:]:
        assert all(np.array_equal(nodes[k], other[k]) for k in nodes) and all(map(np.array_equal, votes, made[0][1]))
    dense = np.zeros((len(rows.y), plan.n_features), int)
    dense[np.repeat(np.arange(len(rows.y)), rows.lengths), rows.cols] = rows.bins
    weight = len(rows.y) / 3 / np.bincount(rows.y)
    firsts = 0
    for tree in range(3):
        seed = 42 + 15485863 * (tree + 1)
        own = {int(nodes["node"][i]): i for i in np.flatnonzero(nodes["tree"] == tree)}
        bag = np.searchsorted(forest.POISSON, forest._hash(rows.key, seed), "right")
        reached = {0: np.flatnonzero(bag)}
        for number in sorted(own):
            i, mine = own[number], reached[number]
            salt = np.array([seed * 1000003 + number * 7919]).astype(np.uint64)
            ranks = forest._Orders(salt, plan.prime).ranks(np.zeros(plan.n_features, int), np.arange(plan.n_features))
            x, total = dense[mine], np.bincount(rows.y[mine], bag[mine], 3)
            parting = np.flatnonzero((x.min(0, initial=99) < x.max(0, initial=-99)) & (np.count_nonzero(total) > 1))
            pos, bin_ = int(nodes["pos"][i]), int(nodes["bin"][i])
            if not len(parting):
                assert pos < 0
                continue

            def purity(f, b):
                left = np.bincount(rows.y[mine], bag[mine] * (x[:, f] <= b), 3) * weight
                right = total * weight - left
                return ((left**2).sum() / left.sum() + (right**2).sum() / right.sum()) / (total * weight).sum()

            early = parting[ranks[parting] < plan.looked_at]
            firsts += not len(early)
            looked = early if len(early) else parting[[np.argmin(ranks[parting])]]
            best = max(purity(f, b) for f in looked for b in np.unique(x[:, f])[:-1])
            assert pos in looked and abs(purity(pos, bin_) - best) < 2e-9
            right = x[:, pos] > bin_
            reached[int(nodes["left_node"][i])], reached[int(nodes["right_node"][i])] = mine[~right], mine[right]
    assert firsts > 3


def test_a_tree_does_not_look_at_all_entries_on_every_level(monkeypatch):
    """All entries of all rows were looked at twice on every level, of which trees on texts have hundreds."""
    rows, plan = sparse_rows(400, 20000, 100)
    looked = []
    ranges = forest._ranges
    monkeypatch.setattr(forest, "_ranges", lambda starts, sizes: looked.append(int(np.sum(sizes))) or ranges(starts, sizes))
    grower = forest._Grower(rows, plan, Alone())
    grower.grow(forest.Unit(-1, 0, 1))
    nodes = sum(len(level["node"]) for level in grower.nodes)
    assert len(grower.nodes) > 20 and sum(looked) < 10 * plan.looked_at * nodes
    assert sum(looked) < len(grower.nodes) * len(rows.cols) / 2
