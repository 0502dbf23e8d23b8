"""The pipeline's stages, one after the other, against brute force on planted cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = list(corpus_pipeline.COLUMNS)


def near(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), int(len(out) * share)):
        out[i] = f"edit{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(900)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    lines = lambda words, n=12: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    items = [(k, " ".join(text(30))) for k in range(12)]
    shared = [" ".join(text(10)) for _ in range(4)]
    docs, labels = [], []
    for i in range(420):
        words = text(rng.randrange(30, 140))
        if i % 6 == 0:
            words[5:5] = ["vile", "scumbag", "awful"] * 2
            labels.append((i, 0, 1))
        elif i % 2 == 0:
            labels.append((i, 1, 0))
        if i % 35 == 1:
            words[7:7] = items[i % 12][1].split()
        body = lines(words)
        if i % 21 == 2:
            body = "\n".join(shared) + "\n" + body
        docs.append((i, body, rng.choice(["en", "de"]), f"s{i % 4}", len(body)))
    for i in range(420, 440):
        base = docs[(i - 420) * 4 + 1][1].split()
        words = base if i % 4 == 0 else near(rng, base, 0.01 * (i % 4))
        docs.append((i, lines(words, 11), "en", "s1", 5))  # other lines, so that the texts stay
    docs += [(500, None, None, None, None), (501, "", "en", "s2", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Rows after each stage, each stage fed with the written result of the one before."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    base = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        if i < 4:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_toxic_documents_go_and_clean_ones_stay(stages):
    toxic = {r["doc_id"] for r in stages[0] if "scumbag" in (r["text"] or "")}
    kept = {r["doc_id"] for r in stages[1]}
    assert not kept & toxic
    assert len({r["doc_id"] for r in stages[0]} - toxic - kept) <= 4


def test_lines(stages):
    seen, expected = {}, {}
    docs = sorted(stages[1], key=lambda r: r["doc_id"])
    for r in docs:
        lines = (r["text"] or "").split("\n")
        gone = set()
        full = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        for a in range(len(full) - 2):
            key = tuple(x for _, x in full[a : a + 3])
            if seen.setdefault(key, (r["doc_id"], a)) != (r["doc_id"], a):
                gone |= {i for i, _ in full[a : a + 3]}
        expected[r["doc_id"]] = None if r["text"] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert {r["doc_id"]: r["text"] for r in stages[2]} == expected
    assert any(r["text"] != expected[r["doc_id"]] for r in docs)
    for r in stages[2]:
        if r["doc_id"] < 420 and r["text"] is not None:
            assert r["n_chars"] == len(r["text"])


def test_near_copies(stages):
    docs = sorted(stages[2], key=lambda r: r["doc_id"])
    sets = {}
    for r in docs:
        w = (r["text"] or "").split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert {r["doc_id"] for r in stages[3]} == {i for i in sets if root(i) == i}
    assert len(stages[3]) < len(docs) - 5


def test_test_items(stages, spark, folder):
    items = [r["text"].split() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    leaking = {
        r["doc_id"]
        for r in stages[3]
        for w in items
        if len(grams(w) & grams((r["text"] or "").split())) >= 0.8 * len(grams(w))
    }
    assert leaking
    assert {r["doc_id"] for r in stages[4]} == {r["doc_id"] for r in stages[3]} - leaking


def test_mix(stages):
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in stages[4]}
    total = sum(sizes.values())
    taken = sum(r["copies"] * r["size"] for r in stages[5])
    assert total - max(sizes.values()) < taken <= total
    for source in {r["source"] for r in stages[5]}:
        own = [r for r in stages[5] if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 2 * max(sizes.values())
        assert all(1 <= r["copies"] <= 3 and r["size"] == sizes[r["doc_id"]] for r in own)


def test_run_gives_the_last_stage(spark, folder, stages):
    out = corpus_pipeline.run(spark, folder)
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, out.collect())) == sorted(map(key, stages[5]))


def test_empty_documents(spark, folder, tmp_path):
    import shutil

    target = tmp_path / "empty"
    shutil.copytree(folder, target)
    spark.read.parquet(f"{folder}/documents.parquet").filter(F.lit(False)).write.mode("overwrite").parquet(f"{target}/documents.parquet")
    assert corpus_pipeline.run(spark, str(target)).collect() == []
