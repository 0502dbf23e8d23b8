"""The operators against brute force on small tables with nulls, copies, ties and odd columns."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigspark.llm import (
    ball_tree,
    common,
    decontamination,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    pii,
    repeats,
    run_length_dedup,
    substring_dedup,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did int, th string, score string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts() -> list:
    """Random texts with exact and near copies, shared passages, periodic, empty and null ones."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "ß"]
    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    out = []
    for i in range(24):
        body = words(rng.choice([3, 20, 90, 150]))
        if i % 5 == 0:
            body[2:2] = passage
        out.append(" ".join(body))
    base = words(120)
    for i in range(12):
        near = list(base)
        for _ in range(i % 4):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        out.append("  ".join(near) if i == 5 else " ".join(near))
    out += [out[3], out[3].upper(), "x " * 90, "ab" * 300, "one two", "One  two\t", "", " \n ", None, None]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 % 101, t, "en", f"s{i % 3}", 1, 7, "t", "s", "z") for i, t in enumerate(texts())]
    rows.append((None, "one two", None, None, None, None, None, None, None))
    rows.append(rows[3])  # a row that repeats
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def repeated(sequences: list, length: int) -> list:
    counts = collections.Counter(s[i : i + length] for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        steps = np.zeros(len(s) + 1, int)
        for i in range(len(s) - length + 1):
            if counts[s[i : i + length]] > 1:
                steps[i] += 1
                steps[i + length] -= 1
        out.append(np.cumsum(steps)[:-1] > 0)
    return out


def same(got, expected) -> None:
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(map(tuple, expected), key=key)


@pytest.mark.parametrize("block", [repeats.BLOCK, 2])
def test_substring_dedup(docs, rows, empty, block, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", block)
    sequences = [tuple(WORD.findall(t or "")) for _, t in rows]
    expected = [
        (i, len(s), int(gone.sum()), " ".join(w for w, g in zip(s, gone) if not g))
        for (i, _), s, gone in zip(rows, sequences, repeated(sequences, 35))
    ]
    assert sum(e[2] for e in expected) > 500
    same(substring_dedup.remove_repeats(docs).collect(), expected)
    assert substring_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("block", [repeats.BLOCK, 2])
def test_run_length_dedup(docs, rows, empty, block, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", block)
    blobs = [(t or "").encode() for _, t in rows]
    expected = []
    for (i, _), b, gone in zip(rows, blobs, repeated(blobs, 200)):
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        kept = bytearray(np.frombuffer(b, np.uint8)[~gone].tobytes())
        expected.append((i, len(b), int(gone.sum()), spans, kept))
    assert sum(e[2] for e in expected) > 2000
    got = [(*r[:4], bytearray(r[4])) for r in run_length_dedup.remove_repeated_bytes(docs).collect()]
    same(got, expected)
    assert run_length_dedup.remove_repeated_bytes(empty).collect() == []


def test_indexes_agree():
    rng = np.random.default_rng(1)
    units = [rng.integers(0, 3, rng.integers(12, 60)) for _ in range(20)]
    counts = [1] * 18 + [2, 2]
    for length in (5, 11):
        seen = collections.Counter()
        for u, n in zip(units, counts):
            for i in range(len(u) - length + 1):
                seen[tuple(u[i : i + length])] += n
        expected = [[seen[tuple(u[i : i + length])] > 1 for i in range(len(u) - length + 1)] for u in units]
        for index in (substring_dedup.automaton_index, run_length_dedup.run_length_index):
            assert [f.tolist() for f in index(units, counts, length)] == expected


def test_periodic_text_is_run_compressed():
    index = run_length_dedup.RunLengthIndex([np.tile([1, 2, 3], 100)])
    assert index.runs < 12 and index.size == 301


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_minhash_dedup(docs, rows, empty, words, percent):
    fold = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(fold))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    expected = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if root(m) == root(k) and rows[m][0] is not None]
        component = min(ids) if ids else None
        expected.append((i, len(sets[k]), component, i == component))
    got = minhash_dedup.near_duplicates(docs, words, percent)
    same(got.select("doc_id", "n_shingles", "component_id", "kept").collect(), expected)
    one = minhash_dedup.keep_one(docs, words, percent)
    assert one.columns == docs.columns
    kept = {(e[0], t) for e, (_, t) in zip(expected, rows) if e[3]}
    same([(r["doc_id"], r["text"]) for r in one.collect()], kept)
    assert minhash_dedup.near_duplicates(empty).collect() == []


def test_minhash_pivots(spark, monkeypatch):
    """A group too large for all pairs at once: many near copies of one text."""
    monkeypatch.setattr(minhash_dedup, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash_dedup, "PIVOTS", 2)
    rng = random.Random(5)
    base = [f"v{rng.randrange(900)}" for _ in range(150)]
    made = []
    for i in range(60):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(150)] = f"n{i}{rng.random()}"
        made.append((i, " ".join(copy)))
    sets = [{tuple(t.split()[j : j + 3]) for j in range(148)} for _, t in made]
    parent = list(range(60))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(60), 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = minhash_dedup.near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: root(i) for i in range(60)}


def test_odd_sketch_bounds_the_difference():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    b = np.append(a[40:], rng.integers(0, 2**63, 25).astype(np.uint64))
    one, two = (minhash_dedup.odd_sketches(np.sort(x), np.array([0, len(x)])) for x in (a, b))
    apart = sum(int(x).bit_count() for x in (one ^ two)[0])
    assert 40 <= apart <= 65


def test_line_dedup(spark, empty):
    rows = [
        (1, "a\nb\nc\nd\ne", "x"),
        (2, "z\n a \nb\n\nc\r\nq", "x"),
        (3, "a\na\na\na\na", "x"),
        (4, "", "x"),
        (5, None, "x"),
        (None, "b\nc\nd", "x"),
        (6, "only\ntwo", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = line_dedup.remove_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    # The null id comes first, so it keeps b c d, and document 1 loses them and what else repeats.
    same(
        got.collect(),
        [
            (None, "b\nc\nd", 3, 0),
            (1, "a\ne", 5, 3),
            (2, "z\n\nq", 6, 3),
            (3, "a", 5, 4),
            (4, "", 1, 0),
            (5, None, 0, 0),
            (6, "only\ntwo", 2, 0),
        ],
    )
    assert line_dedup.remove_repeated_lines(empty).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        v = int(ch) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def confirmed(kind: str, hit: str) -> bool:
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def test_pii(spark, empty):
    rng = random.Random(9)
    alphabet = "ab.@-_+ 0123456789().é😀\n%"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(150)]
    made += [
        "a@b.c_d@e.f.", "1.2.3.4.5.6.7.8 256.1.1.1 007.000.255.0255", "4111 1111 1111 1111 x 4111-1111-1111-1112",
        "call +49 (30) 1234-5678.", "9" * 5000, "a" * 5000 + "@", "1." * 3000, "", None,
    ]
    rows = [(i, t) for i, t in enumerate(made)] + [(1, made[1]), (None, "x@y.z")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row string")
    expected = []
    for i, t in rows:
        spans = sorted(
            (m.start(), order, kind, m.end())
            for order, (kind, p) in enumerate(PATTERNS.items())
            for m in re.finditer(p, t or "")
            if confirmed(kind, m.group())
        )
        expected.append((i, ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)))
    got = pii.find(docs).select("doc_id", pii.notation(F.filter("spans", lambda s: s["base"])))
    same(got.collect(), expected)
    assert pii.find(empty).collect() == []


def test_pii_added_kinds_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 ok",
        "IBAN DE88 3704 0044 0532 0130 00 no",
        "number 123-45-6789 alone",
        "my ssn is 123-45-6789",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: [(s["kind"], s["text"]) for s in r["spans"] if not s["base"]] for r in pii.find(docs).collect()}
    assert spans == {0: [("iban", "DE89 3704 0044 0532 0130 00")], 1: [], 2: [], 3: [("ssn", "123-45-6789")]}


def test_pii_context_on_both_sides_and_account_lengths(spark):
    many = [f"{123 + i}-45-6789" for i in range(30)]
    gb, de = "GB29 NWBK 6016 1331 9268 19", "DE89370400440532013000"
    texts = {
        "SSN: 123-45-6789, 219-09-9999": ["123-45-6789", "219-09-9999"],
        "123-45-6789 (social security number)": ["123-45-6789"],
        "ssn 123-45-6789 or maybe 219-09-9999": ["123-45-6789", "219-09-9999"],
        "Social security numbers:\n" + "\n".join(many): many,
        "\n".join(many) + "\n(all lot numbers)": [],
        "\n".join(many) + "\n(each a tax id)": many,
        "ssn 123-45-6789" + " and then" * 20 + " 219-09-9999 of 321-54-9876": ["123-45-6789"],
        f"IBAN {gb} BIC NWBKGB2L": [gb],
        f"{de} 20 EUR, DE12 {gb} 2024": [de, gb],
        "DE89 3704 0044 0532 0130 0 and " + gb + "9": [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        text = list(texts)[r["doc_id"]]
        added = [s for s in r["spans"] if not s["base"]]
        assert [s["text"] for s in added] == texts[text]
        assert all(text[s["start"] : s["end"]] == s["text"] for s in r["spans"])


def test_mixing(spark, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["b", "a", "é", None])) for i in range(400)]
    rows += [(900 + i, "x y z", "tiny") for i in range(3)] + [(950, None, "none"), (0, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string, size string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    order = ["a", "b", "none", "tiny", "é", None]
    sizes, taken = collections.Counter(), collections.Counter()
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    budget, full = sum(sizes.values()), set()
    while True:  # reshare what is above three times a source until none is
        left = budget - sum(3 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 3 * sizes[s] if s in full else weight[s] * level for s in order}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]]) and r["copies"] <= 3
        assert r["source_size"] == sizes[r["source"]]
    assert budget - 300 <= sum(taken.values()) <= budget
    assert all(abs(taken[s] - target[s]) <= 600 for s in order)
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(empty).count() == 0


def test_ball_tree(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1, (6, 16))
    vectors = [(centres[i % 6] + rng.normal(0, 0.2, 16)).astype(float).tolist() for i in range(700)]
    vectors[10:40] = [vectors[0]] * 30  # ties
    rows = list(enumerate(vectors)) + [(800, None), (801, [1.0, None]), (802, [float("nan")] * 16), (900, [0.5]), (901, [2.0]), (5, vectors[5])]
    made = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, row int")
    old = ball_tree.SHARD, ball_tree.BLOCK, ball_tree.LEAF
    ball_tree.SHARD, ball_tree.BLOCK, ball_tree.LEAF = 128, 4, 16
    try:
        got = ball_tree.top_k(made.withColumn("v", ball_tree.whole_components()), F.col("vec_id") % 50 == 0, 10).collect()
    finally:
        ball_tree.SHARD, ball_tree.BLOCK, ball_tree.LEAF = old
    valid = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    expected = []
    for k, (i, q) in enumerate(valid):
        if i % 50 == 0:
            scores = sorted((-int(q @ v), j) for m, (j, v) in enumerate(valid) if m != k and len(v) == len(q))
            expected += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:10])]
    same(got, expected)


def test_ball_tree_large_components(spark):
    rows = [(i, [1e300 * (i - 2), 3.0 * i]) for i in range(5)] + [(0, None)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ball_tree.top_k(made.withColumn("v", ball_tree.whole_components()), F.col("vec_id") == 4, 2).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 3, 2**63 - 1), (2, 2, 12288 * 6144)]
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert ball_tree.top_k(none.withColumn("v", ball_tree.whole_components()), F.lit(True)).collect() == []


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(11)
    clean = [f"tok{i}" for i in range(300)]
    made, labels = [], []
    for i in range(900):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["Vile***", "awful,", f"grobx{rng.randrange(99)}"])
        made.append((i, " ".join(words), rng.choice(["en", "de", None]), "old"))
        labels.append((i, toxic))
    made += [(1000, "", "en", "o"), (1001, None, None, "o"), (None, "vile awful grobx1 vile", "en", "o")]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, score string")
    marks = spark.createDataFrame(labels + [(5000, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    net = toxicity.train(docs, marks)
    got = toxicity.score(docs, net).withColumn("out", toxicity.held_out()).collect()
    truth = dict(labels)
    held = [r for r in got if r["out"] and r["doc_id"] in truth]
    right = sum((r["score"] >= 0.7) == bool(truth[r["doc_id"]]) for r in held)
    assert len(held) > 200 and right / len(held) > 0.97
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[None]["flagged"] and not by_id[1000]["flagged"]
    assert by_id[1000]["score"] == by_id[1001]["score"]
    again = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in got}


def test_toxicity_scores_do_not_depend_on_the_neighbours():
    keys = np.arange(1, 9, dtype=np.uint64)
    net = toxicity._empty(toxicity.Settings(), keys)
    rng = np.random.default_rng(2)
    text, other = (rng.integers(1, 9, (n, toxicity.PARTS)).astype(np.int32) for n in (4, 6))
    none = np.zeros((0, toxicity.PARTS), np.int32)
    for text in (text, text[:1], none):
        pooled = []
        for batch in ([text], [text, other], [other, text], [other, text, other], [none, text], [text, none]):
            first = np.append(0, np.cumsum([len(x) for x in batch]))
            at = next(i for i, x in enumerate(batch) if x is text)
            pooled.append(net.pooled(*net.padded(np.concatenate(batch), first))[at])
        padded = np.concatenate([none, np.zeros((1, toxicity.PARTS), np.int32), text, np.zeros((2, toxicity.PARTS), np.int32)])
        best = [net.responses(padded, net.tables()[w])[: len(text) + 1].max(0) for w in toxicity.WIDTHS]
        expected = np.maximum(np.concatenate(best) + net.bias, 0)
        for got in pooled:
            np.testing.assert_allclose(got, expected, rtol=1e-6)


def test_toxicity_without_two_classes(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, None, None)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["flagged"] for r in toxicity.score(docs, toxicity.train(docs, marks)).collect()] == [False, False]
    assert toxicity.score(docs.limit(0), toxicity.train(docs, marks)).collect() == []


def leaks_by_hand(docs: list, items: list) -> dict:
    token = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
    fold = {i: i + 32 for i in range(65, 91)}
    words = lambda t: [w.translate(fold) for w in token.findall(t or "")]
    parts = []
    for k, (_, t) in enumerate(items):
        w = words(t)
        n = -(-len(w) // decontamination.PIECE)
        cuts = [round(j * len(w) / n) for j in range(n + 1)] if n else []
        parts += [(k, w[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    df = collections.Counter(t for _, p in parts for t in set(p))
    mean = sum(len(p) for _, p in parts) / max(1, len(parts))
    postings = collections.defaultdict(list)
    for j, (_, p) in enumerate(parts):
        tf = collections.Counter(p)
        part = {
            t: np.log(1 + (len(parts) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(p) / mean))
            for t, n in tf.items()
        }
        for t, v in part.items():
            postings[t].append((j, v / sum(part.values())))
    found = {}
    for i, t in docs:
        w, best = words(t), {}
        for q in range(max(1, -(-(len(w) - 32) // 32)) if w else 0):
            scores = collections.Counter()
            for term in set(w[32 * q : 32 * q + 64]):
                for j, v in postings.get(term, ()):
                    scores[j] += v
            for j, v in scores.items():
                if v >= decontamination.THRESHOLD - 1e-12:
                    best[parts[j][0]] = max(best.get(parts[j][0], 0), v)
        for k, v in best.items():
            x = words(items[k][1])
            m = min(5, len(x))
            grams = [tuple(x[a : a + m]) for a in range(len(x) - m + 1)]
            cut = len(grams) - int(len(grams) * 0.25)
            own = {tuple(w[a : a + m]) for a in range(len(w) - m + 1)}
            share = lambda s, own=own: len(s & own) / len(s) if s else 1.0
            q, a, both = share(set(grams[:cut])), share(set(grams[cut:])), share(set(grams))
            if both >= 0.8 and min(q, a) >= 0.5:
                found[i, items[k][0]] = (v, q, a, both)
    return found


@pytest.mark.parametrize("shard_bytes", [decontamination.SHARD_BYTES, 2000])
def test_decontamination(spark, empty, shard_bytes, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard_bytes)
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, text(rng.choice([3, 15, 40, 100]))) for k in range(40)] + [(50, ""), (51, None), (None, text(30))]
    docs = []
    for i in range(120):
        body = text(rng.choice([2, 60, 400])).split()
        if i % 4 == 0:
            leak = rng.choice(items)[1] or ""
            if i % 8 == 0:
                leak = leak.upper().replace(" ", " ... ", 3)
            if i % 12 == 0:
                leak = leak[: len(leak) * 2 // 3]
            body[1:1] = leak.split()
        docs.append((i, " ".join(body)))
    docs += [(200, ""), (201, None), (None, items[2][1])]
    made = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, item_id string")
    test_set = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, shard int")
    expected = leaks_by_hand(docs, items)
    got = decontamination.find_leaks(made, test_set).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(expected) and len(expected) > 15
    for r in got:
        assert tuple(r)[2:] == pytest.approx(expected[r["doc_id"], r["item_id"]])
    clean = decontamination.decontaminate(made, test_set)
    leaking = {i for i, _ in expected}
    assert clean.columns == made.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(i) for i, _ in docs if i not in leaking)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(made, none).collect() == []
    assert decontamination.decontaminate(empty, test_set).collect() == []


def test_decontamination_of_edited_and_partial_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    def edited(item, *places):
        return [f"new{i}" if i in places else w for i, w in enumerate(item)]

    items = [words(n) for n in (15, 30, 15, 300, 300, 40, 40, 60, 300, 12)]
    items[9] = "what is the name of the capital city of w1 and w2".split()
    parts = {
        0: edited(items[0], 7),
        1: edited(items[1], 8, 21),
        2: edited(items[2], 13),
        3: items[3][:237],
        4: items[4][63:],
        5: items[5][:30],
        8: items[8][30:150],
        # too little: half of an item, every second word changed, the same question of something else
        6: items[6][10:30],
        7: edited(items[7], *range(0, 60, 2)),
        9: "what is the name of the capital city of w7 and w8".split(),
    }
    docs = [(k, " ".join(words(100) + part + words(100))) for k, part in parts.items()]
    made = spark.createDataFrame(docs, "doc_id long, text string")
    test_set = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.find_leaks(made, test_set).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 8] and all(r["item_id"] == k for k, r in got.items())
    assert got[3]["question"] == got[5]["question"] == got[4]["answer"] == 1
    assert got[5]["answer"] < 0.5 and got[4]["question"] < 0.9 and got[8]["overlap"] < 0.5
    clean = decontamination.decontaminate(made, test_set)
    assert sorted(r["doc_id"] for r in clean.collect()) == [6, 7, 9]


def test_license_scan(spark, empty):
    notice = license_scan.TEMPLATES[4][1]
    texts = [
        "some text\nReleased under the MIT License.\nmore",
        "RELEASED, under the mit license!",
        "the of and to in",
        notice.replace(", ", ",\n"),
        "é\n" + notice + "\n\nlast",
        "", None, "License",
    ]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, unit string")
    got = license_scan.scan(docs).collect()
    token = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    grams = lambda t: set(itertools.pairwise(token.findall(t.lower())))
    expected = []
    for i, t in enumerate(texts):
        for kind, a, b in by_hand_units(t or ""):
            own = grams(t[a:b]) if t else set()
            scored = [(2 * len(own & grams(x)) / (len(own) + len(grams(x))), -k) for k, (_, x) in enumerate(license_scan.TEMPLATES) if own]
            if scored and max(scored)[0] >= license_scan.DICE:
                expected.append((i, kind, a, b, license_scan.TEMPLATES[-max(scored)[1]][0], max(scored)[0]))
    same([(*r[:5], round(r[5], 9)) for r in got], [(*e[:5], round(e[5], 9)) for e in expected])
    assert len(expected) >= 5 and license_scan.scan(empty).collect() == []


def test_license_notices_inside_prose(spark):
    full = dict(license_scan.TEMPLATES[-len(license_scan.TEXTS):])
    long = license_scan.TEMPLATES[4][1]
    prose = "The of a café, in the heart of the town and to the north of it, was subject to the terms of the council. "
    texts = {
        "This project is licensed under the MIT License.": ["MIT"],
        "Copyright (c) 2020 Jane Doe. Released under the MIT License.": ["MIT"],
        "Copyright 2020 Acme Press. Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        prose + "Licensed under CC BY 4.0, and the code is released under the MIT license. " + prose: ["CC-BY-4.0", "MIT"],
        prose + "\n" + prose + "It is licensed\nunder the Apache License, Version 2.0. " + prose + "\n" + prose: ["Apache-2.0"],
        prose + long + " " + prose: ["Apache-2.0"],
        prose + full["MIT"].replace("\n", " ") + prose: ["MIT"],
        "é " * 30 + full["BSD-2-Clause"].replace("\n", " ") + prose: ["BSD-2-Clause"],
        prose + " ".join(full["GPL-3.0"].split()) + prose: ["GPL-3.0"],
        prose + "Licensed under the Apache License, Version 9.7. " + prose: [],
        prose + "Permission under the law of the land is granted, and the license is not. " + prose: [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [[] for _ in texts]
    for r in sorted(license_scan.scan(docs).collect()):
        part = list(texts)[r["doc_id"]][r["start"] : r["end"]]
        assert (part == part.strip() or r["unit"] != "window") and r["dice"] >= license_scan.DICE
        got[r["doc_id"]].append((r["start"], r["license"]))
    assert [[x for _, x in sorted(g)] for g in got] == list(texts.values())


def by_hand_units(text: str) -> list:
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    out = [("line", a, b) for a, b in lines]
    group = []
    for a, b in [*lines, (0, 0)]:
        if text[a:b].strip(" \t\n\r\x0b\x0c"):
            group.append((a, b))
        else:
            if 1 < len(group) < len(lines):
                out.append(("paragraph", group[0][0], group[-1][1]))
            group = []
    return out + ([("text", 0, len(text))] if len(lines) > 1 else [])


def test_words_and_rolling_hashes():
    data, offsets = common.text_bytes(pa.array(["a bc\x0bd", None, "", " é ", "x"]).slice(0, 5))
    starts, ends, first = common.find_words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a", "bc", "d", "é", "x"]
    assert first.tolist() == [0, 3, 3, 3, 4, 5]
    values = np.arange(50, dtype=np.uint64) % 7
    roll = common.Rolling(values)
    assert roll.grams(7)[0] == roll.grams(7)[7] and len(set(roll.grams(7).tolist())) == 7
    grams = np.random.default_rng(3).integers(0, 2**63, 500).astype(np.uint64)
    least = repeats.least_gram(grams, 28)
    assert all(least[i] == i + grams[i : i + 28].argmin() for i in range(len(least)))


def test_digest_queries_cover_every_operator():
    from sigspark.llm import queries

    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_line_dedup_of_many_lines(spark):
    """A text of 100,000 lines is split once, not once a line; this would take hours otherwise."""
    lines = [f"line {i}" for i in range(100_000)]
    text = "\n".join([*lines, *lines[:50]])
    out = line_dedup.remove_repeated_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert out["n_lines"] == 100_050 and out["n_removed"] == 50 and out["text"] == "\n".join(lines)
