"""Token alignment, Merkle manifest and token files against brute force and round trips."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigspark.llm import alignment, common, merkle, queries, token_files, tokens

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, slice int, rank string, `size` string"
ODD = (
    "", " ", "  ", "\n", "a  b ", "end ", " lead", "tab\there", "x▁y", "<|endoftext|> a", "b <|endoftext|>", "<s> </s>",
    "café naïve 中文 \U0001f600", "it's we'll 12,345.67", "nul \x00 \x1c \x85   ​", "<0x0A>", "a" * 3000,
    "word " * 5000, "ü " * 50, "no  double   triple    spaces",
)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeho nrst") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts = [*ODD, *(" ".join(rng.choices(words, k=rng.randrange(1, 80))).title() for _ in range(60)), None]
    sources = ["hot"] * 60 + ["b", None, "A", "é", ""] * 5
    rows = [(7 * i % 101 - 3, s, "en", len(t) if t else None, t, 1, "r", "s") for i, (t, s) in enumerate(zip(texts, sources))]
    rows += [(None, "hot", None, None, "no id A", None, None, None), rows[5], rows[5], (rows[9][0], "hot", "de", 2, "Same id", 1, "r", "s")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def paths():
    return [tokens.vocabulary_path(n) for n in (tokens.BYTE_BPE, tokens.PIECE_BPE)]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- tokens -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("plain", [True, False])
def test_pieces_encode_like_whole_texts(paths, plain):
    rng = random.Random(9)
    alphabet = [*"ab ,.?\t\n", "  ", " x", "y ", "é", "▁", "<|endoftext|>", "'s", "1", "\x85", " ", "\U0001f600"]
    texts = [*ODD, *("".join(rng.choices(alphabet, k=rng.randrange(14))) for _ in range(3000))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    a, b = tokens.Memo(tokens.ByteBpe(paths[0], plain), limit=500), tokens.Memo(tokens.PieceBpe(paths[1]), limit=500)
    for first, rows, data, offsets in common.slices(batch, "text", 4096):
        ids, at = tokens.Pieces(data, offsets, points=True).ids(a)
        spaced = tokens.Pieces(*tokens.with_space(data, offsets))
        (a_ids, a_at), (b_ids, b_at) = spaced.ids(a), spaced.ids(b)
        for i in range(rows):
            text, whole = texts[first + i], a.tokenizer.tokenizer
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids
            if text:
                assert a_ids[a_at[i] : a_at[i + 1]].tolist() == whole.encode(" " + text, add_special_tokens=False).ids
                assert b_ids[b_at[i] : b_at[i + 1]].tolist() == b.tokenizer.model.encode(text)


# --- alignment --------------------------------------------------------------------------------------


def brute_alignment(rows, paths):
    a, b = tokens.ByteBpe(paths[0], True), tokens.PieceBpe(paths[1])
    spell = a.token_bytes(), b.token_bytes()
    found, counts = [], collections.Counter()
    for doc_id, text in rows:
        ids = (a.tokenizer.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)) if text else ([], [])
        if any(b"".join(s[i] for i in x) != (" " + text).encode() for s, x in zip(spell, ids) if text):
            ids = [], []
        ends = [dict(zip(np.cumsum([len(s[i]) for i in x]).tolist(), range(len(x)))) for s, x in zip(spell, ids)]
        shared = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][ends[0][e]], ids[1][ends[1][e]]) for e in shared]
        groups, p, q = [], 0, 0
        for e in shared:
            i, j = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, ids[0][p:i])) + "|" + ",".join(map(str, ids[1][q:j])))
            p, q = i, j
        counts.update(links)
        found.append((doc_id, len(ids[0]), len(ids[1]), len(groups), links, ";".join(groups)))
    best = collections.Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [
        (d, na, nb, ng, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha(g) if g else "")
        for d, na, nb, ng, links, g in found
    ]


def test_alignment_is_brute_force(docs, paths, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    aligned = alignment.align(docs, *paths, digest=True).persist()
    got = alignment.rate(aligned, alignment.pair_counts(aligned))
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_best", "count_sum", "groups_sha256")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key)
    assert got == sorted(brute_alignment(rows, paths), key=key)
    assert any(r[1] == 0 and r[0] is not None for r in got) and any(r[1] > 1000 for r in got)


def test_aligned_ids_and_groups_spell_the_text(docs, paths):
    spell = tokens.ByteBpe(paths[0], True).token_bytes(), tokens.PieceBpe(paths[1]).token_bytes()
    for r in alignment.align(docs, *paths).join(docs.select("doc_id", "text"), "doc_id").collect():
        i = j = 0
        for p, q in zip(r["a_sizes"], r["b_sizes"]):
            a, b = r["a_ids"][i : i + p], r["b_ids"][j : j + q]
            assert b"".join(spell[0][x] for x in a) == b"".join(spell[1][x] for x in b)
            i, j = i + p, j + q
        assert (i, j) == (len(r["a_ids"]), len(r["b_ids"])) and sum(r["times"]) == len(r["a_sizes"])


def test_windows_follow_their_id_tuples(paths):
    a, b = tokens.Memo(tokens.ByteBpe(paths[0], True)), tokens.Memo(tokens.PieceBpe(paths[1]))
    windows = alignment.Windows(a.tokenizer.token_bytes(), b.tokenizer.token_bytes())
    text = b"".join([b" the antidisestablishment of the the of"] * 3)
    parts = alignment.align_slice(np.frombuffer(text, np.uint8), np.array([0, len(text)]), a, b, windows)
    assert parts[2][0].sum() == len(parts[0][0]) and parts[3][0].sum() == len(parts[1][0])
    assert len(windows.memo.young.slots) <= 4  # one entry for each different word


def test_alignment_of_an_empty_table(docs, paths):
    aligned = alignment.align(docs.limit(0), *paths, digest=True)
    assert alignment.rate(aligned, alignment.pair_counts(aligned)).count() == 0


# --- manifest ---------------------------------------------------------------------------------------


def brute_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(digests):
    """(root, [path of each leaf: (left, right) by level])."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 16, len(digests))) for i in range(0, len(digests), 16)]
        for run in runs:
            for i in run:
                left, right = "".join(digests[run[0] : i]), "".join(digests[i + 1 : run[-1] + 1])
                for leaf in owners[i]:
                    paths[leaf].append((left, right))
        owners = [[leaf for i in run for leaf in owners[i]] for run in runs]
        digests = [sha(*(digests[i] for i in run)) for run in runs]
    return digests[0], paths


def brute_manifest(rows):
    first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted({r["source"] for r in rows}, key=first)
    trees, members = [], []
    for source in sources:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (first(r["doc_id"]), brute_leaf(r, r["text"])))
        members.append(own)
        trees.append(brute_tree([brute_leaf(r, r["text"]) for r in own]))
    root, tops = brute_tree([t[0] for t in trees])
    out = []
    for own, (subroot, below), above in zip(members, trees, tops):
        for row, path in zip(own, below):
            path = path + above
            used = row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and used is not None:
                used = "".join(x.lower() if "A" <= x <= "Z" else x for x in used)
            folded = brute_leaf(row, used)
            for left, right in path:
                folded = sha(left, folded, right)
            proof = sha(*(x for pair in path for x in pair))
            out.append((row["doc_id"], brute_leaf(row, row["text"]), subroot, root, proof, folded, folded == root))
    return out


@pytest.fixture(scope="module")
def many(spark):
    """A source of over 256 leaves, one of 17, lone ones and 20 sources in all."""
    rows = [(i * 37 % 400, "hot", "en", i, f"Text {i}") for i in range(300)]
    rows += [(1000 + i, "mid", None, None, f"Mid {i}" if i % 3 else None) for i in range(17)]
    rows += [(2000 + i, f"s{i:02}", "de", 1, "LONE") for i in range(17)] + [(3000, None, "de", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)


@pytest.mark.parametrize("name", ["docs", "many"])
def test_manifest_is_brute_force(name, request):
    docs = request.getfixturevalue(name)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.audit(docs, tampered).withColumn("proof", F.sha2(merkle.proof_text(), 256))
    got = got.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(docs.collect()), key=key)
    assert {r["verified"] for r in got} == {True, False}


def test_proofs_of_some_leaves(many):
    rows = many.select("doc_id", "source", merkle.leaf().alias("leaf"))
    made = merkle.manifest(rows)
    asked = made.leaves.filter("doc_id in (37, 1003, 2004)").drop("source", "n")
    proofs = merkle.prove(made, asked).withColumn("folded", merkle.fold(F.col("leaf"))).collect()
    assert len(proofs) == 3 and all(r["folded"] == made.root for r in proofs)


def test_manifest_of_an_empty_table(many):
    assert merkle.audit(many.limit(0), F.lit(True)).count() == 0


# --- token files ------------------------------------------------------------------------------------


def test_token_files_round_trip(spark, docs, paths):
    path = token_files.new_folder(spark)
    token_files.write(docs, path, paths[0], token_files.Settings(block_bytes=600, sample_bytes=4000))
    tokenizer = tokens.ByteBpe(paths[0]).tokenizer
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    ids = {(d, t): [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for d, t in rows}
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    first = lambda d: (d is not None, d or 0)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=first)
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    crc = collections.Counter((d, len(ids[d, t]), zlib.crc32(np.array(ids[d, t], "<u4").tobytes())) for d, t in rows)
    assert crc == collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got)
    assert spark.read.parquet(f"{path}/blocks").count() > 5

    wanted = spark.createDataFrame([(rows[3][0],), (rows[8][0],), (99999,)], "doc_id long")
    found = token_files.lookup(wanted, path).collect()
    assert {r["doc_id"] for r in found} == {rows[3][0], rows[8][0]}
    starts = {r["start"]: r["n_tokens"] for r in got}
    assert all(starts[r["start"]] == len(r["ids"]) and r["ids"] in [ids[x] for x in ids if x[0] == r["doc_id"]] for r in found)


def test_token_files_of_an_empty_table(spark, docs, paths):
    path = token_files.new_folder(spark)
    token_files.write(docs.limit(0), path, paths[0])
    assert token_files.read(spark, path).count() == 0


def test_container_refuses_another_dictionary():
    data = token_files.pack([b"x"], hashlib.sha256(b"one").digest())
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.Container(data, b"two", 2)
    with pytest.raises(ValueError, match="not a container"):
        token_files.Container(b"\0" * 64, b"", 2)


def test_new_queries_are_registered():
    assert {"op11_token_alignment", "op12_merkle_manifest", "op13_token_files"} <= set(queries.QUERIES)
    assert "op12_merkle_manifest" in queries.ORACLES
