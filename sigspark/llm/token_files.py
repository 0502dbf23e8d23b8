"""Token ids as binary files: one shared zstandard dictionary, one compressed frame for each document.

A folder holds three tables. ``dictionary`` is one row: the shared dictionary, its hash, the id width and
what made it. ``blocks`` holds containers of about a megabyte: a header with the dictionary's hash and
the places of the frames, then one frame for each document. ``index`` tells for each document its block,
slot, place and length in the block, the number of its ids and how many ids all documents before it have.
A document is read from one index row and one block; no other frame is touched.

A container is, little-endian: ``TIDB``, version (uint32), SHA-256 of the dictionary (32 bytes), frames
(uint32), reserved (uint32), then frames + 1 places (uint64) counted from the end of the header, then the frames.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_folder
from . import common as c
from . import tokens as tk

MAGIC, VERSION = b"TIDB", 1
HEAD = struct.Struct("<4sI32sII")
END_ID = 0
SLICE = 2 << 20
# ``before``: ids in the block before the document's.
ENTRY = ("doc_id", "offset", "length", "before", "n_tokens")
BLOCK = f"part int, seq long, entries array<struct<{','.join(f'{k}:long' for k in ENTRY)}>>, data binary"


@dataclass(frozen=True)
class Settings:
    """About ``sample_texts`` texts of up to ``sample_bytes`` train the dictionary, never more than twice as many;
    they bound what the driver reads. Blocks are closed at ``block_bytes``; one longer frame is a block."""

    level: int = 3
    dictionary_bytes: int = 32 << 10
    sample_texts: int = 512
    sample_bytes: int = 16 << 10
    block_bytes: int = 1 << 20


def width_of(vocabulary: int) -> int:
    """Bytes an id takes in a serialised array."""
    return 2 if vocabulary <= 1 << 16 else 4


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary trained on serialised id arrays; too few samples are used as they are, none give none."""
    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _shared(dictionary: bytes, level: int | None = None) -> dict:
    """The dictionary as an argument, digested once for a level that compresses."""
    if not dictionary:
        return {}
    shared = zstandard.ZstdCompressionDict(dictionary)
    if level is not None:
        shared.precompute_compress(level)
    return {"dict_data": shared}


def pack(frames: list[bytes], digest: bytes) -> bytes:
    """A container of frames."""
    places = np.zeros(len(frames) + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=places[1:])
    return b"".join([HEAD.pack(MAGIC, VERSION, digest, len(frames), 0), places.tobytes(), *frames])


class Container:
    """Frames of a container by slot; another dictionary than the container names is an error."""

    def __init__(self, data: bytes, dictionary: bytes, width: int):
        magic, version, digest, n, _ = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a container of token ids")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError("the container was written with another dictionary")
        self.places = np.frombuffer(data, "<u8", n + 1, HEAD.size).astype(np.int64)
        self.data, self.body, self.width = memoryview(data), HEAD.size + 8 * (n + 1), width
        self.reader = zstandard.ZstdDecompressor(**_shared(dictionary))

    def __len__(self) -> int:
        return len(self.places) - 1

    def ids(self, slot: int) -> np.ndarray:
        frame = self.data[self.body + self.places[slot] : self.body + self.places[slot + 1]]
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}").astype("<u4")


def _train(docs: DataFrame, vocabulary: str, settings: Settings) -> tuple[bytes, int]:
    # About sample_texts rows by a hash of their place, so that no value decides how many there are.
    share = min(1.0, settings.sample_texts / max(1, docs.count()))
    chosen = F.xxhash64(F.lit(13), F.monotonically_increasing_id()).cast("double") < (2 * share - 1) * 2.0**63
    sample = docs.filter(chosen & F.octet_length("text").between(1, settings.sample_bytes)).select("text")
    sample = sample.limit(2 * settings.sample_texts)
    texts = [r["text"].encode() for r in sample.collect()]
    tokenizer = tk.ByteBpe(vocabulary)
    width = width_of(tokenizer.tokenizer.get_vocab_size())
    samples = [np.array([*ids, END_ID], f"<u{width}").tobytes() for ids in tokenizer.encode(texts)]
    return train_dictionary(samples, settings.dictionary_bytes), width


def write(docs: DataFrame, path: str, vocabulary: str, settings: Settings = Settings()) -> None:
    """Encode every whole text of ``docs`` (doc_id, text), append id 0, and write the files.

    Documents go in ascending doc_id order, null first; rows of one id go by a hash of their text, and
    rows equal in both are interchangeable. A null or empty text has the end id alone. The string of a special
    token in a text becomes that token. Other columns are ignored; an empty table gives empty files.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary, width = _train(docs, vocabulary, settings)
    digest = hashlib.sha256(dictionary).digest()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = tk.memo(tk.ByteBpe, vocabulary, False)
        writer = zstandard.ZstdCompressor(level=settings.level, write_content_size=True, **_shared(dictionary, settings.level))
        part, seq, frames, entries, size, count = TaskContext.get().partitionId(), 0, [], [], 0, 0
        for batch in batches:
            names = batch.column("doc_id")
            for first, rows, data, offsets in c.slices(batch, "text", SLICE):
                flat, at = tk.Pieces(data, offsets, points=True).ids(memo)
                ids = np.insert(flat.astype(f"<u{width}"), at[1:], END_ID).tobytes()
                ends = (at[1:] + np.arange(1, rows + 1)).tolist()
                for i, (start, end) in enumerate(zip([0, *ends], ends)):
                    frame = writer.compress(ids[start * width : end * width])
                    entries.append((names[first + i].as_py(), size, len(frame), count, end - start))
                    frames.append(frame)
                    size, count = size + len(frame), count + end - start
                    if size >= settings.block_bytes:
                        yield _block(part, seq, frames, entries, digest)
                        seq, frames, entries, size, count = seq + 1, [], [], 0, 0
        if frames:
            yield _block(part, seq, frames, entries, digest)

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    placed = docs.withColumns({"_h": key[1], "_n": key[2]})
    key = [key[0], F.col("_h"), F.col("_n")]
    ordered = placed.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK).write.parquet(f"{path}/blocks")

    made = (digest.hex(), width, vocabulary.rsplit("/", 1)[-1], END_ID, bytearray(dictionary))
    row = spark.createDataFrame([made], "hash string, width int, vocabulary string, end_id int, dictionary binary")
    row.coalesce(1).write.parquet(f"{path}/dictionary")
    _index(spark, path, digest.hex()).write.parquet(f"{path}/index")


def _block(part: int, seq: int, frames: list, entries: list, digest: bytes) -> pa.RecordBatch:
    rows = [dict(zip(ENTRY, e)) for e in entries]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ENTRY]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([seq], pa.int64()),
            pa.array([rows], kind),
            pa.array([pack(frames, digest)], pa.binary()),
        ],
        names=["part", "seq", "entries", "data"],
    )


def _index(spark: SparkSession, path: str, digest: str) -> DataFrame:
    """Places and starts of all documents, from the entries of the blocks; frames aren't read.

    Parts are ranges of the order, so starts are sums over parts (one row each), then over the blocks of
    a part; the block knows the rest."""
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "seq", "entries")
    total = F.aggregate("entries", F.lit(0).cast("long"), lambda acc, e: acc + e["n_tokens"])
    sums = blocks.select("part", "seq", total.alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    sums = sums.join(parts, "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("first"))
    slots = blocks.select("part", "seq", F.posexplode("entries").alias("slot", "e"))
    return slots.join(sums, ["part", "seq"]).select(
        "e.doc_id", "part", "seq", "slot", "e.offset", "e.length", (F.col("first") + F.col("e.before")).alias("start"),
        "e.n_tokens", F.lit(digest).alias("dictionary"),
    )


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, int]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["hash"]:
        raise ValueError(f"the dictionary in {path} is damaged")
    return dictionary, row["width"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the decoded frames; ``start`` from the index."""
    dictionary, width = _dictionary(spark, path)
    schema = "part int, seq long, slot int, n_tokens long, ids_crc32 long"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(k) for k in ("part", "seq", "data"))):
                box = Container(data.as_py(), dictionary, width)
                ids = [box.ids(i) for i in range(len(box))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * len(box), pa.int32()),
                        pa.array([seq.as_py()] * len(box), pa.int64()),
                        pa.array(range(len(box)), pa.int32()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    ],
                    names=["part", "seq", "slot", "n_tokens", "ids_crc32"],
                )

    found = spark.read.parquet(f"{path}/blocks").select("part", "seq", "data").mapInArrow(decode, schema)
    index = spark.read.parquet(f"{path}/index").select("doc_id", "part", "seq", "slot", "start")
    return index.join(found, ["part", "seq", "slot"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def lookup(wanted: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, ids) of the documents whose doc_id is in ``wanted``; only their blocks are opened."""
    spark = wanted.sparkSession
    dictionary, width = _dictionary(spark, path)
    schema = "doc_id long, start long, ids array<long>"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slots, data in zip(batch.column("slots"), batch.column("data")):
                box = Container(data.as_py(), dictionary, width)
                rows = slots.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["doc_id"] for r in rows], pa.int64()),
                        pa.array([r["start"] for r in rows], pa.int64()),
                        pa.array([box.ids(r["slot"]).astype(np.int64) for r in rows], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    index = spark.read.parquet(f"{path}/index")
    hits = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    # A block holds about a megabyte, so its documents are few.
    slots = hits.groupBy("part", "seq").agg(F.collect_list(F.struct("slot", "doc_id", "start")).alias("slots"))
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "seq", "data")
    return slots.join(blocks, ["part", "seq"]).select("slots", "data").mapInArrow(decode, schema)


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
