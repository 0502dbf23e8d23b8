"""Whole texts as byte arrays, vectorised hashing inside tasks, and stored intermediate tables.

Arrow hands a task its texts as one byte buffer. Words, grams and windows are found and hashed on
that buffer with numpy, a slice of documents at a time, so memory follows the slice and not the
partition. Words are ``[^\\x20\\x09-\\x0D]+``; the separators are ASCII, so bytes and code points agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_folder

SLICE_BYTES = 1 << 20
NO_ID = -(1 << 63)


def store(df: DataFrame) -> DataFrame:
    """``df`` as a table written in the shared checkpoint folder; cuts the lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_column: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two columns naming a row: its id and a hash of id and text. Rows equal in both have equal
    texts and so equal results. Null ids and texts are fine."""
    return (
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(F.col(id_column).cast("long"), F.col(text)).alias("th"),
    )


# --- texts of a batch ---------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, rows, bytes, offsets) for runs of rows with at most ``limit`` bytes, or one row.

    A null text is empty. ``offsets`` has rows + 1 entries into ``bytes``.
    """
    data, offsets = text_bytes(batch.column(column))
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets of each; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    buffers, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of each word, and index of each document's first word."""
    inside = ~SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# Plain words: runs of ASCII letters, digits and bytes of longer characters, A-Z folded.
PLAIN = np.full(256, 0x20, np.uint8)
for _range in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    PLAIN[list(_range)] = LOWER[list(_range)]


def plain_words(data: np.ndarray, offsets: np.ndarray, prefixes: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, index of the first plain word of each document).

    One hash for each word, or with ``prefixes`` a row: the word and its first bytes; a word that is
    no longer than a prefix has 0 there."""
    plain = PLAIN[data]
    starts, ends, first = find_words(plain, offsets)
    roll = Rolling(BYTE_HASH[plain])
    whole = roll.ranges(starts, ends)
    if not prefixes:
        return whole, first
    parts = [
        np.where(ends - starts > k, roll.ranges(starts, np.minimum(starts + k, ends), 20 + k), np.uint64(0))
        for k in prefixes
    ]
    return np.stack([whole, *parts], 1), first


# --- hashing --------------------------------------------------------------------------------------


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) with a seed."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any ranges of a sequence from one pass of prefix sums modulo 2**64."""

    BASE = 0xD1342543DE82EF95
    INVERSE = pow(BASE, -1, 2**64)
    _powers: dict[int, np.ndarray] = {}

    @classmethod
    def powers(cls, base: int, n: int) -> np.ndarray:
        have = cls._powers.get(base)
        if have is None or len(have) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length()) if n > 1 else 1 << 16
            have = np.empty(size, np.uint64)
            have[0] = 1
            filled = 1
            with np.errstate(over="ignore"):
                while filled < size:
                    step = np.uint64(pow(base, filled, 2**64))
                    have[filled : 2 * filled] = have[: min(filled, size - filled)] * step
                    filled *= 2
            cls._powers[base] = have
        return have[:n]

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers(self.BASE, n), out=self.sums[1:])
        self.back = self.powers(self.INVERSE, n + 1)

    def ranges(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts], seed)

    def grams(self, n: int, seed: int = 0) -> np.ndarray:
        """Hash of every run of ``n`` values, documents' borders ignored."""
        m = len(self.sums) - n
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:m]) * self.back[:m], seed)


BYTE_HASH = mix(np.arange(256, dtype=np.uint64), 7)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word; ``lower`` folds A-Z first."""
    table = BYTE_HASH[LOWER] if lower else BYTE_HASH
    return Rolling(table[data]).ranges(starts, ends)


def gram_rows(first: np.ndarray, n: int) -> np.ndarray:
    """Index of the first word of every n-word run that stays inside its document."""
    return spread(first[:-1], np.maximum(np.diff(first) - n + 1, 0))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... with counts[i] entries each."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ahead = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ahead, counts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def distinct_per_row(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row: (values, offsets with n + 1 entries)."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[fresh], rows[fresh]
    return values, np.searchsorted(rows, np.arange(n + 1))


# --- global order ---------------------------------------------------------------------------------


def running_total(df: DataFrame, order: list, weight: Column, out: str) -> DataFrame:
    """Add the sum of ``weight`` over all rows up to and with each row, in ``order``.

    Rows are dealt by ranges of the order, summed in each range, and the sums of the ranges, one row
    each, are added up; no task sees more than a range. ``order`` must decide between any two rows."""
    placed = store(
        df.repartitionByRange(*order).withColumns({"_range": F.spark_partition_id(), "_w": weight})
    )
    sums = placed.groupBy("_range").agg(F.sum("_w").alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_inside", F.sum("_w").over(inside))
        .join(sums, "_range")
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .drop("_range", "_w", "_inside", "_before")
    )
