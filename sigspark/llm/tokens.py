"""Exact tokenisation of whole texts, one encoding for each distinct piece.

A text is cut before every space that follows a printable ASCII character other than a space. Both kinds
of tokenizer used here never let a token cross such a place (the byte-level pattern starts a new word
there, and no sentence piece has a space after another character), so the ids of a text are the ids of
its pieces in order. Pieces of a slice of documents are told apart by their bytes, and each distinct one
goes through the tokenizer library and a bounded memo. A text without such places is one
piece.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from . import common as c

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
MEMO_PIECES = 400_000


def vocabulary_path(name: str) -> str:
    """Where the file of a public tokenizer is on this machine and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


# One word of the byte-level pattern for certain: ASCII letters, perhaps after a space.
WORD = re.compile(rb" ?[A-Za-z]+")


class ByteBpe:
    """A ``tokenizers`` file. ``plain`` treats the strings of special tokens as text.

    A piece that is one word goes straight to the library's model, which takes half the time; in the byte-level
    alphabet it reads as it is, with another character for the space."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        model, single = self.model, WORD.fullmatch
        out = [
            [t.id for t in model.tokenize(p.decode().replace(" ", "\u0120"))] if single(p) else None for p in pieces
        ]
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            texts = [pieces[i].decode() for i in rest]
            for i, e in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[i] = e.ids
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id, the byte-level alphabet undone."""
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(kept)]
        alphabet = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(x in alphabet for x in token)
            out[i] = bytes(alphabet[x] for x in token) if known else token.encode()
        return out


class PieceBpe:
    """A ``sentencepiece`` model that puts a space before its input: pieces come with it and lose it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        return self.model.encode([p[1:].decode() for p in pieces], num_threads=1) if pieces else []

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: U+2581 is a space, <0xHH> is a byte."""
        out = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                out.append(bytes([int(piece[3:5], 16)]))
            else:
                out.append(piece.replace("▁", " ").encode())
        return out


class Memo:
    """Ids of distinct pieces, kept between slices, in two generations: when the young one is full it becomes
    the old one, and what is still in use moves back."""

    def __init__(self, tokenizer: ByteBpe | PieceBpe, limit: int = MEMO_PIECES):
        self.tokenizer, self.limit = tokenizer, limit
        self.young, self.old = _Generation(), _Generation()

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, start, size of each piece)."""
        if len(self.young.slots) > self.limit:
            self.young, self.old = _Generation(), self.young
        slots = self.young.slots
        fresh = [p for p in pieces if p not in slots]
        if fresh:
            before = self.old.slots
            moved = [p for p in fresh if p in before]
            self.young.add(moved, *self.old.lists(moved))
            unknown = [p for p in fresh if p not in slots]
            lists = self.tokenizer.encode(unknown)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.young.add(unknown, np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes)
        return self.young.found(pieces)


class _Generation:
    def __init__(self):
        self.slots: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(1 << 12, np.int32), np.zeros(1 << 10, np.int64)
        self.used = 0

    def add(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.slots)
        self.ids, self.ends = _room(self.ids, self.used + len(ids)), _room(self.ends, n + len(sizes))
        self.ids[self.used : self.used + len(ids)] = ids
        self.ends[n : n + len(sizes)] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.slots.update(zip(pieces, range(n, n + len(pieces))))

    def found(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
        starts = np.where(at > 0, self.ends[at - 1], 0)
        return self.ids, starts, self.ends[at] - starts

    def lists(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, starts, sizes = self.found(pieces)
        return ids[c.spread(starts, sizes)], sizes


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


_memos: dict[tuple, Memo] = {}


def memo(kind: type, *settings, limit: int = MEMO_PIECES) -> Memo:
    """The memo of this Python worker, which outlives a task: ids depend on nothing but the piece."""
    key = (kind, *settings, limit)
    if key not in _memos:
        _memos[key] = Memo(kind(*settings), limit)
    return _memos[key]


PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
POINT = np.zeros(256, bool)
POINT[[ord(x) for x in ".,;:!?"]] = True


class Pieces:
    """The pieces of a slice of documents: distinct ones and where each occurs.

    ``points`` also cuts between an ASCII letter and one of ``.,;:!?``, where the byte-level pattern always starts
    a new word and no special token goes on; a sentence piece can go on there."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, points: bool = False):
        at = np.flatnonzero(data[1:] == 0x20) + 1
        cut = np.zeros(len(data), bool)
        cut[at[PRINTABLE[data[at - 1]]]] = True
        if points:
            at = np.flatnonzero(POINT[data[1:]]) + 1
            cut[at[LETTER[data[at - 1]]]] = True
        full = np.diff(offsets) > 0
        # A document's last character stays with what is before it, and every document starts a piece.
        cut[offsets[1:][full] - 1] = False
        cut[offsets[:-1][full]] = True
        starts = np.flatnonzero(cut)
        self.first = np.searchsorted(starts, offsets)
        bounds = np.append(starts, len(data)).astype(np.int64)
        array = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        )
        encoded = array.dictionary_encode()
        self.index = encoded.indices.to_numpy(zero_copy_only=False)
        self.distinct = encoded.dictionary.to_pylist()

    def ids(self, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets of each document in them)."""
        flat, starts, sizes = memo.encode(self.distinct)
        counts = sizes[self.index]
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        return flat[c.spread(starts[self.index], counts)], total[self.first]


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document with a space before it; empty documents stay empty."""
    sizes = np.diff(offsets)
    full = sizes > 0
    moved = np.zeros(len(offsets), np.int64)
    np.cumsum(sizes + full, out=moved[1:])
    out = np.full(int(moved[-1]), 0x20, np.uint8)
    out[c.spread(moved[:-1] + full, sizes)] = data[offsets[0] : offsets[-1]]
    return out, moved
