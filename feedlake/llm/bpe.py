"""Byte-level BPE encoding and decoding in linear time.

Each piece of text (by the vocabulary's split pattern) is encoded on its
own. An Aho-Corasick automaton over the vocabulary (bytes as Latin-1
characters) gives the longest token at every position of a piece; a
backtracking walk takes the longest token that is compatible with the one
before it, and falls back to shorter prefixes. Two adjacent tokens are
compatible when merging their bytes by rank would end in just these two;
that test is memoised per pair. A position found to lead nowhere is never
tried again, so a piece of n bytes takes O(n) steps, however long it is.

The result is that of the rank-ordered merges. A piece that is a token
itself is that token. Vocabulary files are read on each executor from
``path``; they are never shipped.

The letter classes are those of the installed ``regex`` module; characters
that its Unicode version has assigned and an older one has not may split
differently there.

Defined results: null text is empty and has no ids; lone blanks, control
characters and special-token strings are ordinary text; repeated rows are
encoded each; extra columns are ignored; an empty table gives an empty one.
Every text is processed whole.
"""

from __future__ import annotations

import base64
import gc
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import hand_back

MEMO = 300_000  # pieces, blank-led parts and compatible pairs each that a task remembers; emptied when full
MEMO_BYTES = 48  # longer pieces are rare and are not remembered
BLANK_RUN = re.compile(r" \s").search
FLUSH_BYTES = 1 << 20


class Encoder:
    """Tables of one vocabulary: ranks, splits, longest proper prefixes, automaton."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks, self.memo = ranks, memo
        self.bytes_of = tokens_of(ranks)
        size = len(self.bytes_of)
        # a token of one byte is its own left and right part
        self.left = list(range(size))
        self.right = list(range(size))
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        reachable = []
        for rank, token in enumerate(self.bytes_of):
            if len(token) == 1 or (token and self._split(rank, token)):
                reachable.append(rank)
        self.automaton = ahocorasick.Automaton()
        live = {self.bytes_of[r]: r for r in reachable}
        self.sizes = [len(token) for token in self.bytes_of]
        self.shorter = [-1] * size
        for rank in reachable:
            token = self.bytes_of[rank]
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
            self.shorter[rank] = next((live[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in live), -1)
        self.automaton.make_automaton()
        self.find = regex.compile(pattern).findall
        self.pieces = _Pieces(self)
        self.parts = _Parts(self)

    def _split(self, rank: int, token: bytes) -> bool:
        """Find the two tokens whose merge makes ``token``; False if no merge does."""
        for n in range(len(token) - 1, 0, -1):
            a, b = self.ranks.get(token[:n], rank), self.ranks.get(token[n:], rank)
            if a < rank and b < rank and self._compatible(a, b):
                self.left[rank], self.right[rank] = a, b
                self.joined[a, b] = rank
                return True
        return False

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border of ``a b`` comes before those that make a and b.

        The later-made of the two is opened again at the border, step by
        step; a merge of the parts that meet there must not have come earlier.
        """
        before = len(self.bytes_of)  # merges of this rank or later have not happened yet
        while True:
            if self.joined.get((a, b), before) < before:
                return False
            if a > b:
                before, a = a, self.right[a]
                if a == before:  # a byte: open the other side instead
                    before, b = b + 1, self.left[b]
                    if b + 1 == before:
                        return True
            else:
                before, b = b + 1, self.left[b]
                if b + 1 == before:
                    before, a = a, self.right[a]
                    if a == before:
                        return True

    def piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * (len(piece) + 1)
        for end, (rank, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank  # ends grow, so the last match of a start is its longest
        if len(self.fits) > self.memo:
            self.fits.clear()
        sizes, shorter, fits, n = self.sizes, self.shorter, self.fits, len(piece)
        closed: set[int] = set()
        out: list[int] = []
        at, token, last = 0, longest[0], 0
        while at < n:
            while token >= 0:
                end = at + sizes[token]
                if end not in closed:
                    if not out:
                        break
                    ok = fits.get((last, token))
                    if ok is None:
                        ok = fits[last, token] = self._compatible(last, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                last, at, token = token, end, longest[end]
            else:  # nothing fits from here: never come back, retry the token before
                closed.add(at)
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else 0
        return out

    def ids(self, piece: str) -> bytes:
        return np.array(self.piece(piece.encode()), "<u4").tobytes()

    def forget(self) -> None:
        """Empty the memos; the tables stay."""
        self.fits.clear()
        self.pieces.clear()
        self.parts.clear()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A blank before a non-blank always starts a piece of its own, so text
        may be cut there and the parts remembered whole; where a blank meets
        another one, the pattern is run over the text instead.
        """
        if len(self.pieces) > self.memo:
            self.pieces.clear()
        if BLANK_RUN(text):
            return b"".join(map(self.pieces.__getitem__, self.find(text)))
        if len(self.parts) > self.memo:
            self.parts.clear()
        parts = iter(text.split(" "))
        first = b"".join(map(self.pieces.__getitem__, self.find(next(parts))))
        return first + b"".join(map(self.parts.__getitem__, parts))


class _Pieces(dict):
    """Ids of the pieces seen lately."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.ids(piece)
        if len(piece) <= MEMO_BYTES:
            self[piece] = ids
        return ids


class _Parts(dict):
    """Ids of a blank and the text up to the next blank, for the texts seen lately."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, part: str) -> bytes:
        found = self.encoder.find(" " + part)
        # a part that is one piece is remembered once
        ids = self.encoder.ids(found[0]) if len(found) == 1 else b"".join(map(self.encoder.pieces.__getitem__, found))
        if len(part) <= MEMO_BYTES:
            self[part] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@lru_cache(maxsize=2)
def decoder(path: str) -> list[bytes]:
    """All that decoding needs: no automaton, no memos."""
    return tokens_of(read_ranks(path))


def decode_ids(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, memo: int = MEMO) -> Encoder:
    return Encoder(read_ranks(path), pattern, memo)


def _slices(batch: pa.RecordBatch, make) -> Iterator[pa.RecordBatch]:
    """Apply ``make`` row by row to column 1, in output batches of bounded size."""
    keys, values, size = [], [], 0
    for i in range(batch.num_rows):
        keys.append(batch.column(0)[i].as_py())
        values.append(make(batch.column(1)[i].as_py()))
        size += len(values[-1])
        if size >= FLUSH_BYTES:
            yield keys, values
            keys, values, size = [], [], 0
    if keys:
        yield keys, values


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: ``ids`` is binary, little-endian unsigned 32-bit."""

    def run(batches):
        enc = encoder(path, pattern)
        for batch in batches:
            for keys, ids in _slices(batch, lambda t: enc.encode(t or "")):
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        enc.forget()
        hand_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` of ``doc_id, ids`` rows; ``decoded`` is the UTF-8 text."""

    def run(batches):
        tokens = decoder(path)
        for batch in batches:
            for keys, pairs in _slices_pairs(batch, tokens):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array([p[0] for p in pairs], pa.binary()),
                        pa.array([p[1] for p in pairs], pa.binary()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO, stay: bool = True) -> DataFrame:
    """``doc_id, ids, decoded``: ``encode``, then ``decode`` of its ids, in one pass over the texts.

    The ids do not travel between two Python workers, so a task holds one
    worker and one Arrow batch. ``stay``: whether a worker keeps the tables
    (some 25 MB, built in 0.3 s) for its next task.
    """

    def run(batches):
        enc = encoder(path, pattern, memo)
        for batch in batches:
            for keys, ids in _slices(batch, lambda t: enc.encode(t or "")):
                decoded = [decode_ids(i, enc.bytes_of) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )
            batch = keys = ids = decoded = None  # before the next batch is read
        enc.forget()
        if not stay:
            enc = None
            encoder.cache_clear()
            gc.collect()  # the encoder and its memos refer to each other
        hand_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary, decoded binary")


def _slices_pairs(batch: pa.RecordBatch, tokens: list[bytes]):
    keys, pairs, size = [], [], 0
    for key, ids in zip(batch.column(0), batch.column(1), strict=True):
        ids = ids.as_py() or b""
        keys.append(key.as_py())
        pairs.append((ids, decode_ids(ids, tokens)))
        size += len(ids) + len(pairs[-1][1])
        if size >= FLUSH_BYTES:
            yield keys, pairs
            keys, pairs, size = [], [], 0
    if keys:
        yield keys, pairs


def digest_columns(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
