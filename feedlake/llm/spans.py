"""Numpy helpers for word sequences: tokenising whole batches, hashing words and windows, key exchange.

Keys are 64-bit hashes. To learn which keys occur in more than one place,
each block of texts sends its sorted keys cell by cell (a cell is a range
of hash values), and a cell answers in the order the keys were sent, so the
answer is a bit or a number per key and needs no keys itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
CHUNK = 1 << 18  # bytes of text whose words are in memory at once
INVERSE_OF = 0xD6E8FEB86659FD93  # odd, hence invertible modulo 2**64


def _tables(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit value per byte; A-Z take those of a-z if ``fold``."""
    values = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)
    if fold:
        values[65:91] = values[97:123]
    return values


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, at least ``n`` of each."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 1)
        base, inverse = INVERSE_OF, pow(INVERSE_OF, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = (out[0], out[1])
        if size <= 16 * CHUNK:
            _POWERS[0] = have
    return have


class Words:
    """Words of a list of texts: where they lie, which text they belong to, their hashes."""

    def __init__(self, raw: list[bytes]):
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        blank = BLANK[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(data) and not blank[0]:
            edge = np.concatenate([[0], edge])
        self.data, self.start, self.end = data, edge[0::2], edge[1::2]
        ends = np.cumsum([len(r) + 1 for r in raw])
        self.text = np.searchsorted(ends, self.start, side="right")
        # words of text i are first[i] .. first[i + 1]
        self.first = np.searchsorted(self.text, np.arange(len(raw) + 1))

    def hashes(self, seed: int, fold: bool = False) -> np.ndarray:
        """A 64-bit hash per word: a polynomial over its bytes, spread."""
        power, inverse = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_tables(seed, fold)[self.data] * power[: len(self.data)], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * inverse[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64))


def windows(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the ``n`` words from each position; windows may run over the end of a text."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    factors = np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out += h[i : len(h) - n + 1 + i] * factors[i]
    return mix(out)


def inside(words: Words, n: int) -> np.ndarray:
    """Whether the window of ``n`` words from each position stays in its text."""
    m = max(0, len(words.start) - n + 1)
    return words.text[:m] == words.text[n - 1 : n - 1 + m]


def chunks(raw: list[bytes], most: int = CHUNK):
    """(first index, texts) of about ``most`` bytes; a longer text is a chunk of its own."""
    part, size, at = [], 0, 0
    for i, r in enumerate(raw):
        if part and size + len(r) > most:
            yield at, part
            part, size, at = [], 0, i
        part.append(r)
        size += len(r)
    if part:
        yield at, part


def cells_of(keys: np.ndarray, n_cells: int) -> np.ndarray:
    """Cell of each key: equal ranges of the top 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(n_cells) >> np.uint64(32)).astype(np.int64)


def planes(keys: np.ndarray) -> bytes:
    """Sorted keys byte plane by byte plane: the top planes hardly vary, so that shuffle compression finds them."""
    return np.ascontiguousarray(keys.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def binary_rows(*columns, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
