"""Hashes of the words of many texts at once, as numpy arrays over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from shelfwise.llm import ship

ship(__name__)

# Texts are worked on in groups of about this many bytes (a longer text is a group of its own).
GROUP_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C13  # odd; 3 modulo 8
WORD_BASE = 0xD1342543DE82EF9B


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, base: int):
        self._base = base
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", self._base), ("down", pow(self._base, -1, 2**64))):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))


@dataclass
class Words:
    """Words of a group of texts in order: the row they belong to, their hash and their bytes' places."""

    n_rows: int
    row: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def row_bounds(self) -> np.ndarray:
        return np.searchsorted(self.row, np.arange(self.n_rows + 1))


class Hasher:
    def __init__(self, lower: bool):
        self._lower = lower
        table = mixed(np.arange(256, dtype=np.uint64), 1)
        if lower:
            table[65:91] = table[97:123]
        self._table = table
        self._bytes, self._words = Powers(BASE), Powers(WORD_BASE)

    def words(self, texts: list[bytes | None]) -> Words:
        """Texts are split at the bytes 9 to 13 and 32."""
        sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
        data = np.frombuffer(b"".join(t for t in texts if t), np.uint8)
        n = len(data)
        self._bytes.reach(n + 1)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        first = np.zeros(n + 1, bool)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        first[bounds] = True
        before = np.concatenate([[True], gap[:-1]]) if n else np.zeros(0, bool)
        after = np.concatenate([gap[1:], [True]]) if n else np.zeros(0, bool)
        start = np.flatnonzero(~gap & (before | first[:n]))
        end = np.flatnonzero(~gap & (after | first[1:])) + 1
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._table[data] * self._bytes.up[:n])])
        raw = (sums[end] - sums[start]) * self._bytes.down[start]
        hashes = mixed(raw ^ (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407), 2)
        row = np.searchsorted(bounds, start, side="right") - 1
        self._words.reach(len(start) + 1)
        return Words(len(texts), row, hashes, start, end, data)

    def grams(self, found: Words, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words of one text, and the numbers of their first words."""
        n = len(found.hash)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.hash * self._words.up[:n])])
        raw = (sums[k:] - sums[:-k]) * self._words.down[:n - k + 1]
        at = np.flatnonzero(found.row[k - 1:] == found.row[:n - k + 1])
        return mixed(raw[at], 16 + salt), at

    def whole(self, found: Words, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """One hash for all words of each of some short rows, apart from all hashes of runs."""
        out = np.zeros(len(rows), np.uint64)
        for i, r in enumerate(rows):
            h = found.hash[bounds[r]:bounds[r + 1]]
            out[i] = (h * self._words.up[:len(h)]).sum(dtype=np.uint64) + np.uint64(len(h))
        return mixed(out, 7)


def groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """The texts of a batch in groups of bounded size, with the first and last row of each."""
    texts = batch.column(column)
    first, held, out = 0, 0, []
    for i in range(batch.num_rows):
        text = texts[i].as_py()
        size = len(text) if text else 0
        if out and held + size > GROUP_BYTES:
            yield first, i, out
            first, held, out = i, 0, []
        out.append(text)
        held += size
    if out:
        yield first, batch.num_rows, out


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Consecutive runs of values as a list column of longs."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False), pa.int64()))
