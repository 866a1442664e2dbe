"""Arrow text columns as flat byte arrays, and word hashes over them, for the operators that scan whole texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multiplier of the polynomial word hash, its inverse modulo 2**64, and the finaliser's two factors.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
FINAL = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: ASCII letters and every byte of a longer UTF-8 sequence.
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = True
LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = np.array(x, dtype=U64)
    x ^= x >> U64(30)
    x *= U64(FINAL[0])
    x ^= x >> U64(27)
    x *= U64(FINAL[1])
    x ^= x >> U64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse; kept for later batches."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 20)
        for name, factor in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, factor, U64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U64)
    return _powers["up"], _powers["down"]


def small_batches(spark, rows: int = 1000) -> None:
    """Hand texts to Python in batches of so many rows: each is held on both sides of the pipe, by every task of an executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Return freed memory to the system, Arrow's and that of the C library, where it has a call for it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 512 << 10) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part holds about max_bytes of text, one row at least; memory follows that size.

    The arrays made over a part take some eighty times its bytes. Spare memory is given back at the end, as a worker
    is kept for other tasks.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, at, data = column.buffers()
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Maximal runs of accepted bytes in flat texts, never across two texts; text i has words first[i] to first[i + 1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, accept: np.ndarray):
        solid = accept[data]
        opens = np.zeros(len(data) + 1, bool)
        opens[offsets[:-1]] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = solid[:-1]
        self.starts = np.flatnonzero(solid & (~before | opens[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        opens[len(data)] = True
        self.ends = np.flatnonzero(solid & (~after | opens[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self._solid, self._opens, self._data = solid, opens, data
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray, tag: int = 0) -> np.ndarray:
        """Hash of the bytes from starts to ends, the same wherever they stand."""
        up, down = powers(len(self._data))
        if self._sums is None:
            self._sums = np.zeros(len(self._data) + 1, U64)
            np.cumsum(BYTE_VALUE[self._data] * up[: len(self._data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + U64(tag))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    def trigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """24-bit codes of the byte triplets inside words, and the word each belongs to."""
        solid, opens, n = self._solid, self._opens, len(self._data)
        if n < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = solid[:-2] & solid[1:-1] & solid[2:] & ~opens[1 : n - 1] & ~opens[2:n]
        at = np.flatnonzero(inside)
        d = self._data.astype(np.int64)
        return (d[at] << 16) | (d[at + 1] << 8) | d[at + 2], np.searchsorted(self.starts, at, "right") - 1
