"""Words and word n-grams of a slice of texts, as arrays (operators 11 and 12),
and bounded filters over 64-bit keys that are sent to every worker."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import _common as C

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def byte_class(*but: int) -> np.ndarray:
    """All bytes except the named ones."""
    out = np.ones(256, bool)
    out[list(but)] = False
    return out


class Words:
    """Words (runs of bytes of ``inside``) of some rows, A-Z in lower case:
    byte ranges, 64-bit hashes, rows. Words with one of the bytes ``parting``
    between them have different numbers in ``piece``, as have other rows'."""

    def __init__(self, t: C.Texts, inside: np.ndarray, parting: np.ndarray | None = None):
        self.data = LOWER[t.data]
        w = inside[self.data]
        edge = np.zeros(len(w) + 1, bool)  # a row's first byte begins anew
        edge[t.off] = True
        self.start = np.flatnonzero(w & (~np.concatenate([[False], w[:-1]]) | edge[:-1])) if len(w) else np.zeros(0, np.int64)
        self.end = np.flatnonzero(w & (~np.concatenate([w[1:], [False]]) | edge[1:])) + 1 if len(w) else self.start
        self.row_at = np.searchsorted(self.start, t.off)  # first word of each row, and the end
        self.count = np.diff(self.row_at)
        self.row = np.repeat(np.arange(len(t)), self.count)
        self.piece = self.row
        if parting is not None and len(w):
            self.piece = np.cumsum(parting[self.data] | edge[:-1])[self.start]
        self.hash = C.RangeHash(self.data)(self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)

    def grams(self, size: int, salt: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``size`` words inside a piece, and their
        hashes; ``salt`` has a number for each row that its hashes depend on."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:n] == self.piece[size - 1:])
        return at, self.hash_at(at, size, salt)

    def hash_at(self, at: np.ndarray, size: int, salt: np.ndarray | None = None) -> np.ndarray:
        power = C.odd_powers(C.BASES[1], size + 1)
        with np.errstate(over="ignore"):
            h = np.full(len(at), size, np.uint64)
            for j in range(size):
                h += self.hash[at + j] * power[j + 1]
            if salt is not None:
                h += salt[self.row[at]]
        return C.scramble(h)

    def text(self, first: int, size: int) -> bytes:
        return b" ".join(self.data[self.start[k]:self.end[k]].tobytes() for k in range(first, first + size))


class Bits:
    """A set of 64-bit keys as a table of 2**size bits: never misses a key
    that is in it, and lets others through as often as the table is filled.
    Its size is fixed, however many keys there are."""

    def __init__(self, size: int, table: np.ndarray | None = None):
        self.size = size
        self.table = np.zeros(1 << (size - 6), np.uint64) if table is None else table

    @classmethod
    def of(cls, keys: DataFrame, col: str, size: int) -> Bits:
        """From a column of longs. At most 2**(size - 6) longs reach the driver."""
        words = (keys.selectExpr(f"shiftrightunsigned({col}, {64 - size}) AS place").groupBy(F.expr("shiftright(place, 6)").alias("at"))
                 .agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits")))
        out = cls(size)
        got = words.toArrow()
        out.table[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return out

    def hits(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.size)
        return (self.table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def lists(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """A list column from flat values and offsets."""
    return pa.LargeListArray.from_arrays(pa.array(off, pa.int64()), pa.array(values)).cast(pa.list_(pa.int64()))
