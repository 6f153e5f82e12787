"""Helpers shared by the operators of this subpackage.

``annotate`` is the way a row-wise operator runs: one pass over the rows of a
DataFrame, all input columns kept, one struct column added under a name that
no input column has. Python sees a text column as one flat byte buffer with
offsets, in slices of about a megabyte, so the memory of a task is set by its
longest single text and not by the number of rows in a batch.
"""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import shoplens
from shoplens.session import scratch_path, shared_dir

SLICE_BYTES = 1 << 20
WORD_SLICE_BYTES = 1 << 21  # where each distinct word of a slice costs more than its copies


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so
    that they need neither the driver's folders nor an installed copy."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(shoplens.__file__).parent
    place = Path(tempfile.mkdtemp(prefix="shoplens-code-")) / "shoplens.zip"
    with zipfile.ZipFile(place, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(place))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file: in ``folder`` if given, else where
    the installed package of vocabularies has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut at a reliable checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of one run in the shared folder: written, read back, and removed
    when they are no longer needed."""

    def __init__(self, spark):
        self.spark, self.paths = spark, {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, table: DataFrame) -> None:
        path, _ = self.paths.pop(id(table))
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def clear(self) -> None:
        for _, table in list(self.paths.values()):
            self.drop(table)


def by_crc(col: str, parts: int):
    """crc32 of a column as text, modulo ``parts``; null counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % F.lit(parts)


@dataclass
class Texts:
    """Some rows' texts: row i is data[off[i]:off[i + 1]]; a null is empty."""

    data: np.ndarray
    off: np.ndarray
    null: np.ndarray
    first: int = 0  # row number of row 0 in the Arrow batch

    def __len__(self) -> int:
        return len(self.off) - 1

    def row(self, i: int) -> bytes:
        return self.data[self.off[i]:self.off[i + 1]].tobytes()


def texts_of(col: pa.Array) -> Texts:
    null = np.asarray(col.is_null())
    arr = col.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    n = len(arr)
    if n == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64), null)
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return Texts(data[off[0]:off[-1]], off - off[0], null)


def slices(t: Texts, budget: int = SLICE_BYTES) -> Iterator[Texts]:
    """Runs of whole rows of at most ``budget`` bytes (a longer row is alone)."""
    i, n = 0, len(t)
    while i < n:
        j = int(np.searchsorted(t.off, t.off[i] + budget, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield Texts(t.data[t.off[i]:t.off[j]], t.off[i:j + 1] - t.off[i], t.null[i:j], t.first + i)
        i = j


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None] | None = None) -> None:
    """Of the operators that run in a Python worker after another, only the
    present one keeps its caches."""
    for other in [x for x in _HELD if x != owner]:
        _HELD.pop(other)()
    if release:
        _HELD[owner] = release


def annotate(df: DataFrame, text_col: str, ddl: str, make: Callable[[], Callable[[Texts, pa.RecordBatch], list]],
             name: str, budget: int = SLICE_BYTES, caches: Callable[[], None] | None = None) -> DataFrame:
    """``df`` plus the struct column ``name`` with the fields of ``ddl``.

    ``make`` runs once per task and returns the function that maps a slice of
    texts (and the Arrow batch it comes from) to one array per field.
    ``caches``, if given, empties what the operator keeps in the worker.
    """
    fields = StructType.fromDDL(ddl)
    out = StructType([*df.schema.fields, StructField(name, fields, False)])
    kinds = [(f.name, t.type) for f, t in zip(fields.fields, arrow_schema(fields), strict=True)]
    at = df.columns.index(text_col)

    def run(batches):
        hold(make.__module__, caches)
        fn = make()
        for batch in batches:
            parts = [fn(s, batch) for s in slices(texts_of(batch.column(at)), budget)]
            if not parts:
                continue
            cols = []
            for k, (_, kind) in enumerate(kinds):
                chunks = [p[k] if isinstance(p[k], pa.Array) else pa.array(p[k], type=kind) for p in parts]
                cols.append(pa.concat_arrays([c if c.type == kind else c.cast(kind) for c in chunks]))
            new = pa.StructArray.from_arrays(cols, names=[n for n, _ in kinds])
            yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, name])
        pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds little

    ship(df.sparkSession)
    return df.mapInArrow(run, out)


# --------------------------------------------------------------- hashing
@functools.lru_cache(maxsize=4)
def _usual_powers(base: int) -> np.ndarray:
    return _odd_powers(base, SLICE_BYTES + 1)


def odd_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _usual_powers(base)[:n] if n <= SLICE_BYTES + 1 else _odd_powers(base, n)


def _odd_powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    size = 1
    with np.errstate(over="ignore"):
        step = np.uint64(base)
        while size < n:
            take = min(size, n - size)
            out[size:size + take] = out[:take] * step
            step = step * step
            size += take
    return out[:n]


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads close values (splitmix64's
    finaliser, a public constant set)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd


@functools.lru_cache(maxsize=2)
def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class RangeHash:
    """Polynomial hashes modulo 2**64 of any byte ranges of one buffer,
    from one prefix sum: equal byte strings get equal values."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        n = len(data)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * odd_powers(base, n), out=self.prefix[1:])
        self.back = odd_powers(inverse(base), n + 1)

    def __call__(self, start, end) -> np.ndarray:
        with np.errstate(over="ignore"):
            return scramble((self.prefix[end] - self.prefix[start]) * self.back[start])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(starts[i], starts[i] + lengths[i])."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.ones(total, np.int64)
    first = ends - lengths
    keep = lengths > 0
    s, f, ln = starts[keep], first[keep], lengths[keep]
    out[f[0]] = s[0]
    out[f[1:]] = s[1:] - (s[:-1] + ln[:-1] - 1)
    return np.cumsum(out)


# -------------------------------------------------------------- segments
def starts_of(t: Texts, inner: np.ndarray) -> np.ndarray:
    """Segment starts: where ``inner`` (for every byte but the first) says
    so, and every non-empty row's first byte."""
    mark = np.empty(len(t.data) + 1, bool)
    mark[1:-1] = inner
    mark[t.off] = True
    mark[-1] = False
    return np.flatnonzero(mark)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Dictionary coding of the segments that begin at ``starts`` (the first
    is 0) and together make up ``data``: codes and distinct segments."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    off = np.append(starts, len(data)).astype(np.int64)
    arr = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
    d = arr.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_pylist()


class Memo(dict):
    """A worker's cache of results by segment; emptied when it is full, so
    that its memory is bounded."""

    def __init__(self, fn, most: int = 200_000, longest: int = 48):
        super().__init__()
        self.fn, self.most, self.longest = fn, most, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value
