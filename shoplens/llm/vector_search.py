"""Approximate nearest neighbours by randomly rotated one-bit codes (operator 2).

Every vector is scaled to length one and rotated by a fixed random rotation.
Its code is one sign bit per dimension, packed, and its correction scalar the
inner product of the rotated vector with its code's corner. The inner product
of a query with the corner, divided by the scalar, estimates the cosine without
bias; its error is within ``width`` standard deviations of a bound that the
scalar gives. A query's rotated components are cut into bit planes, so the
estimate is popcounts of packed bits. Exact cosines of the best estimates set a
threshold; only vectors whose estimate plus bound reaches it are reranked, by
the exact cosine of the original vectors.

Search is block against block: candidates and queries are dealt by hash into
cells of bounded size, each cell returns its k nearest per query, and these are
merged. Nothing is broadcast.

Edge cases: null and zero vectors, vectors with null or non-finite components
and rows without an id take no part; only vectors of one dimension are
compared; rows that share an id are one item, the nearest of its vectors
counts, and an item is never its own neighbour; ties go to the smaller id; an
empty table gives an empty result; columns of any other name do not matter.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import _common as C

SEED = 20
PLANES = 8
WIDTH = 3.0
CANDIDATE_BLOCK = 65536
QUERY_BLOCK = 16384


@functools.lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def vectors_of(col) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(arr), -1)


def units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed codes (whole 64-bit words) and correction scalars."""
    dim = v.shape[1]
    turned = units(v) @ rotation(dim).T
    bits = np.zeros((len(v), -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), np.abs(turned).sum(axis=1) / np.sqrt(dim)


class Query:
    """A rotated query in bit planes: component i is about low + step * u_i."""

    def __init__(self, vector: np.ndarray):
        dim = len(vector)
        turned = units(vector[None, :])[0] @ rotation(dim).T
        self.dim, self.low = dim, float(turned.min())
        self.step = max((float(turned.max()) - self.low) / ((1 << PLANES) - 1), 1e-300)
        u = np.rint((turned - self.low) / self.step).astype(np.int64)
        planes = np.zeros((PLANES, -(-dim // 64) * 64), np.uint8)
        for j in range(PLANES):
            planes[j, :dim] = u >> j & 1
        self.planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
        self.total = self.low * dim + self.step * float(u.sum())

    def estimate(self, codes: np.ndarray, ones: np.ndarray, scalar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines and their error bounds."""
        chosen = np.zeros(len(codes), np.int64)
        for j in range(PLANES):
            chosen += np.bitwise_count(codes & self.planes[j]).sum(axis=1, dtype=np.int64) << j
        corner = (2 * (self.low * ones + self.step * chosen) - self.total) / np.sqrt(self.dim)
        rounding = self.step * np.sqrt(self.dim) / 2
        spread = WIDTH * np.sqrt(np.maximum(1 - scalar * scalar, 0) / max(self.dim - 1, 1))
        return corner / scalar, (spread + rounding) / scalar


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows with one vector, summed dimension by dimension,
    so that equal vectors get equal values."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[k]
    return out


def lengths(v: np.ndarray) -> np.ndarray:
    out = np.zeros(len(v))
    for k in range(v.shape[1]):
        out += v[:, k] * v[:, k]
    return out


def nearest(ids: np.ndarray, v: np.ndarray, codes: np.ndarray, scalar: np.ndarray, query_ids: np.ndarray,
            queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, cosine) of the k nearest of a cell, for each query."""
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    square = lengths(v)
    out = []

    def exact(q, q_square, at):
        return np.clip(in_order(v[at], q) / np.sqrt(square[at] * q_square), -1.0, 1.0)

    def best(at, cos):
        order = np.lexsort((ids[at], -cos))
        _, first = np.unique(ids[at][order], return_index=True)
        return order[np.sort(first)[:k]]

    for qid, q in zip(query_ids.tolist(), queries):
        q_square = lengths(q[None, :])[0]
        estimate, bound = Query(q).estimate(codes, ones, scalar)
        others = ids != qid
        top = np.flatnonzero(others)
        if not len(top):
            continue
        few = min(8 * k, len(top))
        top = top[np.argpartition(-estimate[top], few - 1)[:few]]
        cos = exact(q, q_square, top)
        keep = best(top, cos)
        threshold = cos[keep[-1]] if len(keep) == k else -2.0
        maybe = np.flatnonzero(others & (estimate + bound >= threshold))
        rest = np.union1d(maybe, top[keep])
        cos = exact(q, q_square, rest)
        out += [(qid, int(ids[rest[i]]), float(cos[i])) for i in best(rest, cos)]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v, dim of the vectors that take part."""
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v, dim, code, scalar of every usable vector."""
    rows = usable(vectors, id_col, vector_col)
    kind = rows.schema["v"].dataType.simpleString()

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = b.filter(pa.array(dims == dim))
                codes, scalar = encode(vectors_of(mine.column("v")))
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([*mine.columns, packed, pa.array(scalar)],
                                                 names=["vec_id", "v", "dim", "code", "scalar"])

    C.ship(vectors.sparkSession)
    return rows.mapInArrow(run, f"vec_id long, v {kind}, dim int, code binary, scalar double")


def search(index: DataFrame, queries: DataFrame, k: int = 5, candidate_block: int = CANDIDATE_BLOCK,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. ``index``: of build_index; ``queries``:
    vec_id, v, dim."""
    spark = index.sparkSession
    n, m = index.count(), queries.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(parts, -(-n // candidate_block))  # at least a cell for each task
    query_blocks = max(1, -(-m // query_block))

    def dealt(rows, mine, count, other, other_count):
        return (rows.withColumn(mine, F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_count - 1).cast("long")))))

    left = dealt(index, "c", blocks, "q", query_blocks)
    right = dealt(queries.select("vec_id", "v", "dim"), "q", query_blocks, "c", blocks)

    def cell(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asked.num_rows:
            codes = np.frombuffer(b"".join(candidates.column("code").to_pylist()), np.uint64)
            found = nearest(candidates.column("vec_id").to_numpy(), vectors_of(candidates.column("v")),
                            codes.reshape(candidates.num_rows, -1), candidates.column("scalar").to_numpy(),
                            asked.column("vec_id").to_numpy(), vectors_of(asked.column("v")), k)
        cols = list(zip(*found)) or [[], [], []]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    key = ["dim", "c", "q"]
    found = (left.groupBy(*key).cogroup(right.groupBy(*key))
             .applyInArrow(cell, "query_id long, vec_id long, score double"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op2_rotated_bit_search(spark, sf_dir: str) -> DataFrame:
    index = C.cut(build_index(C.table(spark, sf_dir, "embeddings")))
    return search(index, index.where("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
