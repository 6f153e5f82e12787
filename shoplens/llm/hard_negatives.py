"""Hard-negative mining by rotated one-bit codes (operator 13).

Vectors become whole numbers, floor(scale * x), and a score is a whole inner
product. For each anchor, the ``positives`` best other rows of its label are
its positives, and for each of these the ``negatives`` best rows of other
labels whose score lies between two hundredths of the positive's score.

A row's vector, at length one and rotated by a fixed random rotation, is kept
as its signs, packed, and its alignment: the inner product a of the rotated
vector o with its code's corner x. With c the inner product of a rotated
anchor q with x, the part of o along x adds a * c to <q, o>; the rest of o has
length sqrt(1 - a^2) and is orthogonal to x, so by Cauchy-Schwarz it adds at
most sqrt(1 - a^2) * sqrt(|q|^2 - c^2) either way. c comes from popcounts of
the code with the bit planes of the anchor's components, cut to 8 bits, and
that rounding widens the interval. So the interval always holds the score. A
few rows of the best estimates are scored; rows whose interval can neither
reach the score of the last one kept nor the window fall out; the others are
scored in whole numbers, which alone decide.

Anchors are a stated query set: blocks of rows meet blocks of anchors in cells
of bounded size. Nothing is broadcast.

Edge cases: rows with a null id, label or vector, with a null or non-finite
component or one of 2**26 / scale or more (whose scores would not fit a long)
take no part; only vectors of one dimension are compared; a zero vector scores
0 with all; rows that share an id are one item, never its own positive or
negative, and the best of their scores counts; ties go to the smaller id; a
window of a negative positive score is empty; an empty table gives an empty
result; columns of any other name do not matter.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import _common as C

SEED = 13
SCALE = 256
LIMIT = 1 << 26
PLANES = 8
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # hundredths of the positive's score
ROW_BLOCK, ANCHOR_BLOCK, LEAST_BLOCK = 65536, 16384, 8192
FIRST_SCORED = 128


@functools.lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs (whole 64-bit words), alignments and lengths."""
    dim = v.shape[1]
    length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
    turned = (v / np.maximum(length, 1.0)[:, None]) @ rotation(dim).T
    bits = np.zeros((len(v), -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned > 0
    align = np.where(length > 0, np.abs(turned).sum(axis=1) / np.sqrt(dim), 1.0)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), np.minimum(align, 1.0), length


class Anchor:
    """A rotated anchor in bit planes: component i is about low + step * u_i."""

    def __init__(self, v: np.ndarray):
        turned = rotation(len(v)) @ v.astype(np.float64)
        self.dim, self.low = len(v), float(turned.min())
        self.square = float((turned ** 2).sum())
        self.step = max((float(turned.max()) - self.low) / ((1 << PLANES) - 1), 1e-300)
        u = np.rint((turned - self.low) / self.step).astype(np.int64)
        planes = np.zeros((PLANES, -(-self.dim // 64) * 64), np.uint8)
        for j in range(PLANES):
            planes[j, :self.dim] = u >> j & 1
        self.planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
        self.total = self.low * self.dim + self.step * float(u.sum())

    def intervals(self, codes: np.ndarray, ones: np.ndarray, align: np.ndarray, length: np.ndarray):
        """(estimate, lowest, highest) score of each row."""
        chosen = np.zeros(len(codes), np.int64)
        for j in range(PLANES):
            chosen += np.bitwise_count(codes & self.planes[j]).sum(axis=1, dtype=np.int64) << j
        c = (2 * (self.low * ones + self.step * chosen) - self.total) / np.sqrt(self.dim)
        rounding = self.step * np.sqrt(self.dim) / 2
        across = np.sqrt(np.maximum(self.square - np.maximum(np.abs(c) - rounding, 0.0) ** 2, 0.0))
        spread = align * rounding + np.sqrt(np.maximum(1 - align * align, 0.0)) * across
        slack = 1.0 + 1e-9 * np.sqrt(self.square) * length  # of the double arithmetic
        return length * align * c, length * (align * c - spread) - slack, length * (align * c + spread) + slack


class Block:
    """Rows of a cell, ordered by label."""

    def __init__(self, ids, labels, v, codes, align, length):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.v = ids[order], labels[order], v[order]
        self.codes, self.align, self.length = codes[order], align[order], length[order]
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        self.largest = int(np.abs(self.v).max(initial=0))
        self.doubles = self.v.astype(np.float64)
        self.once = len(np.unique(self.ids)) == len(self.ids)

    def of_label(self, label) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whole inner products; by doubles where these hold them exactly."""
        if self.largest * int(np.abs(q).max(initial=0)) * len(q) < 1 << 53:
            return (self.doubles[at] @ q.astype(np.float64)).astype(np.int64)
        return (self.v[at] * q).sum(axis=1)

    def intervals(self, q: Anchor, at: slice):
        return q.intervals(self.codes[at], self.ones[at], self.align[at], self.length[at])


def first_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, each id once, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    _, once = np.unique(ids[order], return_index=True)
    return order[np.sort(once)[:k]]


def best_in(block: Block, q: np.ndarray, at: np.ndarray, estimate, low, high, k: int, windows: list[tuple[float, float]],
            counted: list | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (least, most): places (of ``at``) and scores of the k
    best rows with least <= score <= most. Rows are scored once for all windows."""
    least, most = min(a for a, _ in windows), max(b for _, b in windows)
    may = np.flatnonzero((high >= least) & (low <= most))
    few = min(FIRST_SCORED, len(may))
    some = may
    if few < len(may):
        likely = np.where(estimate[may] <= most, estimate[may], -np.inf)
        some = may[np.argpartition(-likely, few - 1)[:few]]
        s = np.sort(block.scores(q, at[some]))
        # each id may have several rows, so these are no proof unless ids differ
        if block.once:
            reach = []
            for a, b in windows:
                inside = s[np.searchsorted(s, a, "left"):np.searchsorted(s, b, "right")]
                reach.append(inside[-k] if len(inside) >= k else a)
            may = may[high[may] >= min(reach)]
    if counted is not None:
        counted.append(len(may))
    s = block.scores(q, at[may])
    out = []
    for a, b in windows:
        inside = np.flatnonzero((s >= a) & (s <= b))
        if len(inside) > 4 * k and block.once:
            inside = inside[s[inside] >= -np.partition(-s[inside], k - 1)[k - 1]]
        kept = inside[first_of(block.ids[at[may[inside]]], s[inside], k)]
        out.append((may[kept], s[kept]))
    return out


# -------------------------------------------------------------------- Spark
INDEX = "vec_id long, label long, dim int, v binary, code binary, align double, length double"


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
                scale: int = SCALE) -> DataFrame:
    """INDEX of every row that takes part. ``label`` defaults to the column of that name."""
    usable = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * F.lit(float(scale)) < F.lit(float(LIMIT))))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(usable)
            .withColumn("dim", F.size("x")).where("dim > 0"))

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = b.filter(pa.array(dims == dim))
                x = mine.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                v = np.floor(x * float(scale)).astype(np.int32)
                codes, align, length = encode(v)
                yield pa.RecordBatch.from_arrays(
                    [mine.column("vec_id"), mine.column("label"), mine.column("dim"), pa.array([r.tobytes() for r in v], pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(align), pa.array(length)],
                    names=["vec_id", "label", "dim", "v", "code", "align", "length"])

    C.ship(vectors.sparkSession)
    return rows.select("vec_id", "label", "x", "dim").mapInArrow(run, INDEX)


def _matrix(col, kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dim)


def _block(t: pa.Table) -> Block:
    dim = t.column("dim")[0].as_py()
    return Block(t.column("vec_id").to_numpy(), t.column("label").to_numpy(), _matrix(t.column("v"), np.int32, dim).astype(np.int64),
                 _matrix(t.column("code"), np.uint64, -(-dim // 64)), t.column("align").to_numpy(), t.column("length").to_numpy())


def _cells(index: DataFrame, anchors: DataFrame, find, ddl: str) -> DataFrame:
    """``find`` (a block of rows, a table of anchors) for each cell of both."""
    spark = index.sparkSession
    n, m = index.count(), anchors.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, min(parts, -(-n // LEAST_BLOCK)), -(-n // ROW_BLOCK))
    anchor_blocks = max(1, -(-m // ANCHOR_BLOCK))

    def dealt(rows, mine, count, other, others):
        return (rows.withColumn(mine, F.monotonically_increasing_id() % F.lit(count))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))))

    def cell(rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = list(find(_block(rows), asked)) if rows.num_rows and asked.num_rows else []
        cols = list(zip(*found)) or [[]] * len(ddl.split(","))
        return pa.table({x.split()[0]: pa.array(c, pa.int64()) for x, c in zip(ddl.split(","), cols, strict=True)})

    key = ["dim", "c", "a"]
    return (dealt(index, "c", blocks, "a", anchor_blocks).groupBy(*key)
            .cogroup(dealt(anchors, "a", anchor_blocks, "c", blocks).groupBy(*key)).applyInArrow(cell, ddl))


def find_positives(index: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id, positive_score. Both inputs are checkpointed rows of INDEX."""
    def find(block, asked):
        vs = _matrix(asked.column("v"), np.int32, asked.column("dim")[0].as_py()).astype(np.int64)
        for anchor, label, q in zip(asked.column("vec_id").to_pylist(), asked.column("label").to_pylist(), vs):
            first, end = block.of_label(label)
            at = first + np.flatnonzero(block.ids[first:end] != anchor)
            if len(at):
                some = [x[at - first] for x in block.intervals(Anchor(q), slice(first, end))]
                [(places, scores)] = best_in(block, q, at, *some, k, [(-np.inf, np.inf)])
                yield from ((anchor, i, s) for i, s in zip(block.ids[at[places]].tolist(), scores.tolist()))

    found = _cells(index, anchors, find, "anchor_id long, positive_id long, positive_score long")
    found = found.groupBy("anchor_id", "positive_id").agg(F.max("positive_score").alias("positive_score"))
    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def find_negatives(index: DataFrame, anchors: DataFrame, positives: DataFrame, k: int = NEGATIVES, least: int = LEAST,
                   most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    pairs = positives.groupBy("anchor_id").agg(F.collect_list("positive_id").alias("ids"), F.collect_list("positive_score").alias("scores"))
    asking = C.cut(anchors.select("vec_id", "label", "dim", "v").join(pairs, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"))

    def find(block, asked):
        vs = _matrix(asked.column("v"), np.int32, asked.column("dim")[0].as_py()).astype(np.int64)
        ids, scores = asked.column("ids").to_pylist(), asked.column("scores").to_pylist()
        for n, (anchor, label, q) in enumerate(zip(asked.column("vec_id").to_pylist(), asked.column("label").to_pylist(), vs)):
            at = np.flatnonzero((block.labels != label) & (block.ids != anchor))
            if not len(at):
                continue
            pairs = [(positive, p) for positive, p in zip(ids[n], scores[n]) if p >= 0]
            if not pairs:
                continue
            some = [x[at] for x in block.intervals(Anchor(q), slice(None))]
            windows = [(-(-least * p // 100), most * p // 100) for _, p in pairs]
            for (positive, p), (places, got) in zip(pairs, best_in(block, q, at, *some, k, windows)):
                yield from ((anchor, positive, p, i, s) for i, s in zip(block.ids[at[places]].tolist(), got.tolist()))

    found = _cells(index, asking, find, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    found = found.groupBy("anchor_id", "positive_id", "positive_score", "negative_id").agg(F.max("negative_score").alias("negative_score"))
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def mine(index: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST,
         most: int = MOST) -> DataFrame:
    """Hard negatives of the rows of ``index`` (of build_index) for which ``anchors`` holds."""
    index = C.cut(index)
    asking = C.cut(index.where(anchors))
    return find_negatives(index, asking, C.cut(find_positives(index, asking, positives)), negatives, least, most)


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    noisy = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return mine(build_index(C.table(spark, sf_dir, "embeddings"), label=noisy), F.expr("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label AS anchor_label, c.id, c.label, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.id % 100 = 0 AND a.id <> c.id AND len(a.e) = len(c.e)),
p AS (SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE s.label <> p.anchor_label AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
