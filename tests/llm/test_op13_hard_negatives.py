import math

import numpy as np
import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors, positives=5, negatives=10, scale=256):
    v = {}
    for i, e, y in rows:
        if i is not None and y is not None and e and all(x is not None and math.isfinite(x) for x in e):
            v[i] = ([math.floor(scale * float(np.float32(x))) for x in e], y)
    out = []
    for i, (q, y) in v.items():
        if not anchors(i):
            continue
        score = {j: sum(a * b for a, b in zip(q, w)) for j, (w, _) in v.items() if j != i and len(w) == len(q)}
        best = sorted((-s, j) for j, s in score.items() if v[j][1] == y)[:positives]
        for p, j in best:
            inside = sorted((-s, k) for k, s in score.items() if v[k][1] != y and 30 * -p <= 100 * s <= 90 * -p)
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def run(df, every=100, **kw):
    return sorted(tuple(r) for r in H.mine(H.build_index(df), F.expr(f"vec_id % {every} = 0"), **kw).collect())


def clusters(rng, n, dim, labels=6):
    centres = rng.standard_normal((labels * 2, dim))
    at = rng.integers(0, labels * 2, n)
    v = centres[at] + 0.6 * rng.standard_normal((n, dim))
    v /= np.sqrt((v ** 2).sum(axis=1, keepdims=True))
    return [(int(i), [float(x) for x in r], int(a % labels)) for i, (r, a) in enumerate(zip(v, at))]


def test_intervals_always_hold_the_score():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 100, 200):
        v = np.floor(256 * rng.standard_normal((400, dim)) * rng.exponential(1, (400, 1))).astype(np.int32)
        v[5] = 0
        codes, align, length = H.encode(v)
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        for q in [*v[:20], v[0] * 1000]:
            _, low, high = H.Anchor(q.astype(np.int64)).intervals(codes, ones, align, length)
            s = v.astype(np.int64) @ q.astype(np.int64)
            assert (low <= s).all() and (s <= high).all()


def test_the_filter_leaves_rows_unscored():
    """In a cell of thousands, most rows are never scored, and none is missed."""
    rng = np.random.default_rng(3)
    rows = clusters(rng, 6000, 64)
    v = np.floor(256 * np.array([r[1] for r in rows], np.float32)).astype(np.int32)
    labels = np.array([r[2] for r in rows])
    block = H.Block(np.arange(len(rows)), labels, v.astype(np.int64), *H.encode(v))
    asked, scored = 0, []
    for i in range(0, 600, 20):
        q, at = v[i].astype(np.int64), np.flatnonzero(block.labels == labels[i])
        at = at[block.ids[at] != i]
        some = [x[at] for x in block.intervals(H.Anchor(q), slice(None))]
        [(places, s)] = H.best_in(block, q, at, *some, 5, [(-np.inf, np.inf)], scored)
        true = sorted((-int(v[j].astype(np.int64) @ q), int(j)) for j in np.flatnonzero(labels == labels[i]) if j != i)[:5]
        assert [(-a, int(b)) for a, b in zip(s.tolist(), block.ids[at[places]])] == true
        asked += len(at)
    assert sum(scored) < 0.8 * asked


@pytest.mark.parametrize("n,dim,every,blocks", [(700, 64, 10, (100, 9)), (300, 5, 7, (65536, 16384)), (400, 70, 20, (64, 4))])
def test_equals_brute_force(spark, monkeypatch, n, dim, every, blocks):
    monkeypatch.setattr(H, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(H, "ANCHOR_BLOCK", blocks[1])
    rows = clusters(np.random.default_rng(n), n, dim)
    want = brute(rows, lambda i: i % every == 0)
    assert len(want) > 50
    assert run(spark.createDataFrame(rows, DDL).repartition(3), every) == want


def test_the_small_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in C.table(spark, SMALL, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in H.op13_hard_negatives(spark, SMALL).collect())
    assert got == brute(rows, lambda i: i % 100 == 0) and got


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.9, 0.0], 1), (3, [0.5, 0.5], 2), (4, [0.5, -0.5], 2), (5, [0.5, 0.1], 2),
            (6, None, 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 2), (9, [None, 1.0], 2), (10, [1.0, 0.0], None), (None, [1.0, 0.0], 1),
            (11, [0.0, 0.0], 3), (12, [], 3), (13, [1.0], 1), (14, [-1.0, 0.0], 4), (100, [0.0, 0.0], 3), (200, [-1.0, 0.2], 5),
            (201, [0.2, 1.0], 5), (300, [1.0], 9), (15, [0.3], 2)]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS dim", "'x' AS code", "2 AS align", "3 AS anchor_id")
    assert run(df) == brute(rows, lambda i: i % 100 == 0)
    assert run(df, 1) == brute(rows, lambda i: True)
    assert run(df, 1, positives=1, negatives=2) == brute(rows, lambda i: True, 1, 2)
    assert run(df.where("false")) == []
    assert run(df.unionByName(df), 1) == brute(rows, lambda i: True)  # a repeated row is one item
    huge = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.2], 2)], DDL)
    assert run(huge, 1) == brute([(1, [1.0, 1.0], 1), (2, [0.5, 0.2], 2)], lambda i: True)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in rng.uniform(1e5, 2.6e5, 40)], i % 2) for i in range(60)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert run(spark.createDataFrame(rows, DDL), 5) == want
