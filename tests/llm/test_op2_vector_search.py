import numpy as np
from helpers import SF
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import vector_search as V


def brute(ids, vectors, qid, q, k):
    dot = vectors @ q / np.sqrt((vectors * vectors).sum(1) * (q @ q))
    order = [i for i in np.lexsort((ids, -np.round(dot, 12))) if ids[i] != qid]
    return [(int(ids[i]), float(dot[i])) for i in order[:k]]


def test_error_bound_holds_and_estimate_is_close():
    rng = np.random.default_rng(1)
    for dim in (16, 64, 100):
        v, queries = rng.standard_normal((2000, dim)), rng.standard_normal((20, dim))
        codes, scalar = V.encode(v)
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        outside = 0
        for q in queries:
            estimate, bound = V.Query(q).estimate(codes, ones, scalar)
            true = V.units(v) @ V.units(q[None, :])[0]
            outside += (np.abs(estimate - true) > bound).sum()
            assert np.corrcoef(estimate, true)[0, 1] > 0.6
        assert outside / (2000 * 20) < 0.005


def test_recall_against_brute_force(spark):
    rows = C.table(spark, SF, "embeddings").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    index = V.build_index(C.table(spark, SF, "embeddings"))
    got = {}
    for r in V.search(index, index.where("vec_id % 5 = 0"), candidate_block=100, query_block=40).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for i, q in zip(ids, v):
        if i % 5 == 0:
            want = brute(ids, v, i, q, 5)
            found = sorted(got[i])
            assert [x[0] for x in found] == [1, 2, 3, 4, 5]
            assert all(abs(x[2] - dict(brute(ids, v, i, q, len(ids)))[x[1]]) < 1e-12 for x in found)
            hit += len({x[0] for x in want} & {x[1] for x in found})
            total += 5
    assert hit / total >= 0.99


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [5.0, 0.0]), (9, [0.0, 1.0]), (9, [1.0, 1.0]), (8, None),
            (11, [0.0, 0.0]), (12, [nan, 1.0]), (13, [inf, 1.0]), (14, [None, 1.0]), (15, []), (None, [1.0, 0.0]),
            (100, [1.0, 0.0, 0.0]), (101, [0.0, 2.0, 0.0]), (150, [1.0] * 5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "'x' AS rank", "2 AS dim", "3 AS code")
    index = V.build_index(table)
    got = {}
    for r in V.search(index, index.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert got == {0: [(3, 1.0), (7, 1.0), (50, 1.0), (9, round(0.5 ** 0.5, 9))],
                   50: [(0, 1.0), (3, 1.0), (7, 1.0), (9, round(0.5 ** 0.5, 9))],
                   100: [(101, 0.0)]}
    assert V.search(index.where("false"), index.where("false")).count() == 0


def test_many_copies_of_a_vector(spark):
    same = spark.range(400).selectExpr("id AS vec_id", "array(1.0D, 2.0D, 3.0D) AS embedding")
    index = V.build_index(same)
    got = V.search(index, index.where("vec_id % 50 = 0"), candidate_block=64)
    for r in got.groupBy("query_id").agg(F.sort_array(F.collect_list("vec_id")).alias("v")).collect():
        assert r.v == [i for i in range(6) if i != r.query_id][:5]
