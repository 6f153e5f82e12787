import numpy as np
from helpers import SF, edge_docs, empty_docs
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import quality_rules as Q


def test_statistics_against_a_plain_count():
    import pyarrow as pa

    texts = [None, "", "a a b\nB! É|é 12 ..", "x" * 40, "  ", "é é\té", "", "@^~ <a> = _x_ {1} \\ -- ?!", "&&& | *"]
    got = np.stack(Q.measure(C.texts_of(pa.array(texts, pa.string()))), axis=1)
    for row, text in zip(got, texts):
        text = text or ""
        words = text.split()
        s = dict(zip(Q.STATISTICS, row))
        assert s["chars"] == len(text) and s["words"] == len(words)
        if words:
            assert np.isclose(s["distinct_words"], len(set(words)) / len(words))
            assert np.isclose(s["doubled_words"], sum(a == b for a, b in zip(words, words[1:])) / len(words))
            assert np.isclose(s["word_length"], sum(map(len, words)) / len(words))
            assert np.isclose(s["bare_words"], sum(not any(c.isalnum() for c in w) for w in words) / len(words))
            assert np.isclose(s["symbols"], sum(c in "#$%&*+/<=>@[\\]^_`{|}~" for c in text) / len(words))
            assert np.isclose(s["stops"], sum(c in ".!?" for c in text) / len(words))
            assert np.isclose(s["capitals"], sum(c in "BÉ" for c in text) / max(1, sum(c.isalpha() for c in text)))


def test_rules_are_paths_and_weights_are_sparse():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6))
    y = ((x[:, 0] > 0.6) & (x[:, 2] <= 0.5)).astype(float)
    m = Q.fit_rules(x, y, list("abcdef"))
    assert 0 < len(m.rules) < len(Q.extract_rules(x, y, Q.TREES, Q.DEPTH))
    assert {k for rule in m.rules for k, _, _ in rule} >= {0, 2}
    z = m.intercept + sum(w * Q.holds(r, x) for r, w in zip(m.rules, m.weights))
    assert np.mean((z > 0) == y) > 0.98


def test_lasso_reaches_the_optimum():
    """The conditions of an optimum: no slope along a weight that is not zero
    beyond the penalty, and none steeper than the penalty along the others."""
    rng = np.random.default_rng(4)
    r = (rng.random((800, 30)) < 0.4).astype(float)
    y = (rng.random(800) < Q.sigmoid(2 * r[:, 0] - 3 * r[:, 1] + r[:, 2] - 0.5)).astype(float)
    for penalty in (0.03, 0.01):
        w, b = Q.lasso(r, y, penalty, 4000)
        slope = r.T @ (Q.sigmoid(r @ w + b) - y) / len(y)
        assert abs((Q.sigmoid(r @ w + b) - y).mean()) < 1e-4
        assert np.abs(slope[w != 0] + penalty * np.sign(w[w != 0])).max() < 1e-3
        assert np.abs(slope[w == 0]).max() <= penalty + 1e-6 and (w == 0).sum() > 10


def test_rule_limits_are_merged():
    assert Q.simplest(((1, True, 0.2), (1, True, 0.5), (1, False, 0.9), (0, False, 3.0))) == (
        (0, False, 3.0), (1, False, 0.9), (1, True, 0.5))


def test_column_expression_equals_the_model(spark):
    docs = C.table(spark, SF, "documents").limit(200)
    measured = Q.with_statistics(docs)
    rows = measured.select("statistics.*").toPandas().to_numpy()
    rng = np.random.default_rng(0)
    y = (rows[:, 9] > np.median(rows[:, 9])).astype(float)
    y[rng.random(len(y)) < 0.05] = 1
    m = Q.fit_rules(rows, y, list(Q.STATISTICS))
    got = Q.score(measured, m).select("statistics.*", "quality.score").toPandas().to_numpy()
    z = m.intercept + sum(w * Q.holds(r, got[:, :-1]) for r, w in zip(m.rules, m.weights))
    assert np.allclose(got[:, -1], Q.sigmoid(z), atol=1e-12)


def test_edge_cases(spark):
    docs = edge_docs(spark)
    m = Q.Model(list(Q.STATISTICS), [((1, True, 2.0),)], [2.0], -0.5)
    got = Q.score(Q.with_statistics(docs), m)
    assert got.count() == docs.count()
    assert all(0 <= r.quality.score <= 1 and r.quality.predicted == int(r.quality.score >= 0.3) for r in got.collect())
    assert Q.score(Q.with_statistics(empty_docs(spark)), m).count() == 0
    none = Q.with_statistics(docs).withColumn("label", F.lit(None).cast("int"))
    assert Q.fit(none, "label").rules == []
    one = Q.fit(none.withColumn("label", F.lit(1)), "label")
    assert one.rules == [] and one.intercept > 0


def test_junk_of_other_symbols_is_seen_too(spark):
    """The same documents with signs in their junk that the given ones lack."""
    docs = C.table(spark, SF, "documents").select("doc_id", F.translate("text", "!#$%&*|", "@^~=<>_").alias("text"))
    held_out = C.by_crc("doc_id", 5) == 0
    measured = Q.with_statistics(docs).join(C.table(spark, SF, "labels").select("doc_id", "quality"), "doc_id")
    model = Q.fit(measured.where(~held_out), "quality")
    got = Q.score(measured.where(held_out), model, name="q").agg(F.avg((F.col("q.predicted") == F.col("quality")).cast("int"))).first()
    assert got[0] > 0.95


def test_held_out_accuracy(spark):
    got = Q.op3_quality_rules(spark, SF)
    assert got.count() == 1000 and got.where("score < 0 OR score > 1").count() == 0
    labels = C.table(spark, SF, "labels")
    row = got.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert row[0] > 0.95
