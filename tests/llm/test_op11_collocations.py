import re
from collections import Counter

import numpy as np
import pytest
from helpers import SF, SMALL, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import _grams as G
from shoplens.llm import collocations as K


def brute(rows, threshold=30, most_words=4, first=2000, overlap=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, most_words + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    inside = {}
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                key = (lang, p[i:i + m])
                inside[key] = max(inside.get(key, 0), a)
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) in inside and 100 * inside[lang, p] >= overlap * a:
            continue
        score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for r, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1))


def run(df, **kw):
    return sorted(tuple(r) for r in K.collocations(df, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(0)
    for threshold in (2, 5, 30):
        keys = rng.zipf(1.3, 20_000).astype(np.uint64) % np.uint64(5000)
        s = K.Summary(len(keys) // threshold + 1)
        for part in np.array_split(keys, 13):
            t = K.Summary(s.capacity)
            t.add(*np.unique(part, return_counts=True))
            s.add(t.keys, t.counts)
        true = Counter(keys.tolist())
        assert s.loss < threshold and len(s.keys) <= s.capacity
        assert {k for k, n in true.items() if n >= threshold} <= set(s.may_reach(threshold).tolist())
        assert all(true[k] - s.loss <= n <= true[k] for k, n in zip(s.keys.tolist(), s.counts.tolist()))


def test_small_summaries_do_lose_counts():
    s = K.Summary(10)
    s.add(np.arange(100, dtype=np.uint64), np.arange(1, 101))
    assert len(s.keys) <= 10 and s.loss >= 90


@pytest.mark.parametrize("root,threshold", [(SMALL, 8), (SF, 30)])
def test_equals_brute_force(spark, root, threshold):
    docs = C.table(spark, root, "documents")
    want = brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()], threshold)
    assert len(want) > 100
    assert run(docs, threshold=threshold) == want


def test_many_partitions_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(K, "CHUNK", 5000)
    monkeypatch.setattr(K, "PART_MASS", 4000)
    monkeypatch.setattr(K, "BITS", 12)  # a filter that lets much through
    monkeypatch.setattr(K, "MOST_HELD", 500)
    docs = C.table(spark, SMALL, "documents")
    want = brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()], 5, first=50)
    assert run(docs.repartition(7), threshold=5, first=50) == want


def test_packed_numbers():
    for x in (np.array([0, 1, 255, 256, (1 << 32) - 1]), np.zeros(0), np.arange(1000)):
        assert K.unpacked(K.packed(x)).tolist() == x.tolist()


def test_words_of_two_gigabytes_of_one_language_are_counted(spark):
    """Counts add up over stretches, also past 32 bits."""
    blocks = [(0, K.zstandard.compress(K._named(b"a\tb", 0, b"")), K.packed(np.array([(1 << 32) - 1]))) for _ in range(3)]
    rows = K.pa.table({"part": [0] * 3, "phrases": [b for _, b, _ in blocks], "counts": [c for _, _, c in blocks]})
    total = sum(int(K.unpacked(n)[0]) for n in rows.column("counts").to_pylist())
    assert total == 3 * ((1 << 32) - 1)
    df = spark.createDataFrame([("a\tb", "x y x y"), ("a\tb", "x y")], "lang string, text string")
    assert run(df, threshold=2) == brute([tuple(r) for r in df.collect()], 2)


def test_filter_misses_no_key(spark):
    keys = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    bits = G.Bits.of(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", 16)
    assert bits.hits(keys.view(np.uint64)).all()
    assert bits.hits(np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)).mean() < 0.1


def test_edge_cases(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert run(docs, threshold=2) == brute(rows, 2)
    assert run(docs, threshold=1, first=40) == brute(rows, 1, first=40)
    assert K.collocations(empty_docs(spark)).collect() == []
    rows = [(None, "x y x y x y"), ("und", "X\ty.x  y"), ("a", ""), (None, None), ("a", "é é é\x0bé é"), ("a", "b\x00c d b\x00c d")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert run(df, threshold=2) == brute(rows, 2)
    assert run(df, threshold=2, most_words=2) == brute(rows, 2, 2)


def test_a_language_with_most_rows(spark):
    rows = [("en", "alpha beta gamma")] * 400 + [("fr", "alpha beta")] * 40 + [(None, "beta gamma delta")] * 35
    assert run(spark.createDataFrame(rows, "lang string, text string")) == brute(rows)
