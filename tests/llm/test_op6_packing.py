import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, edge_docs, empty_docs
from pyspark.sql import functions as F

from shoplens.llm import _common as C
from shoplens.llm import packing as P

HARD = ["Hello  world\nfoo\tbar   <s> </s> é ﬁ  x ①", "", " ", "\n", " a", "x't don't I'M a's 'S", "a\x00b", None, "aaaa" * 50,
        "((((([[[]]]))]]]}}", "日本語テキスト 12 345 10 00 x0y", "🙂🙂 ok", "É!!ÈOUPA!!× a×b ÷a!÷", "á.b ́x", "ΣΑΣ ΣΑΣ. İI",
        "Å K ſ's 'ſ", "ÀB≠x a\xa0b c\x1cd\x85e", "'re!'ve?.'ll", "<|startoftext|> a <|ENDOFTEXT|> <|", "a<|endoftext|>b"]


@pytest.fixture(scope="module")
def tok():
    return P.tokenizer(C.tokenizer_path(P.VOCABULARY))


def ids_of(tok, texts):
    ids, off = tok.ids(C.texts_of(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]


def test_ids_are_the_librarys(tok, spark):
    want = [tok.library.encode(t or "", add_special_tokens=False).ids for t in HARD]
    assert [ids_of(tok, [t])[0] for t in HARD] == want
    assert ids_of(tok, HARD[:-2]) == want[:-2] and ids_of(tok, HARD) == want
    rng = np.random.default_rng(2)
    chars = list("aZéÉßñ'’.,!?-_0 9\n\t<|>×÷🙂日ǅΣ́\xa0")
    noise = ["".join(rng.choice(chars, 40)) for _ in range(300)]
    assert ids_of(tok, noise) == [tok.library.encode(t, add_special_tokens=False).ids for t in noise]
    texts = [r.text for r in C.table(spark, SF, "documents").where("doc_id < 150").collect()]
    assert ids_of(tok, texts) == [tok.library.encode(t, add_special_tokens=False).ids for t in texts]


def least_bins(sizes, capacity):
    best = len(sizes)
    for assign in itertools.product(range(len(sizes)), repeat=len(sizes)):
        loads = {}
        for s, b in zip(sizes, assign):
            loads[b] = loads.get(b, 0) + s
        if max(loads.values()) <= capacity:
            best = min(best, len(loads))
    return best


def test_bound_and_best_fit_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = rng.integers(1, 13, rng.integers(1, 6))
        least = least_bins(sizes.tolist(), 12)
        bins, places, loads = P.best_fit_decreasing(sizes, 12)
        assert P.lower_bound(sizes, 12) <= least <= len(loads)
        for b in range(len(loads)):
            runs = sorted((places[i], places[i] + sizes[i]) for i in range(len(sizes)) if bins[i] == b)
            assert runs[0][0] == 0 and all(x[1] == y[0] for x, y in zip(runs, runs[1:])) and runs[-1][1] == loads[b] <= 12
    assert P.lower_bound(np.full(10, 7), 12) == 10  # the sum alone would say 6
    assert P.lower_bound(np.zeros(0, int), 12) == 0


def plain_best_fit(sizes, capacity):
    loads = []
    for s in sorted(sizes, reverse=True):
        fits = [k for k, x in enumerate(loads) if x + s <= capacity]
        if fits:
            loads[max(fits, key=lambda k: loads[k])] += s
        else:
            loads.append(s)
    return len(loads)


def test_best_fit_against_a_plain_one():
    rng = np.random.default_rng(1)
    for n in (1, 50, 400):
        sizes = rng.integers(1, 2049, n)
        assert len(P.best_fit_decreasing(sizes, 2048)[2]) == plain_best_fit(sizes.tolist(), 2048)


def checked(packed, capacity):
    by = {}
    for r in packed.collect():
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for runs in by.values():
        runs.sort()
        assert runs[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(runs, runs[1:]))
        assert sum(runs[-1]) <= capacity
    return len(by)


def test_exchange_saves_sequences_and_keeps_every_piece(spark):
    items = spark.range(3000).select("id", (F.pmod(F.xxhash64("id"), F.lit(90)) + 11).alias("length"))
    alone = P.pack(items, 100, group=20, rounds=0)
    after = P.pack(items, 100, group=20, pool=3000, rounds=3)
    assert sorted(r.id for r in after.collect()) == list(range(3000))
    bound = P.lower_bound(np.array([r.length for r in items.collect()]), 100)
    n0, n1 = checked(alone, 100), checked(after, 100)
    assert bound <= n1 < n0


def test_bound_of_a_whole_table(spark):
    rng = np.random.default_rng(2)
    for top in (60, 100):
        sizes = rng.integers(1, top + 1, 500)
        items = spark.createDataFrame([(int(x),) for x in sizes], "length long")
        assert P.table_bound(items, 100) == P.lower_bound(sizes, 100)
    assert P.table_bound(items.where("false"), 100) == 0


def test_least_filled_sequences_of_certified_groups_are_pooled(spark):
    """Every group is certified alone, with a sequence that is half empty."""
    items = spark.range(4000).select(F.lit(30).alias("length"))
    alone = P.pack(items, 100, group=10, rounds=0)
    after = P.pack(items, 100, group=10, pool=500)
    n0, n1 = checked(alone, 100), checked(after, 100)
    found = P.certificate(after, 100)
    assert n0 > 1.1 * n1 and found["sequences"] == n1
    assert found["bound"] <= n1 <= found["bound"] + 1 and after.count() == 4000


def test_edge_cases(spark):
    docs = edge_docs(spark)
    packed = P.pack_documents(docs, capacity=64)
    checked(packed, 64)
    got = {}
    for r in packed.collect():
        got.setdefault((str(r.doc_id), r.piece), []).append((r.start, r.length, r.ids_crc32))
    tok = P.tokenizer(C.tokenizer_path(P.VOCABULARY))
    want = {}
    for r in docs.collect():
        ids = np.array([*tok.library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), 64)):
            want.setdefault((str(r.doc_id), k), []).append((s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes())))
    assert got == want
    assert P.pack_documents(empty_docs(spark)).count() == 0


def test_query(spark):
    packed = P.op6_best_fit_packing(spark, SF).cache()
    n = checked(packed, 2048)
    tokens = packed.agg(F.sum("length")).first()[0]
    assert -(-tokens // 2048) <= n <= 1.005 * tokens / 2048 + 2
    assert packed.select("doc_id").distinct().count() == 1000
    assert packed.where("length < 1 OR length > 2048").count() == 0
