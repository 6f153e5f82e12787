import re

import duckdb
from helpers import SF, LONG, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import decontaminate as D


def words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)


def brute(doc, items):
    w = words(doc)
    hit, ids = set(), set()
    for i, text in items:
        b = words(text)
        size = min(len(b), 13)
        wins = {tuple(b[k:k + size]) for k in range(len(b) - size + 1)} if b else set()
        for k in range(len(w) - size + 1 if wins else 0):
            if tuple(w[k:k + size]) in wins:
                hit.update(range(k, k + size))
                ids.add(i)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None), 20 * len(hit) >= len(w) and bool(hit)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"),
         (3, None), (4, "!!! ..."), (None, "A b c"), (10, "short-ITEM"), (5, "été à la"), (6, " ".join(LONG.split()[500:540]))]
TEXTS = ["x one TWO three four five six, seven eight nine ten eleven; twelve thirteen fourteen y",
         "two three four five six seven eight nine ten eleven twelve thirteen", "a short item here short, item", "short\nitem"]


def docs(spark):
    extra = spark.createDataFrame([(100 + i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return edge_docs(spark).unionByName(extra, allowMissingColumns=True)


def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS n_words", "2 AS id")


def found(df):
    return sorted((str(r.doc_id), r.c.n_words, r.c.n_hit, list(r.c["items"]), r.c.contaminated) for r in df.collect())


def test_against_brute_force_in_one_block_and_many(spark):
    d = docs(spark)
    want = sorted((str(r.doc_id), *brute(r.text, ITEMS)) for r in d.collect())
    one = D.find_windows(d, bench(spark), name="c")
    assert one.columns == [*d.columns, "c"] and found(one) == want
    many = D.find_windows(d, bench(spark), block_bytes=40, name="c")
    assert found(many) == want


def test_a_third_of_the_benchmark_is_copies_of_one_item(spark):
    """Copies are one item, whatever the block size; blocks stay small."""
    d = docs(spark)
    want = sorted((str(r.doc_id), *brute(r.text, ITEMS)) for r in d.collect())
    copies = bench(spark)
    for _ in range(6):
        copies = copies.unionByName(copies.limit(2))
    some = copies.selectExpr("CAST(item_id AS STRING) AS id", "text AS t").distinct()
    blocks = D._blocks(some, 60)
    sizes = some.selectExpr(f"pmod(xxhash64(id, t), {blocks}) AS k", "octet_length(t) AS n").groupBy("k").agg({"n": "sum", "*": "count"}).collect()
    assert blocks > 1 and all(r["sum(n)"] is None or r["sum(n)"] <= 120 or r["count(1)"] == 1 for r in sizes)
    for size in (60, 1 << 20):
        assert found(D.find_windows(d, copies, block_bytes=size, name="c")) == want


def test_clashing_names_with_many_blocks(spark):
    d = docs(spark).selectExpr("*", "2 AS text_k1", "3 AS c_others")
    out = D.find_windows(d, bench(spark), block_bytes=150, name="c")
    assert out.columns == [*d.columns, "c"] and out.count() == d.count()


def test_removal(spark):
    d = docs(spark)
    kept = D.remove_documents(d, bench(spark))
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in d.collect() if not brute(r.text, ITEMS)[3])
    cut = {r.doc_id: r.text for r in D.remove_spans(d, bench(spark)).collect()}
    assert cut[100] == "x  y" and cut[102] == "a  here " and cut[101] == TEXTS[1] and cut[1] is None


def test_empty(spark):
    assert D.find_windows(empty_docs(spark), bench(spark), name="c").count() == 0
    none = D.find_windows(docs(spark), bench(spark).where("false"), name="c")
    assert none.where("c.contaminated OR c.n_hit > 0").count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.execute(D.ORACLE)
    cols = [c[0] for c in rel.description]
    got = D.op4_benchmark_decontamination(spark, SF).select(*cols)
    want = sorted(rel.fetchall())
    assert sorted(map(tuple, got.collect())) == want and sum(r[-1] for r in want) > 0
    assert C.table(spark, SF, "documents").count() == len(want)
