import os
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import jaccard_join as J


def shingles(text, size=3):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {" ".join(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {" ".join(w)} if w else set()


def brute(rows, percent=90):
    """doc_id -> (n_shingles, component_id), all pairs compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    at = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    for k, (_, s) in enumerate(sets):
        both = {}
        for x in s:
            for j in at[x]:
                if j < k:
                    both[j] = both.get(j, 0) + 1
        for j, o in both.items():
            if 100 * o >= percent * (len(s) + len(sets[j][1]) - o):
                root[find(k)] = find(j)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            r = find(k)
            least[r] = min(least.get(r, i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, (i, s) in enumerate(sets)), key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similarity_join(df, **kw).collect()), key=str)


def family(rng, n, words=60):
    """Chains and crowds of edited texts, and unrelated ones with a common line."""
    line = " ".join(f"common{i}" for i in range(12))
    out = []
    for f in range(6):
        base = [f"w{f}x{int(x)}" for x in rng.integers(0, 5000, words)]
        for _ in range(n):
            out.append(" ".join(base))
            if f % 2:
                base = list(base)  # a chain: each differs from the one before
            copy = list(base)
            copy[int(rng.integers(0, words))] = f"new{int(rng.integers(0, 10**6))}"
            if f % 2:
                base = copy
            else:
                out.append(" ".join(copy))
    for _ in range(40):
        out.append(line + " " + " ".join(f"u{int(x)}" for x in rng.integers(0, 10**6, int(rng.integers(1, 30)))))
    return [(int(i), t) for i, t in zip(rng.permutation(len(out)), out)]


def test_equals_brute_force_on_the_small_table(spark):
    docs = C.table(spark, SMALL, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert run(docs) == want
    assert sum(c != i for i, _, c in want) > 5


@pytest.mark.parametrize("percent,most", [(90, 512), (80, 4), (70, 3)])
def test_families_in_groups_of_any_size(spark, monkeypatch, percent, most):
    monkeypatch.setattr(J, "MOST", most)
    rows = family(np.random.default_rng(percent), 25)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, percent=percent) == brute(rows, percent)


@pytest.mark.parametrize("percent", [90, 75])
def test_linked_sets_are_equal_in_a_part(percent):
    """Whatever their sizes, also with parts that have no shingles."""
    rng = np.random.default_rng(percent)
    met = unlike = 0
    for _ in range(600):
        n = int(rng.choice([3, 7, 9, 10, 11, 14, 25, 60, 300, 900]))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        cut = int(rng.integers(0, max(1, (100 - percent) * n // 100) + 1))
        more = int(rng.integers(0, max(1, (100 - percent) * n // 100) + 1))
        b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 62, more).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        keys = np.intersect1d(J.part_keys(a, percent), J.part_keys(b, percent))
        if len(a) and 100 * both >= percent * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
            assert len(keys)
            met += 1
        c = np.unique(np.concatenate([a[:len(a) // 3], rng.integers(0, 1 << 62, n).astype(np.uint64)]))
        if n > 50:
            unlike += len(np.intersect1d(J.part_keys(a, percent), J.part_keys(c, percent))) > 0
    assert met > 150 and (unlike < 15 or percent < 90)  # a part holds fewer shingles at a lower share


def test_linked_sets_share_a_first_shingle():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    order = J.Order(tokens[:100], rng.integers(4, 50, 100))
    for _ in range(300):
        a = np.unique(rng.choice(tokens, int(rng.integers(5, 200)), replace=False))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.85, 1))), replace=False), rng.choice(tokens, int(rng.integers(0, 6)))]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            (x, _), (y, k) = sorted((J.first_ones(order, s, 90) for s in (a, b)), key=lambda f: len(f[0]), reverse=True) if len(a) == len(b) else (
                (J.first_ones(order, a, 90), J.first_ones(order, b, 90)) if len(a) > len(b) else (J.first_ones(order, b, 90), J.first_ones(order, a, 90)))
            assert len(np.intersect1d(x, y[:k]))


def test_hot_parts_are_divided(spark, monkeypatch):
    """A common line fills short documents; few of them link."""
    monkeypatch.setattr(J, "HOT", 5)
    rng = np.random.default_rng(6)
    line = " ".join(f"common{i}" for i in range(30))
    rows = [(i, line + f" a{int(rng.integers(0, 60))} b{int(rng.integers(0, 3))}") for i in range(200)]
    rows += [(1000 + i, f"x{int(rng.integers(0, 9))} " + line) for i in range(60)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_a_set_in_many_hot_parts_is_divided_once(spark, monkeypatch):
    """The rows that meet grow with the sets, not with their hot parts."""
    monkeypatch.setattr(J, "HOT", 5)
    line = " ".join(f"common{i}" for i in range(60))
    rows = [(i, line + f" a{i % 90} b{i % 3}") for i in range(180)] + [(500 + i, f"x{i} y{i} z{i}") for i in range(20)]
    made, met_groups = [], J.met_groups

    def counted(entries, *args):
        made.append((entries.count(), entries.select("key", "handle").distinct().count()))
        return met_groups(entries, *args)
    monkeypatch.setattr(J, "met_groups", counted)
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)
    (n, distinct), = made
    first = 60 - J.needed(60, 90) + 1
    assert 90 * first <= n <= 90 * (first + J.HOT)
    assert distinct == n


def test_links_are_stars_around_the_least_member(spark):
    """A chain within a group comes out as one star, which is joined in a round."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:40 + i]) for i in range(12)]
    sets = [s for s in J.sets_of(C.texts_of(pa.array(texts)), 3)]
    rows = sorted((J.key_of(s), t) for s, t in zip(sets, texts))[::-1]
    batch = pa.RecordBatch.from_pydict({"gid": [1] * 12, "cell": [0] * 12, "within": [True] * 12, "sid": [k for k, _ in rows],
                                        "asks": [False] * 12, "text": [t for _, t in rows]})
    got = [(r["a"], r["b"]) for b in J._open_sorted([batch], 3, 90) for r in b.to_pylist()]
    assert sorted(got) == [(k, rows[-1][0]) for k, _ in sorted(rows)[1:]]


def test_only_the_result_stays_in_the_shared_folder(spark, monkeypatch):
    written, table = [], C.Scratch.table

    def noted(self, df, name):
        out = table(self, df, name)
        written.append((name, self.paths[id(out)][0]))
        return out
    monkeypatch.setattr(C.Scratch, "table", noted)
    run(spark.createDataFrame(family(np.random.default_rng(3), 5), "doc_id long, text string"))
    assert [name for name, path in written if os.path.exists(path.removeprefix("file:"))] == ["components"]


def test_shared_parts_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = np.random.default_rng(1)
        rows = [(int(h), [int(k) for k in rng.integers(0, 40, 5)]) for h in rng.integers(0, 60, 150)] + [(h, [77]) for h in range(100)]
        got = J.shared_parts(spark.createDataFrame(rows, "handle long, parts array<long>")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    have = {}
    for h, keys in rows:
        for k in keys:
            have.setdefault(k, set()).add(h)
    assert sorted(map(tuple, got)) == sorted((k, h) for k, hs in have.items() if len(hs) > 1 for h in hs)


def test_group_bound_and_components():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 62, 100).astype(np.uint64))
    sets = [base, base[:-2], base[3:], np.unique(rng.integers(0, 1 << 62, 50).astype(np.uint64))]
    g = J.Group(sets, 90)
    assert g.linked(base).tolist() == [0, 1, 2]
    assert g.linked(sets[3]).tolist() == [3]
    assert len(g.linked(np.concatenate([base[:50], sets[3][:10]]))) == 0
    label, links = g.components()
    assert label.tolist() == [0, 0, 0, 3] and len(links) == 2


def test_closed_groups_are_not_counted(monkeypatch):
    """The union bound alone keeps a group shut."""
    g = J.Group([np.arange(10, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)], 90)
    monkeypatch.setattr(np, "bincount", lambda *a, **k: pytest.fail("opened"))
    assert len(g.linked(np.arange(2, 13, dtype=np.uint64))) == 0


def test_edge_cases(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(docs) == brute(rows)
    assert J.similarity_join(empty_docs(spark)).collect() == []
    rows = [(3, "a b"), (1, "A  B"), (2, "a b c"), (None, "a b"), (None, ""), (5, None), (5, "\t")]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted([(3, 1, 1), (1, 1, 1), (2, 1, 2), (None, 1, 1), (None, 0, None), (5, 0, 5), (5, 0, 5)], key=str)


def test_a_third_of_the_rows_are_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "MOST", 16)
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        w = list(base)
        w[int(rng.integers(0, 80))] = f"e{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"r{int(x)}" for x in rng.integers(0, 10**6, 40))) for i in range(300)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
