import itertools
import re

import numpy as np
import pytest
import xxhash
from helpers import SF, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import simhash as S
from shoplens.llm.components import connected_components


def fingerprint(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(prints):
    """Smallest print reachable, by brute force."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_fingerprints(spark):
    docs = edge_docs(spark)
    got = S.with_fingerprint(docs, name="f")
    assert got.columns == [*docs.columns, "f"]
    for r in got.select("text", S.as_hex(got.f.fingerprint).alias("h")).collect():
        assert r.h == f"{fingerprint(r.text):016x}"


def test_anchors_cover_one_differing_bit():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 300, dtype=np.int64).astype(np.uint64)
    keys, whose, home = S.anchors(x)
    for k in range(2):
        assert (np.bincount(np.searchsorted(np.sort(x), whose[(keys >> 31) == k])) <= 16).all()
    at = {}
    for key, f, h in zip(keys.tolist(), whose.tolist(), home.tolist()):
        at.setdefault(f, (set(), set()))[1 if h else 0].add(key)
    for f in x.tolist():
        copies = at[f][0] | at[f][1]
        assert len(at[f][1]) == 2  # one home in each half
        for n in (1, 2, 3):
            g = f
            for bit in rng.choice(64, n, replace=False).tolist():
                g ^= 1 << bit
            gk, _, gh = S.anchors(np.array([g], np.uint64))
            assert copies & set(gk[gh].tolist())  # f has a copy at a home of g


def planted(n=400):
    """Fingerprints in chains and dense groups, and far ones."""
    rng = np.random.default_rng(7)
    out = [0]
    for _ in range(12):
        f = int(rng.integers(0, 1 << 63))
        out.append(f)
        for _ in range(30):
            for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False).tolist():
                f ^= 1 << bit
            out.append(f)
    dense = int(rng.integers(0, 1 << 63))
    out += [dense ^ sum(1 << b for b in rng.choice(14, 3, replace=False).tolist()) for _ in range(n)]
    return out


@pytest.mark.parametrize("most", [20_000, 30])
def test_components_of_planted_fingerprints(spark, most):
    """Also where anchors are too full for one task and are split into cells."""
    prints = planted()
    want = components(prints)
    df = spark.createDataFrame([(np.uint64(p).view(np.int64).item(),) for p in sorted(set(prints))], "fingerprint long")
    links = S.find_links(df, 3, most)
    for r in links.collect():
        assert ((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 3
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups, expected = {}, {}
    for p, w in want.items():
        signed = np.uint64(p).view(np.int64).item()
        groups.setdefault(roots.get(signed, signed), set()).add(p)
        expected.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_connected_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}
    assert connected_components(df.where("false")).count() == 0


def test_edge_cases(spark):
    docs = edge_docs(spark)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()]
    assert len(got) == docs.count()
    assert {c for d, f, c in got if f == "0" * 16} == {1}  # null, empty and blank texts
    assert {c for d, _, c in got if d == 4} == {4}
    assert [c for d, _, c in got if d is None] == [None]
    assert S.near_duplicates(empty_docs(spark)).count() == 0
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "4", "5", "6", "7", "8", "None"])
    assert S.keep_one(empty_docs(spark)).count() == 0


def test_query_against_brute_force(spark):
    rows = C.table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in S.op5_simhash_near_dedup(spark, SF).collect()}
    assert got.keys() == {r.doc_id for r in rows}
    for r in rows[::40]:
        assert got[r.doc_id].fingerprint == f"{fingerprint(r.text):016x}"
    by = components([int(x.fingerprint, 16) for x in got.values()])
    least = {}
    for i, x in got.items():
        root = by[int(x.fingerprint, 16)]
        least[root] = min(least.get(root, i), i)
    assert all(x.component_id == least[by[int(x.fingerprint, 16)]] for x in got.values())
    one = S.keep_one(C.table(spark, SF, "documents"))
    assert sorted(r.doc_id for r in one.collect()) == sorted(least.values())
