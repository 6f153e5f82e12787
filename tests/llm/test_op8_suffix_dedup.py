import collections
import hashlib

import numpy as np
import pytest
from helpers import SMALL, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import suffix_dedup as S


def brute(texts, length):
    """Removed runs of each text."""
    blobs = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p:p + length] for b in blobs for p in range(len(b) - length + 1))
    out = []
    for b in blobs:
        cover = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cover[p:p + length] = True
        e = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]]))).tolist()
        out.append(list(zip(e[::2], e[1::2])))
    return out


def words(rng, n):
    return bytes(rng.integers(97, 101, n).astype(np.uint8)).decode()


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    p = [words(rng, n) for n in (450, 399, 401, 800)]
    out = [None, "", "ab" * 500, "ab" * 150 + words(rng, 600), "x" * 399, "x" * 400, "x" * 401, p[0],
           words(rng, 300) + p[0] + words(rng, 200), words(rng, 100) + p[1] + words(rng, 10), p[1] + "é" * 300,
           p[2] + words(rng, 500), words(rng, 3) + p[2] + "é", p[3][:500] + words(rng, 50) + p[3][300:], p[3],
           words(rng, 1000), "é" * 450, "zé" * 300 + p[3][100:600]]
    return [*out, out[15], out[15], words(rng, 9000) + p[0] + words(rng, 5000) + "ab" * 300 + words(rng, 4000) + p[3]]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def spans(spark, df, **options):
    found = S.find_repeats(df, **options)
    rows = df.select("doc_id", *S.text_key("text")).join(found, S.KEY, "left").collect()
    return [[tuple(x) for x in r.spans or []] for r in sorted(rows, key=lambda r: r.doc_id)]


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_against_brute_force(spark, texts, batches):
    assert spans(spark, frame(spark, texts), batches=batches) == brute(texts, 400)


def test_other_lengths(spark, texts):
    assert spans(spark, frame(spark, texts), length=100) == brute(texts, 100)
    with pytest.raises(ValueError):
        S.find_repeats(frame(spark, texts), length=40)


def test_short_segments_find_the_same_suffixes(texts, monkeypatch):
    rows = [(i, (t or "").encode()) for i, t in enumerate(texts)]
    whole = S.own_suffixes(rows, 400)
    row, place, near, far = (whole[k] for k in ("row", "place", "near", "far"))
    blocks = S.block_hashes(rows, row, place, near, far, 400)
    windows = S.window_hashes(rows, row, place, near, far, 400)
    monkeypatch.setattr(S, "SEGMENT", 700)

    def rows_of(cols):
        return sorted(zip(*(np.asarray(c).tolist() for c in cols)))
    cut = S.own_suffixes(rows, 400)
    assert rows_of(cut.values()) == rows_of(whole.values())
    assert rows_of(S.block_hashes(rows, row, place, near, far, 400)) == rows_of(blocks)
    assert rows_of(S.window_hashes(rows, row, place, near, far, 400)) == rows_of(windows)


def test_every_window_owns_one_suffix(texts):
    s = S.own_suffixes([(0, texts[-1].encode())], 400)
    owned = sorted(p for a, n, f in zip(s["place"], s["near"], s["far"]) for p in range(a - f, a - n + 1))
    assert owned == list(range(len(texts[-1]) - 400 + 1))


def test_levels_merge_geometrically_and_are_scanned_on_arrival(spark):
    scratch = S.Scratch(spark)
    family = S.IndexFamily(scratch)
    sizes, found = [], []
    for k in range(5):
        records = scratch.table(spark.range(k, k + 3).selectExpr(
            "id AS k1", "id AS k2", "CASE WHEN id = 9 THEN 1L ELSE 0L END AS node", "id AS core", "0L AS extent"), "batch")
        family.add(records)
        sizes.append([n for n, _ in family.levels])
        found.append(sorted(r.core for r in family.found[-1].collect()))
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    assert found == [[], [1, 2], [2, 3], [3, 4], [4, 5]]  # what earlier batches had
    for _, level in family.levels:  # whole records, in the order of their cores
        assert level.columns == ["k1", "k2", "node", "core", "extent"]
        for part in level.rdd.glom().collect():
            assert [r.core for r in part] == sorted(r.core for r in part)
    live = [r.core for r in family.matched().collect()]
    assert sorted(live) == sorted(c for k in range(5) for c in range(k, k + 3) if c in (1, 2, 3, 4, 5))
    scratch.clear()


@pytest.mark.parametrize("batches", [2, 7])
def test_matches_across_batches(spark, batches):
    """Repeats whose texts come in different batches, and in one."""
    rng = np.random.default_rng(11)
    p = [words(rng, 500) for _ in range(6)]
    texts = [words(rng, 200 + 10 * i) + p[i % 6][:450 + i] + words(rng, 150) for i in range(30)]
    assert spans(spark, frame(spark, texts), batches=batches) == brute(texts, 400)


def test_passages_of_over_50_words_go_from_400_bytes_on(spark):
    """Bytes decide, not words: a shorter passage that two documents share stays whole."""
    rng = np.random.default_rng(21)

    def prose(n):
        return " ".join(words(rng, k) for k in rng.integers(3, 9, n))

    passages = [prose(n) for n in range(51, 81)]
    passages = [p for p in passages if not 380 < len(p) < 400]  # what stands beside them may be shared too
    texts = [f"{prose(40)} {p} {prose(40)}" for p in passages for _ in range(2)]
    got = spans(spark, frame(spark, texts))
    assert got == brute(texts, 400)
    for i, (text, runs) in enumerate(zip(texts, got)):
        p = passages[i // 2]
        a = text.index(p)
        assert [s <= a and e >= a + len(p) for s, e in runs] == ([True] if len(p) >= 400 else [])
    assert len({len(p) >= 400 for p in passages}) == 2


def test_removal_cuts_whole_characters_only(spark):
    a, b = "é" * 300, "x" + "é" * 300
    df = frame(spark, [a + "1", b + "2", "short", None, ""]).selectExpr("*", "length(text) AS n_chars", "'k' AS repeats_k1", "1 AS z")
    out = S.remove_repeats(df, count_col="n_chars")
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {0: ("1", 1), 1: ("x2", 2), 2: ("short", 5), 3: (None, None), 4: ("", 0)}


def test_edge_cases(spark):
    docs = edge_docs(spark)
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert S.find_repeats(empty_docs(spark)).count() == 0
    assert S.remove_repeats(empty_docs(spark)).count() == 0


def test_query_against_brute_force(spark):
    rows = sorted(C.table(spark, SMALL, "documents").select("doc_id", "text").collect())
    want = brute([r.text for r in rows], 400)
    got = {r.doc_id: r for r in S.op8_suffix_array_dedup(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r, runs in zip(rows, want):
        b, g = r.text.encode(), got[r.doc_id]
        kept = b"".join(b[x:y] for x, y in zip([0, *[e for _, e in runs]], [*[s for s, _ in runs], len(b)]))
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == (
            len(b), len(b) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
