import itertools

import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, SMALL, edge_docs, empty_docs

from shoplens.llm import _common as C
from shoplens.llm import license_scan as S
from shoplens.llm.decontaminate import Words


def common_subsequence(a, b):
    """Longest, by a table over both lists."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best[0][0]


def test_longest_increasing_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(100):
        pairs = list(enumerate(rng.permutation(rng.integers(1, 8)).tolist()))
        best = max(k for k in range(len(pairs) + 1) for c in itertools.combinations(pairs, k)
                   if all(a[1] < b[1] for a, b in zip(c, c[1:])))
        got = S.longest_increasing(pairs)
        assert len(got) == best and set(got) <= set(pairs) and all(a[1] < b[1] for a, b in zip(got, got[1:]))
    assert S.longest_increasing([]) == []


def test_alignment_is_a_common_subsequence_and_complete_on_equal_lists():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 9, rng.integers(0, 14)).tolist() for _ in range(2))
        got = S.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
        assert len(S.patience(a, a)) == len(a)
        assert common_subsequence(a, b) >= len(got)


def find(texts, least=S.LEAST):
    t = C.texts_of(pa.array(texts, pa.string()))
    return S.Templates(S.TEMPLATES, least).find(Words(t))


FILLER = "the quick brown fox of the license under a version and so on " * 30


def test_planted_notices_are_found_and_clean_texts_left_alone():
    for name, some in S.TEMPLATES.items():
        for template in some:
            words = template.split()
            for text in (template, FILLER + template.upper() + " " + FILLER, template + "\n" + template,
                         " ".join(w + (" noise" if i % 5 == 2 else "") for i, w in enumerate(words))):
                assert name in {x["license"] for x in find([text])[0]}, (name, text[:80])
    assert find([FILLER, "", None, "Version 2.0 of the Apache server was released under pressure."]) == [[], [], [], []]


def test_repeated_notices_are_found_each():
    text = " some words between them ".join(["Released under the MIT License."] * 4)
    assert [x["license"] for x in find([text])[0]].count("MIT") == 4


def test_stretches_hold_every_notice_that_a_full_scan_finds():
    rng = np.random.default_rng(3)
    known = S.Templates(S.TEMPLATES, S.LEAST)
    for _ in range(120):
        k = int(rng.integers(len(known.names)))
        t = Words(C.texts_of(pa.array([S.TEMPLATES[known.names[k]][0]]))).hash.tolist()
        words = [w for w in t if rng.random() > 0.1]
        text = rng.integers(0, 50, 30).tolist() + words + rng.integers(0, 50, 30).tolist()
        whole = len(S.patience(text, t)) / len(t)
        keys = known.keys[[i for i, w in enumerate(known.words) if w == t][0]]
        if whole >= S.LEAST:  # then a key word is in the text
            assert set(text) & set(keys)


def test_edge_cases(spark):
    docs = edge_docs(spark)
    got = S.scan_licenses(docs, name="s")
    assert got.columns == [*docs.columns, "s"] and got.count() == docs.count()
    assert all(r.s.notices == [] for r in got.collect())
    assert S.scan_licenses(empty_docs(spark)).count() == 0
    one = spark.createDataFrame([(1, "é Released under the\nMIT License. x")], "doc_id long, text string")
    x = S.scan_licenses(one, name="s").first().s.notices[0]
    assert (x.license, x.coverage, x["first"], x["last"], x.from_byte, x.to_byte) == ("MIT", 1.0, 1, 6, 3, 33)


def test_query(spark):
    texts = {r.doc_id: r.text for r in C.table(spark, SMALL, "documents").collect()}
    got = {r.doc_id: r for r in S.op10_license_scan(spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        said = {name for name, line in (("MIT", "Released under the MIT License."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
                                        ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
                                        ("GPL-3.0", "licensed under the GNU General Public License, version 3.")) if line in t}
        assert said <= set(got[i].licenses.split(",")) and (got[i].n_notices > 0) == bool(said)


def names(text):
    return [x["license"] for x in find([text])[0]]


def test_neighbours_of_a_license_are_not_reported_with_it():
    for name, some in S.TEMPLATES.items():
        for template in some:
            for text in (template, FILLER + template + " " + FILLER):
                found = find([text])[0]
                assert [(x["license"], x["coverage"]) for x in found] == [(name, 1.0)], (name, template, found)
    assert names("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.") == ["CC-BY-NC-4.0", "CC-BY-4.0"]


def test_strange_words_count():
    assert names("It was released under the terms of a license.") == []
    assert names("Released under the Foo License.") == []
    x = find(["Released under the well known MIT License."])
    assert x == [[]]
    x = find(["This work is today licensed under the GNU General Public License, version 3."])[0]
    assert [(y["license"], y["coverage"]) for y in x] == [("GPL-3.0", 12 / 13)]


def test_words_of_a_notice_before_and_after_it_do_not_hide_it():
    for name, some in S.TEMPLATES.items():
        for template in some:
            words = template.split()
            part = " ".join(words[:len(words) // 2])
            rest = " ".join(words[len(words) // 2:])
            found = find([f"{part} and more. {template} And then {rest}"])[0]
            assert (name, 1.0) in {(x["license"], x["coverage"]) for x in found}, (name, template, found)


def test_densest_run_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        at = np.sort(rng.choice(30, int(rng.integers(1, 9)), replace=False)).tolist()
        pairs = [(int(i), k) for k, i in enumerate(at)]

        def value(run):
            return len(run) - 0.8 * (run[-1][0] - run[0][0] + 1 - len(run))
        best = max(value(pairs[x:y]) for x, y in itertools.combinations(range(len(pairs) + 1), 2))
        assert abs(value(S.densest(pairs, 0.8)) - best) < 1e-9
    assert S.densest([], 0.8) == []


def damaged(rng, template):
    """A notice with a few words lost, changed and added."""
    out = []
    for w in template.split():
        x = rng.random()
        out += [] if x < 0.03 else [f"odd{int(rng.integers(99))}"] if x < 0.06 else [w, "extra"] if x < 0.09 else [w]
    return " ".join(out)


def test_alignment_of_damaged_notices_against_the_longest_common_subsequence():
    """Nearly all that the longest common subsequence covers is found."""
    rng = np.random.default_rng(6)
    long = [(n, t) for n, some in S.TEMPLATES.items() for t in some if len(t.split()) > 15]
    good = found = 0
    for k in range(150):
        name, template = long[k % len(long)]
        text = damaged(rng, template)
        a, b = (Words(C.texts_of(pa.array([x]))).hash.tolist() for x in (text, template))
        m = common_subsequence(a, b)
        if m / (len(a) + len(b) - m) >= 0.85:
            good += 1
            found += name in names(f"{FILLER[:90]} {text} {FILLER[:90]}")
    assert good > 60 and found >= 0.95 * good


def test_anchors_decide(monkeypatch):
    """Without anchors damaged notices are not found."""
    rng = np.random.default_rng(7)
    texts = [damaged(rng, t) for some in S.TEMPLATES.values() for t in some if len(t.split()) > 15]
    with_anchors = sum(map(len, find(texts)))
    monkeypatch.setattr(S, "longest_increasing", lambda pairs: [])
    assert sum(map(len, find(texts))) < 0.5 * with_anchors


def test_templates_from_a_table(spark):
    rows = [("Foo-1.0", "You may use this foo in any way that the authors of foo would like."), ("Foo-1.0", ""), (None, "x"), ("None", None),
            ("Bar", " ".join(f"clause{i} of the bar license says that" for i in range(400)))]
    table = spark.createDataFrame(rows, "license string, text string")
    docs = spark.createDataFrame([(1, f"a b {rows[0][1]} c"), (2, rows[4][1].replace("clause7 ", "paragraph7 ")), (3, "Released under the MIT License.")],
                                 "doc_id long, text string")
    got = {r.doc_id: [x.license for x in r.s.notices] for r in S.scan_licenses(docs, templates=table, name="s").collect()}
    assert got == {1: ["Foo-1.0"], 2: ["Bar"], 3: []}
    assert S.scan_licenses(docs, templates=table.where("false"), name="s").where("size(s.notices) > 0").count() == 0
    with pytest.raises(ValueError):
        S.templates_of(spark.range(1).selectExpr("'x' AS license", f"repeat('word ', {S.MOST_BYTES // 4}) AS text"))


def test_query_names_the_licenses_and_no_others(spark):
    lines = {"MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
             "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "licensed under the GNU General Public License, version 3."}
    texts = {r.doc_id: r.text for r in C.table(spark, SF, "documents").collect()}
    seen = set()
    for r in S.op10_license_scan(spark, SF).collect():
        said = sorted(name for name, line in lines.items() if line in (texts[r.doc_id] or ""))
        seen.update(said)
        assert r.licenses == ",".join(said) and r.best_license == (said[0] if said else None)
        assert r.n_notices == sum((texts[r.doc_id] or "").count(line) for line in lines.values())
    assert seen == set(lines)


def test_licenses_with_nearly_the_same_words_are_told_apart():
    for kind, name in (("Lesser ", "LGPL-3.0"), ("Affero ", "AGPL-3.0"), ("", "GPL-3.0")):
        assert names(f"This work is licensed under the GNU {kind}General Public License, version 3.") == [name]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    assert names("Licensed under CC BY-ND 4.0.") == ["CC-BY-ND-4.0"]
