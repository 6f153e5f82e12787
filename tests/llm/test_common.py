import numpy as np
import pyarrow as pa
from helpers import EDGE_ROWS, edge_docs, empty_docs

from shoplens.llm import _common as C


def test_equal_ranges_have_equal_hashes():
    data = np.frombuffer(b"abcabcabx" * 50, np.uint8)
    h = C.RangeHash(data)
    s = np.arange(0, 400)
    for n in (1, 3, 9, 40):
        got = h(s, s + n)
        by = {}
        for i, v in zip(s.tolist(), got.tolist()):
            assert by.setdefault(data[i:i + n].tobytes(), v) == v
        assert len(set(by.values())) == len(by)


def test_slices_cover_all_rows_and_long_rows_are_alone():
    t = C.texts_of(pa.array(["a" * 5, None, "b" * 50, "", "c" * 3]))
    got = list(C.slices(t, 10))
    assert [s.first for s in got] == [0, 2, 3]
    assert b"".join(s.row(i) for s in got for i in range(len(s))) == b"a" * 5 + b"b" * 50 + b"c" * 3
    assert list(C.slices(C.texts_of(pa.array([], pa.string())))) == []


def test_ragged():
    assert C.ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert C.ragged(np.array([], int), np.array([], int)).tolist() == []


def test_annotate_keeps_rows_and_columns(spark):
    docs = edge_docs(spark)
    name = C.fresh_name(docs, "score")
    got = C.annotate(docs, "text", "n long", lambda: lambda t, _: [np.diff(t.off)], name)
    assert got.columns == [*docs.columns, name]
    assert sorted(r[name].n for r in got.collect()) == sorted(len((t or "").encode()) for _, t, _ in EDGE_ROWS)
    assert C.annotate(empty_docs(spark), "text", "n long", lambda: lambda t, _: [np.diff(t.off)], "m").count() == 0


def test_segments_dictionary():
    t = C.texts_of(pa.array(["aab", "", "ab"]))
    starts = C.starts_of(t, np.array([False, True, False, False]))
    codes, words = C.distinct(t.data, starts)
    assert [words[c] for c in codes] == [b"aa", b"b", b"ab"]
