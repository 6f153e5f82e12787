"""The incremental matrix: parts by day, loads that touch changed days only."""

import datetime as dt

import pytest

from shoplens.config import Thresholds
from shoplens.operators import features
from shoplens.plans import registry
from shoplens.sinks import rollup, snapshot

DDL = ("purchase_id STRING, customer_id STRING, store_id STRING, purchase_datetime TIMESTAMP, total_amount DOUBLE, "
       "payment_method STRING, is_delivery INT")
CUSTOMERS = "customer_id STRING, registration_dt TIMESTAMP, is_loyalty_member INT"


def row(i, day, hour=12, customer="a", store="s", amount=10.0, method="cash", delivery=0):
    ts = None if day is None else dt.datetime.fromisoformat(f"{day}T{hour:02d}:00:00")
    return (None if i is None else f"p{i}", customer, store, ts, amount, method, delivery)


def purchases(spark, rows):
    return spark.createDataFrame(rows, DDL)


def same(table, spark, rows, as_of):
    """The rollup's matrix against the plain one over ``rows``."""
    customers = spark.createDataFrame([(c, dt.datetime(2024, 1, 5), n) for n, c in enumerate("abcz")], CUSTOMERS)
    plain = features.customer_feature_matrix(customers, purchases(spark, rows), as_of=as_of)
    got = features.customer_aggregates(features.enrich_purchases(features.conform_purchases(purchases(spark, rows)), as_of))
    key = lambda r: (r[0] is not None, r[0])
    assert sorted(map(tuple, table.aggregates(as_of).collect()), key=key) == sorted(map(tuple, got.collect()), key=key)
    assert sorted(map(tuple, table.matrix(customers, as_of).collect())) == sorted(map(tuple, plain.collect()))


HISTORY = [row(i, f"2024-{m:02d}-{d:02d}", hour=(5 * i) % 24, customer="abc"[i % 3], store=None if i % 11 == 0 else f"s{i % 4}",
               amount=None if i % 13 == 0 else 7.25 * i, method=("cash", "card", "CARD")[i % 3], delivery=i % 2)
           for i, (m, d) in enumerate([(m, d) for m in (1, 2, 3, 4) for d in (1, 9, 14, 28)] * 3)]


def test_two_loads_equal_the_plain_matrix(spark, tmp_dir):
    t = rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, HISTORY[:30])).commit()
    for as_of in ("2024-03-15 10:00:00", "2024-05-01 00:00:00"):
        same(t, spark, HISTORY[:30], as_of)
    t = rollup.open_rollup(spark, tmp_dir).loaded(purchases(spark, HISTORY[30:])).commit()
    for as_of in ("2024-01-20 00:00:00", "2024-04-29 23:59:59", "2025-01-01 00:00:00"):
        same(t, spark, HISTORY, as_of)


def test_resent_purchases_leave_their_old_day(spark, tmp_dir):
    t = rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, HISTORY)).commit()
    moved = row(3, "2024-04-30", amount=1.0, customer="c")
    stale = row(47, "2023-12-01", amount=99.0)  # older than what is stored: dropped
    again = HISTORY[20]
    t = t.loaded(purchases(spark, [moved, stale, again])).commit()
    assert "2023-12-01" not in t.versions["detail"]
    same(t, spark, [moved if r[0] == "p3" else r for r in HISTORY], "2024-05-01 00:00:00")


def test_a_load_reads_and_writes_changed_days_only(spark, tmp_dir, monkeypatch):
    t = rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, HISTORY)).commit()
    before, read = t.versions, []
    real = rollup.Rollup._read

    def noted(self, table, names, ddl):
        df = real(self, table, names, ddl)
        read.extend(df.inputFiles())
        return df

    monkeypatch.setattr(rollup.Rollup, "_read", noted)
    t = t.loaded(purchases(spark, [row(900, "2024-04-28"), row(5, "2024-04-29")])).commit()
    old = str(HISTORY[5][3].date())  # purchase 5 was here
    changed = {"2024-04-28", "2024-04-29", old}
    assert {x for x, v in t.versions["detail"].items() if before["detail"].get(x) != v} <= changed
    assert {x for x, v in t.versions["months"].items() if before["months"].get(x) != v} == {x[:7] for x in changed}
    detail = {f.split("/p=")[1].split("/")[0] for f in read if "/detail/" in f}
    assert detail == changed
    assert {f.split("/p=")[1][:7] for f in read if "/days/" in f} == {x[:7] for x in changed}


def test_a_matrix_reads_days_only_where_a_window_reaches(spark, tmp_dir, monkeypatch):
    t = rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, HISTORY)).commit()
    files = t.aggregates("2024-04-20 00:00:00").inputFiles()
    assert {f.split("/p=")[1][:7] for f in files if "/days/" in f} == {"2024-03", "2024-04"}
    assert {f.split("/p=")[1][:7] for f in files if "/months/" in f} == {"2024-01", "2024-02"}
    assert not any("/detail/" in f for f in files)


def test_no_id_no_time_and_repeated_loads(spark, tmp_dir):
    rows = [row(None, "2024-01-03"), row(None, "2024-01-03"), row(1, None, customer="b"), row(2, "2024-01-04"), row(2, "2024-01-05")]
    t = rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, rows), tag="1").commit()
    want = [r for r in rows if r != rows[3]]
    same(t, spark, want, "2024-01-31 00:00:00")
    t = rollup.open_rollup(spark, tmp_dir)
    assert t.loaded(purchases(spark, rows), tag="1") is t  # done already
    t = t.loaded(purchases(spark, [row(1, "2024-01-06", customer="b")]), tag="2").commit()
    assert rollup.UNKNOWN not in t.versions["detail"]
    same(t, spark, [row(1, "2024-01-06", customer="b") if r[0] == "p1" else r for r in want], "2024-01-31 00:00:00")
    same(t.loaded(purchases(spark, [])), spark, [row(1, "2024-01-06", customer="b") if r[0] == "p1" else r for r in want], "2024-02-01 00:00:00")


def test_nothing_loaded(spark, tmp_dir):
    t = rollup.open_rollup(spark, tmp_dir, buckets=4)
    same(t, spark, [], "2024-01-31 00:00:00")
    same(t.loaded(purchases(spark, [])).commit(), spark, [], "2024-01-31 00:00:00")


def test_a_stopped_load_changes_nothing_and_can_be_repeated(spark, tmp_dir, monkeypatch):
    rollup.open_rollup(spark, tmp_dir, buckets=4).loaded(purchases(spark, HISTORY[:40]), "1").commit()
    real = rollup.Rollup._written
    for stop in ("detail", "days", "months"):
        def broken(self, table, *a, stop=stop):
            if table == stop:
                raise OSError(stop)
            return real(self, table, *a)

        monkeypatch.setattr(rollup.Rollup, "_written", broken)
        with pytest.raises(OSError):
            rollup.open_rollup(spark, tmp_dir).loaded(purchases(spark, HISTORY[40:]), "2")
        same(rollup.open_rollup(spark, tmp_dir), spark, HISTORY[:40], "2024-05-01 00:00:00")
    monkeypatch.setattr(rollup.Rollup, "_written", real)
    rollup.open_rollup(spark, tmp_dir).loaded(purchases(spark, HISTORY[40:]), "2")  # written, not committed
    t = rollup.open_rollup(spark, tmp_dir).loaded(purchases(spark, HISTORY[40:]), "2").commit()
    same(t, spark, HISTORY, "2024-05-01 00:00:00")
    assert set(snapshot.names(spark, f"{tmp_dir}/days")) >= set(t.versions["days"].values())


def test_thresholds_reach_the_rollup(spark, tmp_dir):
    th = Thresholds(night_start=12)
    t = rollup.open_rollup(spark, tmp_dir, th, buckets=4).loaded(purchases(spark, [row(1, "2024-01-30", 13)]))
    customers = spark.createDataFrame([("a", None, 1)], CUSTOMERS)
    assert t.matrix(customers, "2024-01-31 00:00:00").first().night_shopper == 1


def test_registered_loads_differ_from_the_final_table(spark):
    first, second = registry.incremental_loads(spark, "/root/testdata/sf0.001")
    assert first.select("purchase_id").intersect(second.select("purchase_id")).count() > 20
