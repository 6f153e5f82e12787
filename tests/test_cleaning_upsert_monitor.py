"""Cleaning (C1-C8), keyed load (U1-U5) and monitoring (M1-M3)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.operators import cleaning, monitor, upsert
from shoplens.operators.dedup import keep_max
from shop_fixtures import views as fixtures

AS_OF = fixtures.FIXTURE_AS_OF


def test_rejects_plus_accepted_equal_input(spark):
    raw = fixtures.raw_purchases(spark, SF_SMALL)
    mart, rej = cleaning.clean(raw, AS_OF)
    acc = cleaning.accepted(raw, AS_OF)
    assert acc.count() + rej.count() == raw.count()
    assert mart.count() == acc.select("purchase_id").distinct().count()
    assert {r[0] for r in rej.select("reject_reason").distinct().collect()} <= set(cleaning.REJECT_ORDER)
    assert {r[0] for r in mart.select("payment_method").distinct().collect()} == {"cash", "card"}


def test_reason_order_first_failing_check(spark):
    df = spark.createDataFrame(
        [(None, "c", "s", "not-a-date", None, " ", True),      # null wins over blank/bad_date
         ("p2", "c", "s", "not-a-date", 1.0, " ", True),       # blank wins over bad_date
         ("p3", "c", "s", "not-a-date", 1.0, "cash", True),
         ("p4", "c", "s", "2034-01-01T00:00:00Z", 1.0, "cash", True),
         ("p5", "c", "s", "2024-01-30T23:59:59Z", 1.0, " CASH", None)],
        "purchase_id string, customer_id string, store_id string, purchase_datetime string, "
        "total_amount double, payment_method string, is_delivery boolean")
    got = {r["purchase_id"]: r["reject_reason"] for r in cleaning.with_reasons(df, AS_OF).collect()}
    assert got == {None: "null", "p2": "blank", "p3": "bad_date", "p4": "future", "p5": None}
    ok = cleaning.accepted(df, AS_OF).collect()
    assert [(r.purchase_id, r.payment_method, r.is_delivery) for r in ok] == [("p5", "cash", 0)]


def test_dedup_latest_is_idempotent_and_deterministic(spark):
    df = spark.createDataFrame(
        [("k1", 1, "a"), ("k1", 3, "b"), ("k1", 3, "c"), ("k2", None, "z"), ("k2", 0, "y"), (None, 5, "n")],
        "k string, t int, v string")
    once = keep_max(df, ["k"], ["t"])
    twice = keep_max(once, ["k"], ["t"])
    got = sorted((r.k or "", r.t, r.v) for r in once.collect())
    assert got == [("", 5, "n"), ("k1", 3, "c"), ("k2", 0, "y")]
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def _base_updates(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "id int, name string, bal double")
    upd = spark.createDataFrame([(2, "b", 2.0, 1), (3, "c", 9.0, 1), (3, "c", 7.0, 2), (4, "d", 4.0, 1)],
                                "id int, name string, bal double, seq int")
    return base, upd


def test_upsert_last_wins_and_stats(spark):
    base, upd = _base_updates(spark)
    snap = {r.id: (r.name, r.bal) for r in upsert.upsert(base, upd, ["id"], seq="seq").collect()}
    assert snap == {1: ("a", 1.0), 2: ("b", 2.0), 3: ("c", 7.0), 4: ("d", 4.0)}
    st = upsert.upsert_stats(base, upd, ["id"], seq="seq").first().asDict()
    assert st == {"inserted": 1, "matched": 2, "modified": 1, "untouched": 1, "affected": 3}


def test_upsert_twice_equals_once(spark):
    base, upd = _base_updates(spark)
    once = upsert.upsert(base, upd, ["id"], seq="seq")
    twice = upsert.upsert(once, upd, ["id"], seq="seq")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_insert_mode_fails_on_collision_before_writing(spark):
    base, upd = _base_updates(spark)
    batch = upd.drop("seq")
    conf = {(r.id, r.reason) for r in upsert.insert_conflicts(base, batch, ["id"]).collect()}
    assert conf == {(2, "exists"), (3, "exists"), (3, "duplicate_in_batch")}
    with pytest.raises(upsert.KeyError_):
        upsert.assert_insertable(base, batch, ["id"])
    upsert.assert_insertable(base, batch.where("id = 4"), ["id"])


def test_missing_id_checks(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "purchase_id string, x int")
    with pytest.raises(upsert.KeyError_):
        upsert.assert_ids_present(df, "purchase_id", "purchases")
    with pytest.raises(upsert.KeyError_):
        upsert.assert_ids_present(df, "id", "products")
    r = upsert.missing_ids(df, "purchase_id", "purchases").first()
    assert (r.missing, r.rows) == (1, 2)
    assert upsert.unique_violations(df.unionByName(df), ["purchase_id"]).count() == 2


def test_duplicate_alert_threshold_is_strict(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id")
    x2 = monitor.duplicate_ratio(ev.unionByName(ev), ["event_id"], "x2")
    x3 = monitor.duplicate_ratio(ev.unionByName(ev).unionByName(ev), ["event_id"], "x3")
    assert x2.first().dup_ratio == 0.5
    alerts = monitor.duplicate_alert(x2.unionByName(x3)).collect()
    assert [a.table_name for a in alerts] == ["x3"]
    empty = monitor.duplicate_ratio(ev.where(F.lit(False)), ["event_id"], "empty").first()
    assert empty.rows == 0 and empty.dup_ratio is None


def test_kpi_counts(spark):
    p = fixtures.r_purchases(spark, SF_SMALL)
    k = monitor.kpi_counts(p).first()
    assert k.purchases == p.count()
    assert k.stores == p.select("store_id").distinct().count()


def test_reconcile_documents_equals_flat_lines(spark):
    from shoplens.operators import baskets
    from shop_fixtures import documents

    a = baskets.reconcile(documents.purchase_documents(spark, SF_SMALL))
    b = baskets.reconcile_lines(documents.purchase_lines(spark, SF_SMALL), documents.purchase_heads(spark, SF_SMALL),
                                key="order_key").selectExpr(f"{documents.PURCHASE_ID_SQL} AS purchase_id",
                                                            "items_total", "total_amount", "diff", "matches")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    assert {r[0] for r in a.select("matches").distinct().collect()} == {True, False}


def test_an_order_with_many_lines_and_repeated_numbers_keeps_every_line(spark, tmp_dir):
    import json
    import os

    from shoplens.operators import baskets
    from shoplens.plans import loader

    items = [{"product_id": f"prd-{i}", "line_no": i % 700, "quantity": 1, "price_per_unit": 1.5, "total_price": 1.5}
             for i in range(1500)]
    src, db = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    docs = {"purchases": {"purchase_id": "ord-1", "items": items, "total_amount": 2250.0},
            "customers": {"customer_id": "c"}, "stores": {"store_id": "s"}, "products": {"id": "p"}}
    for name, doc in docs.items():
        with open(os.path.join(src, f"{name}.jsonl"), "w", encoding="utf-8") as f:
            f.write(json.dumps(doc) + "\n")
    loader.run(spark, src, db)
    got = loader.read_collection(spark, db, "purchases")
    back = baskets.basket_items(got)
    assert back.count() == 1500 and {r.line_no for r in back.select("line_no").collect()} == set(range(700))
    assert baskets.reconcile(got).first().matches


def test_customer_date_rules(spark):
    df = spark.createDataFrame(
        [("c1", "2023-05-01T10:00:00Z", "1990-01-01"),
         ("c2", "2023-05-01T10:00:00Z", "2023-05-01"),
         ("c3", "2034-01-01T00:00:00Z", None),
         ("c4", "yesterday", None),
         ("c5", "2023-05-01T10:00:00Z", "01/02/1990"),
         ("c6", "2023-05-01T10:00:00Z", None)],
        "customer_id string, registration_date string, birth_date string")
    df = df.selectExpr("*", "' F' AS gender", "'ru' AS preferred_language", "true AS is_loyalty_member")
    got = {r.customer_id: r.reject_reason for r in cleaning.rejected(df, AS_OF, cleaning.CUSTOMER_RULES).collect()}
    assert got == {"c2": "birth_after_registration", "c3": "future", "c4": "bad_date", "c5": "bad_date"}
    mart = cleaning.clean(df.unionByName(df), AS_OF, cleaning.CUSTOMER_RULES)[0].collect()
    assert sorted(r.customer_id for r in mart) == ["c1", "c6"]  # republished customers: one row each
    assert cleaning.normalize_case(df, cleaning.CUSTOMER_RULES).first().gender == "f"


def test_tabs_and_no_break_spaces_are_blank(spark):
    df = spark.createDataFrame([("p1", "c", "\t", "cash"), ("p2", "c", "s", "\u00a0"), ("p3", "c", "s", "cash\t")],
                               "purchase_id string, customer_id string, store_id string, payment_method string")
    df = df.selectExpr("*", "'2024-01-01T00:00:00Z' AS purchase_datetime", "1.0D AS total_amount", "true AS is_delivery")
    assert {r.purchase_id for r in cleaning.check_blank(df).collect()} == {"p1", "p2"}
    assert cleaning.accepted(df, AS_OF).first().payment_method == "cash"


def test_upsert_keeps_the_newer_row_of_the_base(spark):
    base = spark.createDataFrame([("k", 2, "new"), ("other", 1, "x")], "k string, t int, v string")
    late = spark.createDataFrame([("k", 1, "old"), ("n", 1, "y")], "k string, t int, v string")
    got = sorted(map(tuple, upsert.upsert(base, late, ["k"], "t").collect()))
    assert got == [("k", 2, "new"), ("n", 1, "y"), ("other", 1, "x")]


def test_raw_fixture_matches_measured_counts_at_sf001(spark):
    """FIXTURES §3 measured counts for the dirty RAW view and lineitem keys."""
    root = "/root/testdata/sf0.01"
    raw = fixtures.raw_purchases(spark, root)
    reasons = {r[0]: r[1] for r in cleaning.with_reasons(raw, AS_OF).groupBy("reject_reason").count().collect()}
    assert reasons == {"null": 185, "blank": 100, "bad_date": 104, "future": 117, None: 1656}
    assert cleaning.clean(raw, AS_OF)[0].count() == 1475
    li = spark.read.parquet(f"{root}/lineitem.parquet")
    r = monitor.duplicate_ratio(li, ["l_orderkey", "l_linenumber"], "lineitem").first()
    assert (r.rows, r.duplicate_rows) == (60000, 14168)
