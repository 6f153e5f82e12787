"""Properties with generated inputs (merged parts = ranked stores)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens.operators.features import customer_feature_matrix

AS_OF = dt.datetime(2026, 3, 1, 12, 0, 0)

purchase = st.tuples(
    st.sampled_from(["c1", "c2", "c3", "c9"]),
    st.one_of(st.none(), st.sampled_from(["s1", "s2", "s3"])),
    st.one_of(st.none(), st.integers(min_value=-2 * 86400, max_value=40 * 86400)),
    st.one_of(st.none(), st.integers(min_value=0, max_value=300000)),
    st.one_of(st.none(), st.sampled_from(["cash", "CASH", "card", "Card ", "other"])),
    st.one_of(st.none(), st.sampled_from([0, 1])),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(purchase, min_size=0, max_size=25))
def test_merged_parts_equal_ranked_stores(spark, rows):
    cust = spark.createDataFrame(
        [("c1", "2026-02-20 00:00:00", 1), ("c2", None, None), ("c3", "2020-01-01 00:00:00", 0)],
        "customer_id string, registration_dt string, is_loyalty_member int")
    data = []
    for i, (c, s, secs, cents, pm, d) in enumerate(rows):
        ts = None if secs is None else (AS_OF - dt.timedelta(seconds=secs)).strftime("%Y-%m-%d %H:%M:%S")
        data.append((f"p{i}", c, s, ts, None if cents is None else cents / 100.0, pm, d))
    pur = spark.createDataFrame(
        data, "purchase_id string, customer_id string, store_id string, purchase_datetime string, "
              "total_amount double, payment_method string, is_delivery int")
    pur = pur.selectExpr("purchase_id", "customer_id", "store_id",
                         "CAST(purchase_datetime AS TIMESTAMP) AS purchase_datetime",
                         "total_amount", "payment_method", "is_delivery")
    a = customer_feature_matrix(cust, pur, as_of=AS_OF)
    b = customer_feature_matrix(cust, pur, as_of=AS_OF, ranked=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


local = st.text(alphabet="abcdefghijklmnopqrstuvwxyzабвгд0123456789._", min_size=1, max_size=12)
spaces = st.text(alphabet=" \t 　\n", max_size=3)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(local, local, spaces, spaces, st.booleans()), min_size=1, max_size=30),
       st.lists(st.integers(min_value=0, max_value=9_999_999_999), min_size=1, max_size=30))
def test_pii_hash_is_stable_under_case_and_format(spark, emails, phones):
    from pyspark.sql import functions as F

    from shoplens.functions.pii import PiiHasher

    h = PiiHasher.from_text("salt")
    rows = []
    for a, b, l, r, up in emails:
        e = f"{a}@{b}.ru"
        rows.append((e, f"{l}{e.upper() if up else e.title()}{r}", "email"))
    for n in phones:
        d = f"{n:010d}"
        rows.append((f"7{d}", f"8 ({d[:3]}) {d[3:6]}-{d[6:8]}-{d[8:]}", "phone"))
        rows.append((f"+7 {d[:3]} {d[3:]}", f"7-{d}", "phone"))
    df = spark.createDataFrame(rows, "a string, b string, kind string")
    hashed = lambda c: F.when(F.col("kind") == "email", h.email(F.col(c))).otherwise(h.phone(F.col(c)))
    assert df.where(hashed("a") != hashed("b")).count() == 0
