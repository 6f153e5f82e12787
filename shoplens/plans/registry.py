"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or views Spark derives from them)
in full. Oracle SQL with the same output columns lives in
``shoplens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shop_fixtures import documents, streams
from shop_fixtures import views as fixtures
from shoplens.functions import time as T
from shoplens.functions.pii import PiiHasher, normalize_email, normalize_phone
from shoplens.operators import baskets, cleaning, features, monitor, pii, upsert
from shoplens.operators.dedup import keep_max
from shoplens.plans import mart_job
from shoplens.plans.oracle import FEATURE_KEYS
from shoplens.schemas import L0_TOPICS
from shoplens.session import scratch_path
from shoplens.sinks import keyed, rollup
from shoplens.sinks.export import to_messages
from shoplens.sources import message_log
from shoplens.sources.tables import read_table
from shoplens.streaming import mart_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def fixture_matrix(spark, root, ranked=False):
    """The matrix over the fixture marts derived from the driver's tables."""
    return features.customer_feature_matrix(fixtures.r_customers(spark, root), fixtures.r_purchases(spark, root),
                                            as_of=fixtures.FIXTURE_AS_OF, ranked=ranked)


@register("customer_feature_matrix")
def q_customer_feature_matrix(spark, root):
    return fixture_matrix(spark, root)


def _flag_query(flag: str) -> Query:
    def q(spark, root):
        return fixture_matrix(spark, root).select("customer_id", flag)
    return q


for _key, _flag in FEATURE_KEYS.items():
    QUERIES[_key] = _flag_query(_flag)


# ============================================================ shared inputs
AS_OF = fixtures.FIXTURE_AS_OF
# Test salt for the registered PII queries (a deployment passes its own).
FIXTURE_SALT = "fixture-salt"


def _enriched(spark, root):
    return features.enrich_purchases(features.conform_purchases(fixtures.r_purchases(spark, root)), AS_OF)


def _customers(spark, root):
    return features.conform_customers(fixtures.r_customers(spark, root))


def _aggs(spark, root):
    return features.customer_aggregates(_enriched(spark, root))


def _int(c):
    return F.col(c).cast("int").alias(c)


# --------------------------------------------------------------- E1-E8
@register("project_cast")
def q_project_cast(spark, root):
    return features.conform_purchases(fixtures.r_purchases(spark, root))


@register("coalesce_default")
def q_coalesce_default(spark, root):
    raw = fixtures.raw_purchases(spark, root)
    return raw.select("purchase_id", "customer_id",
                      F.coalesce(F.col("is_delivery").cast("int"), F.lit(0)).alias("is_delivery"),
                      F.coalesce(F.col("total_amount"), F.lit(0.0)).alias("total_amount"))


@register("age_days")
def q_age_days(spark, root):
    return _enriched(spark, root).select("purchase_id", "days_ago")


@register("age_windows")
def q_age_windows(spark, root):
    return _enriched(spark, root).select("purchase_id", *[_int(c) for c in ("is_7d", "is_14d", "is_15_30d", "is_30d")])


@register("weekend_weekday")
def q_weekend_weekday(spark, root):
    return _enriched(spark, root).select("purchase_id", _int("is_weekend"), _int("is_weekday"))


@register("day_parts")
def q_day_parts(spark, root):
    return _enriched(spark, root).select("purchase_id", F.hour("purchase_ts").alias("hour"),
                                         _int("is_morning"), _int("is_night"))


# --------------------------------------------------------------- A1-A12
_AGG_KEYS = {
    "agg_count": ["purchases_cnt"],
    "agg_last_purchase": ["last_purchase_ts"],
    "agg_window_counts": ["cnt_14d", "cnt_15_30d"],
    "agg_share_delivery": ["share_delivery"],
    "agg_share_payment": ["share_cash", "share_card"],
    "agg_share_week": ["share_weekend", "share_weekday"],
    "agg_share_daypart": ["share_morning", "share_night"],
    "agg_window_sums": ["sum_7d", "sum_30d"],
    "agg_avg_check": ["avg_check_30d"],
    "agg_distinct_stores": ["distinct_stores_30d"],
}
BASE_AGG_COLUMNS = ["customer_id", "purchases_cnt", "last_purchase_ts", "cnt_14d", "cnt_15_30d",
                    "share_delivery", "share_cash", "share_card", "share_weekend", "share_weekday",
                    "share_morning", "share_night", "sum_7d", "sum_30d", "avg_check_30d",
                    "distinct_stores_30d"]


def _agg_query(cols):
    def q(spark, root):
        if all(c in features.MEASURES for c in cols):
            return features.customer_totals(_enriched(spark, root), *cols)
        return _aggs(spark, root).select("customer_id", *cols)
    return q


for _key, _cols in _AGG_KEYS.items():
    QUERIES[_key] = _agg_query(_cols)


@register("store_counts_30d")
def q_store_counts_30d(spark, root):
    return features.store_counts_30d(_enriched(spark, root))


@register("customer_base_agg")
def q_customer_base_agg(spark, root):
    return _aggs(spark, root).select(*BASE_AGG_COLUMNS)


# --------------------------------------------------------------- W1-W2, J
@register("top_store")
def q_top_store(spark, root):
    return features.top_store(_enriched(spark, root))


@register("top_store_share")
def q_top_store_share(spark, root):
    return features.top_store_share(_enriched(spark, root))


@register("join_features")
def q_join_features(spark, root):
    j = features.join_customers(_customers(spark, root), _aggs(spark, root))
    return j.select("customer_id", "registration_dt", "is_loyalty_member", "purchases_cnt",
                    "sum_30d", "top_store_share_30d")


@register("null_fill")
def q_null_fill(spark, root):
    joined = features.join_customers(_customers(spark, root), _aggs(spark, root))
    return features.fill_defaults(joined).drop("cnt_30d")


@register("customer_feature_matrix_window")
def q_matrix_window(spark, root):
    return fixture_matrix(spark, root, ranked=True)


# Two days for the incremental matrix; the earlier one lies inside the data.
INCREMENTAL_AS_OF = ("2024-01-24 00:00:00", AS_OF)


def incremental_loads(spark, root):
    """r_purchases in two deliveries. The first lacks every third purchase and
    has an earlier version of every fifth (two days before, another amount);
    the second has what was missing, the versions that stay, and copies of
    every seventh that are older than what is stored."""
    p = fixtures.r_purchases(spark, root)
    number = F.expr("CAST(substring(purchase_id, 5) AS BIGINT)")

    def earlier(rows, days):
        return rows.withColumns({"purchase_datetime": F.expr(f"purchase_datetime - INTERVAL {days} DAYS"),
                                 "total_amount": F.col("total_amount") + 1})

    late, changed = number % 3 == 0, number % 5 == 0
    first = p.where(~late & ~changed).unionByName(earlier(p.where(~late & changed), 2))
    return first, p.where(late | changed).unionByName(earlier(p.where(number % 7 == 0), 3))


@register("feature_matrix_incremental")
def q_feature_matrix_incremental(spark, root):
    table = rollup.open_rollup(spark, scratch_path(spark, "feature_matrix_incremental"), buckets=8)
    for n, purchases in enumerate(incremental_loads(spark, root)):
        table = table.loaded(purchases, tag=str(n)).commit()
    out = [table.matrix(fixtures.r_customers(spark, root), as_of).withColumn("as_of", F.lit(as_of)) for as_of in INCREMENTAL_AS_OF]
    return out[0].unionByName(out[1])


# --------------------------------------------------------------- P1-P7, K2
def _hasher(algorithm="hmac_sha256"):
    return PiiHasher.from_text(FIXTURE_SALT, algorithm)


@register("pii_email")
def q_pii_email(spark, root):
    c = fixtures.pii_contacts(spark, root)
    return c.select("c_custkey", normalize_email(F.col("email")).alias("email"))


@register("pii_phone")
def q_pii_phone(spark, root):
    c = fixtures.pii_contacts(spark, root)
    return c.select("c_custkey", normalize_phone(F.col("phone")).alias("phone"))


def _pii_hash_query(algorithm):
    def q(spark, root):
        h = _hasher(algorithm)
        c = fixtures.pii_contacts(spark, root)
        return c.select("c_custkey", h.email(F.col("email")).alias("email_hash"),
                        h.phone(F.col("phone")).alias("phone_hash"))
    return q


QUERIES["pii_hmac"] = _pii_hash_query("hmac_sha256")
QUERIES["pii_md5"] = _pii_hash_query("md5")


@register("pii_nested")
def q_pii_nested(spark, root):
    docs = pii.protect(documents.purchase_documents(spark, root), "purchases", _hasher())
    return docs.select("purchase_id", F.col("customer.customer_id").alias("customer_id"),
                       F.col("customer.email").alias("email_hash"),
                       F.col("customer.phone").alias("phone_hash"))


@register("l0_customers")
def q_l0_customers(spark, root):
    docs = pii.protect(documents.customer_documents(spark, root), "customers", _hasher())
    return docs.select("customer_id", "first_name", "email", "phone", "registration_date",
                       F.col("is_loyalty_member").cast("int").alias("is_loyalty_member"),
                       "loyalty_card_number")


@register("l0_messages")
def q_l0_messages(spark, root):
    h = _hasher()
    parts = [
        to_messages(pii.protect(documents.customer_documents(spark, root), "customers", h), "customers"),
        to_messages(pii.protect(documents.product_documents(spark, root), "products", h), "products"),
        to_messages(pii.protect(documents.store_documents(spark, root), "stores", h), "stores"),
        to_messages(pii.protect(documents.purchase_documents(spark, root), "purchases", h), "purchases"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------- C1-C8
def _raw(spark, root):
    return fixtures.raw_purchases(spark, root)


@register("check_null")
def q_check_null(spark, root):
    return cleaning.check_null(_raw(spark, root))


@register("check_blank")
def q_check_blank(spark, root):
    return cleaning.check_blank(_raw(spark, root))


@register("check_dates")
def q_check_dates(spark, root):
    return cleaning.check_dates(_raw(spark, root), AS_OF)


@register("normalize_case")
def q_normalize_case(spark, root):
    return cleaning.normalize_case(_raw(spark, root)).select("purchase_id", "customer_id", "payment_method")


@register("dedup_latest")
def q_dedup_latest(spark, root):
    raw = _raw(spark, root)
    return keep_max(raw, ["purchase_id"], [T.parse_iso_z(F.col("purchase_datetime"))])


@register("customers_mart")
def q_customers_mart(spark, root):
    return cleaning.customers_mart(documents.customer_documents(spark, root))


@register("purchases_mart")
def q_purchases_mart(spark, root):
    return cleaning.purchases_mart(documents.purchase_documents(spark, root))


@register("customers_mart_clean")
def q_customers_mart_clean(spark, root):
    return cleaning.clean(fixtures.raw_customers(spark, root), AS_OF, cleaning.CUSTOMER_RULES)[0]


@register("customers_rejects")
def q_customers_rejects(spark, root):
    return cleaning.clean(fixtures.raw_customers(spark, root), AS_OF, cleaning.CUSTOMER_RULES)[1]


@register("customers_normalize_case")
def q_customers_normalize_case(spark, root):
    return cleaning.normalize_case(fixtures.raw_customers(spark, root), cleaning.CUSTOMER_RULES).select(
        "customer_id", "gender", "preferred_language")


@register("mart_clean")
def q_mart_clean(spark, root):
    return cleaning.clean(_raw(spark, root), AS_OF)[0]


@register("mart_rejects")
def q_mart_rejects(spark, root):
    return cleaning.clean(_raw(spark, root), AS_OF)[1]


# --------------------------------------------------------------- U1-U5
UPSERT_KEY = ["c_custkey"]


def upsert_inputs(spark, root):
    """base = every customer; updates = every customer again (keys ending in
    8/9 become new keys -> inserts, odd keys get a changed balance ->
    modified) plus a stale earlier version of every key (seq 1, loses)."""
    base = read_table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                      "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    new_key = F.when(k % 10 >= 8, k + F.lit(1_000_000_000)).otherwise(k)
    bal = F.when(k % 2 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    cur = base.select(new_key.alias("c_custkey"), "c_name", "c_nationkey", bal.alias("c_acctbal"),
                      "c_mktsegment", F.lit(2).alias("seq"))
    stale = base.select(new_key.alias("c_custkey"), "c_name", "c_nationkey",
                                         (F.col("c_acctbal") - 100).alias("c_acctbal"),
                                         "c_mktsegment", F.lit(1).alias("seq"))
    return base, cur.unionByName(stale)


@register("upsert_by_key")
def q_upsert_by_key(spark, root):
    base, upd = upsert_inputs(spark, root)
    return upsert.upsert(base, upd, UPSERT_KEY, seq="seq")


def merge_on_read_table(spark, root):
    """Every customer as the base, then ``upsert_inputs``' updates in three
    batches: the stale versions, the odd keys, the even keys."""
    base, upd = upsert_inputs(spark, root)
    columns = [*base.columns, "seq"]
    place = scratch_path(spark, "upsert_merge_on_read")
    table = keyed.create(spark, place, base.withColumn("seq", F.lit(0)).schema, UPSERT_KEY, "seq", buckets=8)
    table = table.loaded(base.withColumn("seq", F.lit(0)).select(*columns)).commit()
    for which in ("seq = 1", "seq = 2 AND c_custkey % 2 = 1", "seq = 2 AND c_custkey % 2 = 0"):
        table = table.upserted(upd.where(which).select(*columns)).commit()
    return table


@register("upsert_merge_on_read")
def q_upsert_merge_on_read(spark, root):
    return merge_on_read_table(spark, root).read().drop("seq")


@register("upsert_stats")
def q_upsert_stats(spark, root):
    base, upd = upsert_inputs(spark, root)
    return upsert.upsert_stats(base, upd, UPSERT_KEY, seq="seq")


@register("insert_conflicts")
def q_insert_conflicts(spark, root):
    base, upd = upsert_inputs(spark, root)
    return upsert.insert_conflicts(base, upd.drop("seq"), UPSERT_KEY)


@register("insert_conflicts_indexed")
def q_insert_conflicts_indexed(spark, root):
    base, upd = upsert_inputs(spark, root)
    table = keyed.create(spark, scratch_path(spark, "insert_conflicts_indexed"), base.schema, UPSERT_KEY, buckets=8).loaded(base)
    return table.conflicts(upsert.settled(upd.drop("seq"), "insert-batch"))


@register("unique_violations")
def q_unique_violations(spark, root):
    li = read_table(spark, root, "lineitem")
    return upsert.unique_violations(li, ["l_orderkey", "l_linenumber"])


@register("missing_ids")
def q_missing_ids(spark, root):
    return upsert.missing_ids(_raw(spark, root), "purchase_id", "purchases")


# --------------------------------------------------------------- M1-M3
@register("kpi_counts")
def q_kpi_counts(spark, root):
    return monitor.kpi_counts(fixtures.r_purchases(spark, root))


def duplicate_ratios(spark, root):
    one = [(read_table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
           (read_table(spark, root, "orders"), ["o_orderkey"], "orders"),
           (read_table(spark, root, "customer"), ["c_custkey"], "customer"),
           (_raw(spark, root), ["purchase_id"], "raw_purchases")]
    out = monitor.republished_ratio(read_table(spark, root, "events"), ["event_id"],
                                    {"events": 1, "events_x2": 2, "events_x3": 3})
    for df, keys, name in one:
        out = out.unionByName(monitor.duplicate_ratio(df, keys, name))
    return out


@register("duplicate_ratio")
def q_duplicate_ratio(spark, root):
    return duplicate_ratios(spark, root)


@register("duplicate_alert")
def q_duplicate_alert(spark, root):
    return monitor.duplicate_alert(duplicate_ratios(spark, root)).select("table_name", "dup_ratio")


# --------------------------------------------------------------- ST1-ST3
def _stream_out(spark, name, stream):
    base = scratch_path(spark, name)
    mart_stream.run_to_table(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@register("stream_mart_clean")
def q_stream_mart_clean(spark, root):
    return _stream_out(spark, "stream_mart_clean",
                       mart_stream.clean_stream(streams.raw_purchase_stream(spark, root), AS_OF))


@register("stream_dedup")
def q_stream_dedup(spark, root):
    return _stream_out(spark, "stream_dedup", mart_stream.dedup_stream(streams.republished_stream(spark, root)))


@register("stream_mart_upsert")
def q_stream_mart_upsert(spark, root):
    base = scratch_path(spark, "stream_mart_upsert")
    streams.run_arrivals(spark, root, base, AS_OF)
    return mart_stream.read_mart(spark, f"{base}/out/mart")


@register("stream_mart_rejects")
def q_stream_mart_rejects(spark, root):
    base = scratch_path(spark, "stream_mart_rejects")
    streams.run_arrivals(spark, root, base, AS_OF)
    return spark.read.parquet(f"{base}/out/rejects").drop("batch_id")


@register("stream_l0_messages")
def q_stream_l0_messages(spark, root):
    """All four collections through the message log: RAW purchases in three
    publications, the mart's stream restarted after each."""
    base = scratch_path(spark, "stream_l0_messages")
    log = f"{base}/log"
    others = {"customers": documents.customer_documents, "products": documents.product_documents, "stores": documents.store_documents}
    for n, docs in enumerate(streams.arrivals(spark, root)):
        message_log.append(to_messages(docs, "purchases"), log)
        if n == 0:
            for name, view in others.items():
                message_log.append(to_messages(view(spark, root), name), log)
        mart_job.run_stream(spark, message_log.message_stream(spark, log, L0_TOPICS["purchases"]), AS_OF, f"{base}/out")
    return mart_stream.read_mart(spark, f"{base}/out/mart")


# --------------------------------------------------------------- G1-G9
@register("purchase_documents")
def q_purchase_documents(spark, root):
    docs = documents.purchase_documents(spark, root)
    return docs.select(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).alias("document"))


@register("basket_items")
def q_basket_items(spark, root):
    return baskets.basket_items(documents.purchase_documents(spark, root))


@register("basket_reconcile")
def q_basket_reconcile(spark, root):
    r = baskets.reconcile_lines(documents.purchase_lines(spark, root), documents.purchase_heads(spark, root),
                                key="order_key")
    return r.selectExpr(f"{documents.PURCHASE_ID_SQL} AS purchase_id", "items_total", "total_amount", "diff",
                        "matches")


@register("basket_reconcile_documents")
def q_basket_reconcile_documents(spark, root):
    return baskets.reconcile(documents.purchase_documents(spark, root))


@register("customer_home_store")
def q_customer_home_store(spark, root):
    hs = baskets.home_store(documents.customer_documents(spark, root), documents.store_documents(spark, root))
    return hs.select("customer_id", "home_store_id", "home_store_name", "home_store_network")


@register("sample_per_category")
def q_sample_per_category(spark, root):
    p = read_table(spark, root, "part").select("p_partkey", "p_name", "p_type")
    return baskets.sample_per_group(p, "p_type", F.md5(F.col("p_partkey").cast("string")), 10)


@register("maker_domain")
def q_maker_domain(spark, root):
    makers = read_table(spark, root, "supplier").selectExpr(
        "s_suppkey", "s_name",
        "CASE s_suppkey % 4 WHEN 0 THEN concat('ООО «', s_name, '»') WHEN 1 THEN concat('АО ', repeat(s_name, 3)) "
        "WHEN 2 THEN ' «»ИП' ELSE s_name END AS maker")
    return baskets.maker_domains(makers, "maker")


@register("iso_z_roundtrip")
def q_iso_z_roundtrip(spark, root):
    ev = read_table(spark, root, "events").select("event_id", "ts")
    return baskets.iso_z_roundtrip(ev, "ts")
