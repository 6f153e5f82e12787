"""T5: plan shape checks (scans, pushdown, no Python in the hot path)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.functions import time as T
from shoplens.plans.registry import fixture_matrix
from shoplens.plans.registry import QUERIES
from shop_fixtures import views as fixtures
from shoplens.sources.tables import read_table

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_pass_matrix_scans_purchases_once_with_two_shuffles(spark):
    p = plan(fixture_matrix(spark, SF_SMALL))
    assert p.count("events.parquet") == 1
    assert p.count("Exchange hashpartitioning") <= 3
    assert not any(n in p for n in PYTHON_NODES)


def test_ranked_matrix_scans_once(spark):
    p = plan(fixture_matrix(spark, SF_SMALL, ranked=True))
    assert p.count("events.parquet") == 1
    assert "Window" in p


def test_totals_without_stores_take_one_shuffle(spark):
    for name in ("agg_count", "agg_share_payment", "agg_avg_check", "agg_window_sums"):
        assert plan(QUERIES[name](spark, SF_SMALL)).count("Exchange") == 1, name


def test_duplicate_ratio_reads_each_table_once(spark):
    p = plan(QUERIES["duplicate_ratio"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 5  # events, lineitem, orders, customer, raw (events again)


def test_no_python_workers_in_any_registered_query(spark):
    for name in ("pii_hmac", "pii_md5", "l0_customers", "mart_clean", "upsert_by_key", "basket_reconcile"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert not any(n in p for n in PYTHON_NODES), name


def test_thirty_day_range_reaches_the_parquet_scan(spark):
    ev = read_table(spark, SF_SMALL, "events")
    q = ev.where(T.ts_range_for_window(F.col("ts"), fixtures.FIXTURE_AS_OF, "30d")).select("event_id")
    p = plan(q)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_top_k_uses_window_group_limit(spark):
    p = plan(QUERIES["sample_per_category"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_dedup_is_a_partial_aggregate(spark):
    p = plan(QUERIES["mart_clean"](spark, SF_SMALL))
    assert "partial_max" in p


def test_ts_range_equals_age_window(spark):
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "ts")
    a = ev.where(T.ts_range_for_window(F.col("ts"), fixtures.FIXTURE_AS_OF, "7d"))
    b = ev.where(T.in_window(T.age_days(F.col("ts"), fixtures.FIXTURE_AS_OF), "7d"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_thirty_day_queries_push_into_a_month_partitioned_mart(spark, tmp_dir):
    import os

    from shoplens.operators import features
    from shoplens.sinks.export import write_purchases_mart

    path = os.path.join(tmp_dir, "purchases_mart")
    write_purchases_mart(fixtures.r_purchases(spark, SF_SMALL), path)
    mart = spark.read.parquet(path)
    enriched = features.enrich_purchases(features.conform_purchases(mart), fixtures.FIXTURE_AS_OF)
    q = features.store_counts_30d(enriched)
    p = plan(q)
    assert "PushedFilters: [IsNotNull(purchase_datetime), GreaterThanOrEqual(purchase_datetime" in p
    direct = features.store_counts_30d(features.enrich_purchases(
        features.conform_purchases(fixtures.r_purchases(spark, SF_SMALL)), fixtures.FIXTURE_AS_OF))
    assert q.exceptAll(direct).count() == 0 and direct.exceptAll(q).count() == 0


def test_month_partitions_are_pruned(spark, tmp_dir):
    import os

    from shoplens.sinks.export import month_filter_sql, write_purchases_mart

    path = os.path.join(tmp_dir, "purchases_mart")
    mart = fixtures.r_purchases(spark, SF_SMALL).withColumn(
        "purchase_datetime", F.col("purchase_datetime") - F.expr("INTERVAL 40 DAYS"))
    write_purchases_mart(mart.unionByName(fixtures.r_purchases(spark, SF_SMALL)), path)
    q = spark.read.parquet(path).where(month_filter_sql(fixtures.FIXTURE_AS_OF, "7d"))
    p = plan(q)
    assert "PartitionFilters: [isnotnull(purchase_month" in p
    months = {r[0] for r in q.select("purchase_month").distinct().collect()}
    assert months == {"2024-01"}


def test_hot_key_keeps_partial_aggregation_and_answers(spark):
    """One customer and one store hold a third of all purchases."""
    from shoplens.operators.features import customer_feature_matrix

    p = fixtures.r_purchases(spark, SF_SMALL)
    hot = p.withColumn("customer_id", F.when(F.expr("pmod(hash(purchase_id), 3) = 0"), F.lit("cus-1"))
                       .otherwise(F.col("customer_id"))) \
           .withColumn("store_id", F.when(F.col("customer_id") == "cus-1", F.lit("store-0"))
                       .otherwise(F.col("store_id")))
    c = fixtures.r_customers(spark, SF_SMALL)
    a = customer_feature_matrix(c, hot, as_of=fixtures.FIXTURE_AS_OF)
    b = customer_feature_matrix(c, hot, as_of=fixtures.FIXTURE_AS_OF, ranked=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    pl = plan(a)
    assert pl.count("partial_") >= 2  # both groupings combine map-side before their shuffle
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_upsert_reads_a_settled_batch_and_scans_the_base_once_for_counts(spark):
    from shoplens.operators import upsert as U
    from shoplens.plans.registry import UPSERT_KEY, upsert_inputs

    base, upd = upsert_inputs(spark, SF_SMALL)
    small = plan(U.upsert(base, upd, UPSERT_KEY, seq="seq"))
    assert "BroadcastHashJoin" in small and "LeftAnti" in small  # Spark's own decision, by file size
    stats = plan(U.upsert_stats(base, upd, UPSERT_KEY, seq="seq"))
    assert stats.count("customer.parquet") == 1
    for p in (small, stats, plan(U.insert_conflicts(base, upd.drop("seq"), UPSERT_KEY))):
        assert "LocalLimit" not in p and "GlobalLimit" not in p
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    a = sorted(map(tuple, U.upsert(base, upd, UPSERT_KEY, seq="seq").collect()))
    s1 = U.upsert_stats(base, upd, UPSERT_KEY, seq="seq").first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = U.upsert(base, upd, UPSERT_KEY, seq="seq")
        assert "SortMergeJoin" in plan(big) and "BroadcastHashJoin" not in plan(big)
        assert sorted(map(tuple, big.collect())) == a
        assert U.upsert_stats(base, upd, UPSERT_KEY, seq="seq").first() == s1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_month_with_most_rows_is_written_by_several_tasks(spark, tmp_dir):
    import os

    from shoplens.sinks.export import write_purchases_mart

    rows = spark.range(60_000).selectExpr(
        "concat('p', id) AS purchase_id", "concat('c', id % 997) AS customer_id", "'s' AS store_id",
        "CASE WHEN id % 10 = 0 THEN TIMESTAMP '2024-02-05 00:00:00' ELSE TIMESTAMP '2024-01-05 00:00:00' END "
        "AS purchase_datetime", "rand(1) AS total_amount", "'cash' AS payment_method", "0 AS is_delivery")
    path = os.path.join(tmp_dir, "mart")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "128k")
    try:
        write_purchases_mart(rows, path)
    finally:
        spark.conf.unset(key)
    hot = [f for f in os.listdir(os.path.join(path, "purchase_month=2024-01")) if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(path).count() == 60_000
