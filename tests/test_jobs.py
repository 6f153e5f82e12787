"""Entry points: L0 publisher, collection loader, feature job with a target table."""

import json
import os
import tempfile

import pytest

from conftest import SF_SMALL
from shoplens.config import JobConfig
from shoplens.functions.pii import PiiHasher
from shoplens.operators.upsert import KeyError_
from shoplens.operators.features import customer_feature_matrix
from shoplens.plans import feature_job, l0_publish, loader
from shoplens.plans.registry import fixture_matrix
from shoplens.sinks import matrix as msink, snapshot
from shoplens.sinks.export import write_ndjson
from shop_fixtures import documents, views as fixtures


def test_l0_publish_to_files(spark, tmp_dir):
    cols = {"customers": documents.customer_documents(spark, SF_SMALL),
            "stores": documents.store_documents(spark, SF_SMALL)}
    done = l0_publish.run(spark, cols, PiiHasher.from_text("salt"), fmt="json", path=tmp_dir)
    assert done == {"customers": "retail.customers.l0", "stores": "retail.stores.l0"}
    msg = spark.read.json(os.path.join(tmp_dir, "customers")).first()
    doc = json.loads(msg.value)
    assert len(doc["email"]) == 64 and "@" not in doc["email"]
    st = json.loads(spark.read.json(os.path.join(tmp_dir, "stores")).first().value)
    assert len(st["manager"]["phone"]) == 64


def _write_collections(spark, d, extra_customer=None):
    docs = {"customers": documents.customer_documents(spark, SF_SMALL),
            "stores": documents.store_documents(spark, SF_SMALL),
            "products": documents.product_documents(spark, SF_SMALL),
            "purchases": documents.purchase_documents(spark, SF_SMALL)}
    for name, df in docs.items():
        out = tempfile.mkdtemp(dir=d, prefix=f"_{name}")
        write_ndjson(df.coalesce(1), out, mode="overwrite")
        part = [f for f in os.listdir(out) if f.endswith(".json")][0]
        with open(os.path.join(out, part), encoding="utf-8") as src, \
                open(os.path.join(d, f"{name}.jsonl"), "w", encoding="utf-8") as dst:
            dst.write(src.read())
            if name == "customers" and extra_customer:
                dst.write(extra_customer + "\n")
    return {k: v.count() for k, v in docs.items()}


def test_loader_upsert_insert_and_stats(spark, tmp_dir):
    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    counts = _write_collections(spark, src)
    r1 = loader.run(spark, src, tgt)
    assert {k: v["affected"] for k, v in r1.items()} == counts
    assert all(v["modified"] == 0 for v in r1.values())
    r2 = loader.run(spark, src, tgt)  # rerun: all matched, nothing modified
    assert r2["customers"] == {"affected": counts["customers"], "modified": 0}
    with pytest.raises(KeyError_):
        loader.run(spark, src, tgt, mode="insert")
    with pytest.raises(KeyError_):  # drop + a batch that collides in itself: the old rows stay
        with open(os.path.join(src, "stores.jsonl"), "a", encoding="utf-8") as f:
            f.write(json.dumps({"store_id": "twice"}) + "\n" + json.dumps({"store_id": "twice"}) + "\n")
        loader.run(spark, src, tgt, mode="insert", drop=True)
    for name, n in counts.items():
        assert snapshot.read_current(spark, os.path.join(tgt, name)).count() == n
    _write_collections(spark, src)
    before = snapshot.current(spark, os.path.join(tgt, "customers"))
    assert snapshot.read_current(spark, os.path.join(tgt, "customers")).count() == counts["customers"]
    # a changed document: one modified, later line wins
    with open(os.path.join(src, "customers.jsonl"), "a", encoding="utf-8") as f:
        f.write(json.dumps({"customer_id": "cus-1", "first_name": "Changed", "is_loyalty_member": "yes",
                            "nobody": {"declared": [1, {"this": "field"}]}}) + "\n")
    r3 = loader.run(spark, src, tgt)
    assert r3["customers"]["modified"] == 1
    got = loader.read_collection(spark, tgt, "customers").where("customer_id = 'cus-1'").collect()
    assert len(got) == 1 and got[0].first_name == "Changed"
    assert got[0].is_loyalty_member is None  # a value of another type; the document keeps it
    done = l0_publish.main({"SOURCE_ROOT": tgt, "PII_SALT": "salt", "SINK_FORMAT": "json",
                            "SINK_PATH": os.path.join(tmp_dir, "topics")})
    assert set(done) == set(counts)
    doc = json.loads(spark.read.json(os.path.join(tmp_dir, "topics", "customers")).where("value LIKE '%Changed%'").first().value)
    assert "declared" in json.dumps(doc["nobody"])
    assert snapshot.current(spark, os.path.join(tgt, "customers")) != before


def test_loader_missing_id_writes_nothing(spark, tmp_dir):
    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    _write_collections(spark, src, extra_customer=json.dumps({"first_name": "no id"}))
    with pytest.raises(KeyError_):
        loader.run(spark, src, tgt)
    assert snapshot.current(spark, os.path.join(tgt, "customers")) is None


def test_feature_job_with_catalog_table(spark, tmp_dir):
    cfg = JobConfig(target_root=tmp_dir, tgt_db="analytics_test", as_of=fixtures.FIXTURE_AS_OF)
    path = msink.target_path(spark, cfg)
    res = feature_job.run(spark, cfg, fixtures.r_customers(spark, SF_SMALL), fixtures.r_purchases(spark, SF_SMALL))
    assert res["rows"] == 150
    spark.sql(f"REFRESH TABLE {cfg.target}")
    assert spark.table(cfg.target).count() == 150


def test_loader_bad_json_in_last_file_writes_nothing(spark, tmp_dir):
    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    _write_collections(spark, src)
    with open(os.path.join(src, "purchases.jsonl"), "a", encoding="utf-8") as f:
        f.write("{bad\n")
    with pytest.raises(ValueError, match="purchases.jsonl:"):
        loader.run(spark, src, tgt)
    for name in ("customers", "stores", "products", "purchases"):
        assert snapshot.current(spark, os.path.join(tgt, name)) is None


def test_read_marts_with_declared_schemas(spark, tmp_dir):
    from shoplens.sinks.export import write_purchases_mart

    root = os.path.join(tmp_dir, "src", "retail_mart")
    fixtures.r_customers(spark, SF_SMALL).write.parquet(os.path.join(root, "customers_mart.parquet"))
    write_purchases_mart(fixtures.r_purchases(spark, SF_SMALL), os.path.join(root, "purchases_mart.parquet"))
    c, p = feature_job.read_marts(spark, JobConfig(source_root=os.path.join(tmp_dir, "src")))
    assert c.count() == 150 and p.count() == fixtures.r_purchases(spark, SF_SMALL).count()
    m = customer_feature_matrix(c, p, as_of=fixtures.FIXTURE_AS_OF)
    assert m.exceptAll(fixture_matrix(spark, SF_SMALL)).count() == 0


def test_feature_job_main_writes_the_target_and_the_monthly_csv(spark, tmp_dir):
    from shoplens.sinks.export import write_purchases_mart

    root = os.path.join(tmp_dir, "src", "retail_mart")
    fixtures.r_customers(spark, SF_SMALL).write.parquet(os.path.join(root, "customers_mart.parquet"))
    write_purchases_mart(fixtures.r_purchases(spark, SF_SMALL), os.path.join(root, "purchases_mart.parquet"))
    res = feature_job.main({"SOURCE_ROOT": os.path.join(tmp_dir, "src"), "TARGET_ROOT": os.path.join(tmp_dir, "wh"),
                            "TGT_DB": "analytics_main", "AS_OF": fixtures.FIXTURE_AS_OF,
                            "CSV_ROOT": os.path.join(tmp_dir, "s3")})
    assert res["rows"] == 150 and spark.table("analytics_main.customer_feature_matrix").count() == 150
    assert res["csv"].endswith("/analytic_result_2024_01.csv") and os.path.isfile(res["csv"])
    assert spark.read.option("header", True).csv(res["csv"]).count() == 150
    with pytest.raises(ValueError, match="TARGET_ROOT"):
        feature_job.run(spark, JobConfig(), fixtures.r_customers(spark, SF_SMALL), fixtures.r_purchases(spark, SF_SMALL))


def test_jdbc_marts_are_configured_by_environment(spark):
    cfg = JobConfig.from_env({"SOURCE_FORMAT": "jdbc", "CH_HOST": "h", "CH_PORT": "1", "CH_USER": "u", "CH_PASS": "p",
                              "JDBC_DRIVER": "d", "JDBC_PARTITIONS": "16", "JDBC_PURCHASES_RANGE": "n,0,100"})
    o = feature_job.mart_jdbc_options(cfg, cfg.src_purchases, cfg.jdbc_purchases_range)
    assert o["url"].endswith("//h:1/retail_mart") and o["user"] == "u" and o["numPartitions"] == "16"
    assert "numPartitions" not in feature_job.mart_jdbc_options(cfg, cfg.src_customers, cfg.jdbc_customers_range)
    with pytest.raises(ValueError, match="JDBC_URL"):
        feature_job.read_marts(spark, JobConfig(source_format="jdbc"))


def test_loader_main(spark, tmp_dir):
    src, tgt = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "db")
    os.makedirs(src)
    counts = _write_collections(spark, src)
    r = loader.main({"INPUT_DIR": src, "TARGET_ROOT": tgt, "LOAD_MODE": "insert", "DROP_BEFORE_LOAD": "1"})
    assert {k: v["affected"] for k, v in r.items()} == counts
    with pytest.raises(ValueError, match="INPUT_DIR"):
        loader.main({"TARGET_ROOT": tgt})
