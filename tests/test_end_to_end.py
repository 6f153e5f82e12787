"""End to end: NDJSON -> loader -> L0 messages -> mart (stream and batch) -> features -> CSV."""

import os

from conftest import SF_SMALL
from shoplens.config import JobConfig
from shoplens.functions.pii import PiiHasher
from shoplens.operators import cleaning
from shoplens.operators.features import customer_feature_matrix
from shoplens.plans import feature_job, l0_publish, loader, mart_job
from shoplens.sinks.export import write_ndjson
from shoplens.streaming.mart_stream import read_mart
from shop_fixtures import documents

AS_OF = "2026-01-01 00:00:00"


def _ndjson(df, d, name):
    out = os.path.join(d, f"_{name}")
    write_ndjson(df.coalesce(1), out)
    part = [f for f in os.listdir(out) if f.endswith(".json")][0]
    os.replace(os.path.join(out, part), os.path.join(d, f"{name}.jsonl"))


def test_end_to_end(spark, tmp_dir):
    src, db, topics = (os.path.join(tmp_dir, x) for x in ("in", "db", "topics"))
    os.makedirs(src)
    docs = {"customers": documents.customer_documents(spark, SF_SMALL),
            "stores": documents.store_documents(spark, SF_SMALL),
            "products": documents.product_documents(spark, SF_SMALL),
            "purchases": documents.purchase_documents(spark, SF_SMALL)}
    for name, df in docs.items():
        _ndjson(df, src, name)
    loaded = loader.run(spark, src, db)
    assert loaded["purchases"]["affected"] == docs["purchases"].count()

    current = {n: loader.read_collection(spark, db, n) for n in docs}
    for _ in range(2):  # every document is published twice
        l0_publish.run(spark, current, PiiHasher.from_text("salt"), fmt="json", path=topics)
    with open(os.path.join(topics, "purchases", "broken.json"), "w", encoding="utf-8") as f:
        f.write('{"topic": "retail.purchases.l0", "value": "{not json"}\n')

    root = os.path.join(tmp_dir, "purchases")
    mart_job.run_stream(spark, os.path.join(topics, "purchases"), AS_OF, root)
    mart = read_mart(spark, f"{root}/mart")
    want, rejects = cleaning.clean(cleaning.flatten(docs["purchases"]), AS_OF)
    assert mart.count() == want.count() and mart.exceptAll(want).count() == 0
    assert rejects.count() == 0  # generated orders are all valid and before AS_OF
    assert [r.value for r in spark.read.parquet(f"{root}/malformed").collect()] == ["{not json"]

    batch_mart, batch_rej = os.path.join(tmp_dir, "bmart"), os.path.join(tmp_dir, "brej")
    mart_job.run_batch(docs["purchases"], AS_OF, batch_mart, batch_rej)
    assert spark.read.parquet(batch_mart).drop("purchase_month").exceptAll(want).count() == 0

    root = os.path.join(tmp_dir, "customers")
    mart_job.run_stream(spark, os.path.join(topics, "customers"), AS_OF, root, "customers")
    customers = read_mart(spark, f"{root}/mart")
    matrix = customer_feature_matrix(customers, mart, as_of=AS_OF)
    assert matrix.count() == matrix.select("customer_id").distinct().count() == docs["customers"].count()
    res = feature_job.run(spark, JobConfig(target_root=os.path.join(tmp_dir, "wh"), tgt_db="e2e", as_of=AS_OF,
                                           csv_root=os.path.join(tmp_dir, "s3")), customers, mart)
    assert res["rows"] == matrix.count()
    assert spark.read.option("header", True).csv(res["csv"]).count() == matrix.count()
