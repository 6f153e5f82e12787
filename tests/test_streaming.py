"""availableNow streams over growing input; restart without loss or double count."""

import os

import pyarrow.parquet as pq

from conftest import SF_SMALL
from shoplens.operators import cleaning
from shoplens.sinks import keyed
from shop_fixtures import streams, views as fixtures
from shoplens.streaming import mart_stream as S

AS_OF = fixtures.FIXTURE_AS_OF


def _split_events(src_dir, dst):
    t = pq.read_table(f"{SF_SMALL}/events.parquet")
    half = t.num_rows // 2
    os.makedirs(dst, exist_ok=True)
    return t.slice(0, half), t.slice(half)


def _batch_accepted(spark, root):
    raw = fixtures.raw_purchases_of(fixtures.purchase_events_of(
        spark.read.parquet(root).selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id",
                                            "event_type", "value", "props")))
    return cleaning.accepted(raw, AS_OF), cleaning.clean(raw, AS_OF)[0]


def test_clean_stream_restart_no_loss_no_double_count(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a, b = _split_events(SF_SMALL, src)
    pq.write_table(a, os.path.join(src, "a.parquet"))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")

    def run():
        S.run_to_table(S.clean_stream(streams.raw_purchase_stream(spark, src, glob="*.parquet"), AS_OF), out, ckpt)
        return spark.read.parquet(out)

    first = run()
    acc_a, _ = _batch_accepted(spark, src)
    assert first.count() == acc_a.count()
    pq.write_table(b, os.path.join(src, "b.parquet"))
    second = run()
    acc_ab, _ = _batch_accepted(spark, src)
    assert second.count() == acc_ab.count()
    assert second.exceptAll(acc_ab).count() == 0 and acc_ab.exceptAll(second).count() == 0
    run()  # nothing new: no change
    assert spark.read.parquet(out).count() == acc_ab.count()


def test_dedup_stream_keeps_one_row_per_key(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a, _ = _split_events(SF_SMALL, src)
    pq.write_table(a, os.path.join(src, "a.parquet"))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    rows = S.dedup_stream(S.clean_stream(streams.raw_purchase_stream(spark, src, glob="*.parquet"), AS_OF))
    S.run_to_table(rows, out, ckpt)
    got = spark.read.parquet(out)
    _, mart = _batch_accepted(spark, src)
    assert got.count() == got.select("purchase_id").distinct().count()
    assert {r[0] for r in got.select("purchase_id").collect()} == {r[0] for r in mart.select("purchase_id").collect()}


def test_foreach_batch_upsert_equals_batch_mart(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a, b = _split_events(SF_SMALL, src)
    pq.write_table(a, os.path.join(src, "a.parquet"))
    snap_root, ckpt = os.path.join(tmp_dir, "mart"), os.path.join(tmp_dir, "ckpt")

    def run():
        stream = S.clean_stream(streams.raw_purchase_stream(spark, src, glob="*.parquet"), AS_OF)
        S.run_foreach_batch(stream, S.upsert_batches(spark, snap_root), ckpt)

    run()
    pq.write_table(b, os.path.join(src, "b.parquet"))
    run()
    got = S.read_mart(spark, snap_root)
    _, mart = _batch_accepted(spark, src)
    assert got.count() == mart.count()
    assert got.exceptAll(mart).count() == 0
    # a replayed batch id is skipped (idempotent sink)
    before = keyed.open_table(spark, snap_root)
    S.upsert_batches(spark, snap_root)(mart.limit(1), int(before.tag))
    assert keyed.open_table(spark, snap_root) == before


def test_alert_stream_writes_no_alert_below_threshold(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a, _ = _split_events(SF_SMALL, src)
    pq.write_table(a, os.path.join(src, "a.parquet"))
    alerts = os.path.join(tmp_dir, "alerts")
    stream = streams.raw_purchase_stream(spark, src, glob="*.parquet").where("purchase_id IS NOT NULL")
    S.run_foreach_batch(stream, S.alert_batches(spark, os.path.join(tmp_dir, "counts"), alerts), os.path.join(tmp_dir, "ckpt"))
    assert spark.read.parquet(alerts).count() == 0


def test_l0_messages_to_mart_stream(spark, tmp_dir):
    """Publisher -> message files -> stream -> from_json -> flattened mart."""
    from shoplens.functions.pii import PiiHasher
    from shoplens.operators.pii import protect
    from shoplens.schemas import PURCHASES_DDL, schema
    from shoplens.sinks.export import publish, to_messages
    from shop_fixtures import documents

    docs = documents.purchase_documents(spark, SF_SMALL)
    msgs = to_messages(protect(docs, "purchases", PiiHasher.from_text("salt")), "purchases")
    topic_dir = os.path.join(tmp_dir, "topic")
    publish(msgs, fmt="json", path=topic_dir)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    stream = S.documents_of(S.file_messages(spark, topic_dir, topic="retail.purchases.l0"), schema(PURCHASES_DDL))
    S.run_to_table(cleaning.purchases_mart(stream), out, ckpt)
    got = spark.read.parquet(out)
    want = cleaning.purchases_mart(docs)
    assert got.count() == want.count() == docs.count()
    assert got.exceptAll(want).count() == 0


def test_watermark_dedup_late_rows(spark, tmp_dir):
    """ST2 late data (measured Spark behaviour): the re-sent copy of x is
    dropped while x's state is alive; z, a new key behind the watermark, is
    kept (no row is lost)."""
    import datetime as dt

    import pyarrow as pa

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    sch = pa.schema([("purchase_id", pa.string()), ("purchase_datetime", pa.timestamp("us"))])
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    first = pa.table({"purchase_id": ["x", "x", "y"],
                      "purchase_datetime": [t0, t0 + dt.timedelta(minutes=5), t0 + dt.timedelta(days=20)]}, schema=sch)
    second = pa.table({"purchase_id": ["x", "z"], "purchase_datetime": [t0, t0 + dt.timedelta(hours=1)]}, schema=sch)
    pq.write_table(first, os.path.join(src, "1.parquet"))
    pq.write_table(second, os.path.join(src, "2.parquet"))
    stream = (spark.readStream.schema("purchase_id STRING, purchase_datetime TIMESTAMP")
              .option("maxFilesPerTrigger", "1").parquet(src))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    S.run_to_table(S.dedup_stream(stream, delay="2 hours"), out, ckpt)
    got = sorted(r.purchase_id for r in spark.read.parquet(out).collect())
    assert got == ["x", "y", "z"]


def test_purchase_documents_delivery_address_only_when_delivered(spark):
    from shop_fixtures import documents

    d = documents.purchase_documents(spark, SF_SMALL)
    assert d.where("is_delivery AND delivery_address IS NULL").count() == 0
    assert d.where("NOT is_delivery AND delivery_address IS NOT NULL").count() == 0
    assert d.where("is_delivery").count() > 0 and d.where("NOT is_delivery").count() > 0


def test_alert_stream_fires_above_threshold(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    a, _ = _split_events(SF_SMALL, src)
    for i in range(3):  # the same events re-published three times: 2/3 duplicates
        pq.write_table(a, os.path.join(src, f"copy{i}.parquet"))
    alerts = os.path.join(tmp_dir, "alerts")
    stream = streams.raw_purchase_stream(spark, src, glob="*.parquet").where("purchase_id IS NOT NULL")
    S.run_foreach_batch(stream, S.alert_batches(spark, os.path.join(tmp_dir, "counts"), alerts), os.path.join(tmp_dir, "ckpt"))
    got = spark.read.parquet(alerts).collect()
    assert len(got) == 1 and got[0].dup_ratio > 0.5 and got[0].batch_id == 0


def test_a_republish_in_a_later_batch_raises_the_alert(spark, tmp_dir):
    alerts, counts = os.path.join(tmp_dir, "alerts"), os.path.join(tmp_dir, "counts")
    fn = S.alert_batches(spark, counts, alerts)
    batch = spark.range(50).selectExpr("concat('p', id) AS purchase_id")
    for n in range(3):
        fn(batch, n)
    fn(batch, 2)  # a replayed batch is not counted twice
    got = {r.batch_id: r.dup_ratio for r in spark.read.parquet(alerts).collect()}
    assert set(got) == {2} and abs(got[2] - 2 / 3) < 1e-9


def test_newer_resend_wins_in_any_order_and_bad_messages_are_kept(spark, tmp_dir):
    import json

    from shoplens.plans import mart_job

    topic, root = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "out")
    os.makedirs(topic)

    def send(name, *values):
        with open(os.path.join(topic, name), "w", encoding="utf-8") as f:
            for v in values:
                f.write(json.dumps({"topic": "retail.purchases.l0", "value": v if isinstance(v, str) else json.dumps(v)}) + "\n")
        mart_job.run_stream(spark, topic, AS_OF, root)

    def doc(hour, method, **more):
        return {"purchase_id": "x", "customer": {"customer_id": "c"}, "store": {"store_id": "s"}, "total_amount": 1.0,
                "purchase_datetime": f"2024-01-01T{hour:02d}:00:00Z", "payment_method": method, "is_delivery": True, **more}

    send("1.json", doc(10, "cash"), "{broken", doc(9, "cash", purchase_id=None))
    send("2.json", doc(11, "card"))
    send("3.json", doc(8, "cash"))
    got = S.read_mart(spark, f"{root}/mart").collect()
    assert [(r.purchase_id, r.payment_method, r.purchase_datetime.hour) for r in got] == [("x", "card", 11)]
    assert [r.value for r in spark.read.parquet(f"{root}/malformed").collect()] == ["{broken"]
    assert [r.reject_reason for r in spark.read.parquet(f"{root}/rejects").collect()] == ["null"]
