"""The L0 message log: batch and stream reads, restarts, stopped writes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.functions.pii import PiiHasher
from shoplens.plans import l0_publish, mart_job
from shoplens.sources import message_log as L
from shoplens.streaming import mart_stream
from shop_fixtures import documents, streams, views


def messages(spark, n, topic="t", first=0):
    return spark.range(first, first + n).selectExpr(f"'{topic}' AS topic", "concat('m', id) AS value")


def drain(stream, path, checkpoint):
    q = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def test_offsets_have_no_gaps(spark, tmp_dir):
    for n, rows in enumerate((100, 7, 50)):
        L.append(messages(spark, rows, first=1000 * n).repartition(3), tmp_dir, partitions=4)
    L.append(messages(spark, 5, "other"), tmp_dir, partitions=4)
    got = L.messages(spark, tmp_dir)
    assert got.columns == ["topic", "partition", "offset", "value"] and got.count() == 162
    per = got.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.min("offset").alias("a"), F.max("offset").alias("b"),
                                                F.count_distinct("offset").alias("d")).collect()
    assert all((r.a, r.b + 1, r.d) == (0, r.n, r.n) for r in per) and len({r.partition for r in per}) > 1
    assert {r.value for r in L.messages(spark, tmp_dir, "other").collect()} == {f"m{i}" for i in range(5)}


def test_a_stream_goes_on_where_it_stopped(spark, tmp_dir):
    log, out, at = (os.path.join(tmp_dir, x) for x in ("log", "out", "at"))
    L.append(messages(spark, 40), log)
    for n in range(3):
        drain(L.message_stream(spark, log, "t"), out, at)
        assert spark.read.parquet(out).count() == 40 + 10 * n
        L.append(messages(spark, 10, first=100 * (n + 1)), log)
        L.append(messages(spark, 3, "other"), log)
    drain(L.message_stream(spark, log, "t"), out, at)
    drain(L.message_stream(spark, log, "t"), out, at)  # nothing new
    got = spark.read.parquet(out)
    assert got.count() == got.select("value").distinct().count() == 70


def test_a_replayed_batch_is_the_same(spark, tmp_dir):
    """The batch is stopped in the middle; the restart sees the same rows, then new ones."""
    log, at = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "at")
    L.append(messages(spark, 30), log)
    seen = []

    def stop(batch, batch_id):
        seen.append((batch_id, sorted(r.value for r in batch.collect())))
        if len(seen) == 1:
            raise RuntimeError("stopped")

    for attempt in range(3):
        q = L.message_stream(spark, log).writeStream.foreachBatch(stop).option("checkpointLocation", at).trigger(availableNow=True).start()
        if attempt == 0:
            with pytest.raises(Exception, match="stopped"):
                q.awaitTermination()
            L.append(messages(spark, 5, first=500), log)  # arrives between
        else:
            q.awaitTermination()
    assert seen[0] == seen[1]
    assert [len(v) for _, v in seen[1:]] == [30, 5]


def test_stopped_and_empty_writes_are_never_read(spark, tmp_dir):
    L.append(messages(spark, 10), tmp_dir)
    bad = messages(spark, 1000).repartition(4).withColumn("value", F.expr("CASE WHEN value = 'm777' THEN raise_error('stop') ELSE value END"))
    with pytest.raises(Exception, match="stop"):
        L.append(bad, tmp_dir)
    with pytest.raises(Exception, match="without a topic"):
        L.append(spark.sql("SELECT CAST(NULL AS STRING) AS topic, 'x' AS value"), tmp_dir)
    L.append(messages(spark, 0), tmp_dir)
    assert L.messages(spark, tmp_dir).count() == 10
    L.append(spark.sql("SELECT 't' AS topic, CAST(NULL AS STRING) AS value"), tmp_dir)
    assert L.messages(spark, tmp_dir).where("value IS NULL").count() == 1


def test_an_empty_log_and_competing_writers(spark, tmp_dir):
    assert L.messages(spark, os.path.join(tmp_dir, "none")).count() == 0
    drain(L.message_stream(spark, os.path.join(tmp_dir, "none")), os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"))
    folder = L.Folder(os.path.join(tmp_dir, "log"))
    folder.add_commit(0, {"segments": [], "ends": {}})
    with pytest.raises(L.LogError):
        folder.add_commit(0, {"segments": [], "ends": {}})
    folder.add_commit(2, {"segments": [], "ends": {}})
    with pytest.raises(L.LogError):
        folder.commits()
    with pytest.raises(Exception, match="only appended"):
        L.register(spark)
        messages(spark, 1).write.format("message_log").mode("overwrite").save(tmp_dir)


def test_published_collections_become_the_mart(spark, tmp_dir):
    """The publisher's sink is the log; all four topics in one place each."""
    L.register(spark)
    collections = {"customers": documents.customer_documents(spark, SF_SMALL), "stores": documents.store_documents(spark, SF_SMALL)}
    l0_publish.run(spark, collections, PiiHasher.from_text("salt"), fmt="message_log", path=tmp_dir)
    root = os.path.join(tmp_dir, "mart")
    stream = L.message_stream(spark, os.path.join(tmp_dir, "customers"), "retail.customers.l0")
    mart_job.run_stream(spark, stream, views.FIXTURE_AS_OF, root, "customers")
    assert mart_stream.read_mart(spark, f"{root}/mart").count() == collections["customers"].count()
    assert len(streams.arrivals(spark, SF_SMALL)) == 3
