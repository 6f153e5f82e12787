"""Streams over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shop_fixtures import views


def events_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None,
                  glob: str = "events.parquet") -> DataFrame:
    """Files named by ``glob`` under ``root`` as a stream of events; new files
    are picked up by the next trigger."""
    sch = spark.read.option("pathGlobFilter", glob).parquet(root).schema
    r = spark.readStream.schema(sch).format("parquet").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    cols = [F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz"
            else F.col(f.name) for f in sch.fields]
    return r.load(root).select(*cols)


def raw_purchase_stream(spark: SparkSession, root: str, glob: str = "events.parquet") -> DataFrame:
    return views.raw_purchases_of(views.purchase_events_of(events_stream(spark, root, glob=glob)))


def republished_stream(spark: SparkSession, root: str) -> DataFrame:
    """Purchases mart rows as a stream, each sent twice."""
    ev = events_stream(spark, root).selectExpr("*", "explode(array(0, 1)) AS _copy").drop("_copy")
    return views.r_purchases_of(views.purchase_events_of(ev))


def as_documents(raw: DataFrame) -> DataFrame:
    return raw.select("purchase_id", F.struct("customer_id").alias("customer"), F.struct("store_id").alias("store"),
                      "purchase_datetime", "total_amount", "payment_method", "is_delivery")


def arrivals(spark: SparkSession, root: str) -> list[DataFrame]:
    """RAW purchase documents in three deliveries: half of the first copies;
    the other half and all re-sends (which are newer); the first copies of
    all that was re-sent once more (older than what is stored)."""
    raw = views.raw_purchases_of(views.purchase_events(spark, root), "event_id", "copy", "k")
    return [as_documents(raw.where(which)) for which in (
        "copy = 0 AND event_id % 2 = 0", "copy = 1 OR event_id % 2 = 1", "copy = 0 AND k BETWEEN 25 AND 34")]


def run_arrivals(spark: SparkSession, root: str, base: str, as_of: str) -> None:
    """One run of the mart stream after each delivery."""
    from shoplens.plans import mart_job

    for n, docs in enumerate(arrivals(spark, root)):
        docs.write.parquet(f"{base}/in/{n}")
        stream = spark.readStream.schema(docs.schema).parquet(f"{base}/in/*")
        mart_job.run_stream(spark, stream, as_of, f"{base}/out", documents=True)
