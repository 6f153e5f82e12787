"""Continuous RAW -> MART cleaning (ST1-ST4).

Source: the L0 topic (``format("kafka")``, JSON in ``value``) or message files
with the same rows. A micro-batch is cleaned and upserted into the mart
(a keyed table, merged on read): of two copies the later one by event time
stays, in whichever order and batch they arrive, so the stream's mart equals the
batch mart, and a batch costs what the batch holds, not the mart. Rejected rows
and malformed messages go to a quarantine. The duplicate ratio runs over totals
that each batch adds to, with a keyed table of the keys seen. Every output of a
batch carries its batch id, so a replayed batch changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.operators import cleaning, monitor
from shoplens.operators.cleaning import Cleaning
from shoplens.session import scratch_table
from shoplens.sinks import keyed
from shoplens.sources.ndjson import is_object

DEFAULT_WATERMARK = "2 hours"


# ------------------------------------------------------------------ sources
def kafka_messages(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """(topic, value) of an L0 topic (needs the Kafka connector)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets).load())
    return raw.select("topic", F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, fmt: str = "json", topic: str | None = None,
                  max_files: int | None = None) -> DataFrame:
    """S5 over files: L0 messages ``(topic, value)`` as the publisher writes them."""
    reader = spark.readStream.schema("topic STRING, value STRING").format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    msgs = reader.load(path)
    return msgs if topic is None else msgs.where(F.col("topic") == topic)


def documents_of(messages: DataFrame, value_schema: StructType) -> DataFrame:
    """Documents of the messages that are JSON objects."""
    return (messages.where(is_object(F.col("value")))
            .select(F.from_json("value", value_schema).alias("v")).select("v.*"))


def malformed(messages: DataFrame) -> DataFrame:
    """Messages that are not a JSON object, as they came."""
    return messages.where(~is_object(F.col("value"))).select("topic", "value")


# ------------------------------------------------------- stateless and dedup
def clean_stream(raw: DataFrame, as_of, rules: Cleaning = cleaning.PURCHASE_RULES) -> DataFrame:
    """ST1: checks + case normalisation per row (stateless)."""
    return cleaning.accepted(raw, as_of, rules)


def dedup_stream(mart_rows: DataFrame, key: str = "purchase_id", event_time: str = "purchase_datetime",
                 delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """ST2, for feeds whose copies are equal: keep the first copy of each key.
    A key's state lives until the watermark passes its event time + ``delay``
    and is then evicted, so state stays bounded. Late rows are not discarded: a
    row with a new key is kept even when its event time is behind the
    watermark, and a copy is dropped while its key's state is alive. A copy
    arriving after the state was evicted would be kept again: pick ``delay`` to
    cover re-sends. Where a re-send may be newer, use ``mart_batches``, which
    keeps the latest."""
    return mart_rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ------------------------------------------------------------- batch outputs
Batch = Callable[[DataFrame, int], None]


def upsert_batches(spark: SparkSession, root: str, rules: Cleaning = cleaning.PURCHASE_RULES, buckets: int = 16) -> Batch:
    """ST3: upserts a micro-batch of mart rows into a keyed table; a stored row
    that is newer than the batch's stays. The batch id is stored with the
    pointer, so a replayed batch is skipped."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        table = keyed.open_table(spark, root)
        if table is None:
            table = keyed.create(spark, root, batch.schema, rules.key, rules.latest, buckets, newest_wins=False)
        elif int(table.tag) >= batch_id:
            return
        table.upserted(batch).commit(str(batch_id))
    return fn


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    """The mart that ``upsert_batches`` keeps under ``root``."""
    return keyed.open_table(spark, root).read()


def _write_once(rows: DataFrame, path: str, batch_id: int) -> None:
    """A batch's rows in a folder of its own, replaced if the batch comes again."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def quarantine_batches(path: str) -> Batch:
    """Rejected rows or malformed messages, by batch."""
    return lambda rows, batch_id: _write_once(rows, path, batch_id)


def alert_batches(spark: SparkSession, counts_path: str, alerts_path: str, key: str = "purchase_id",
                  table: str = "purchases", buckets: int = 16) -> Batch:
    """ST4: the duplicate ratio over everything that has arrived so far. The
    keys seen are a keyed table that carries the totals; a batch asks its
    filters which of its keys are new and adds these, so its cost does not
    depend on how many came before. Alert rows are kept by batch."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        seen = keyed.open_table(spark, counts_path)
        state = json.loads(seen.tag) if seen is not None else {"batch": -1, "rows": 0, "keys": 0}
        if state["batch"] < batch_id:
            if seen is None:
                seen = keyed.create(spark, counts_path, batch.select(key).schema, [key], buckets=buckets)
            counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
            with scratch_table(counts, "batch-keys") as keys:
                new = keys.join(seen.lookup(keys), key, "left_anti").select(key)
                total = keys.agg(F.expr("coalesce(sum(copies), 0) AS n")).first().n
                seen = seen.upserted(new)
                state = {"batch": batch_id, "rows": state["rows"] + total, "keys": sum(r.rows for r in seen.runs)}
                seen.commit(json.dumps(state))
        rows = spark.createDataFrame([(state["rows"], state["keys"])], "rows LONG, distinct_keys LONG")
        _write_once(monitor.duplicate_alert(monitor.ratio_of_totals(rows, table)), alerts_path, batch_id)
    return fn


def mart_batches(spark: SparkSession, as_of, rules: Cleaning, mart_root: str, rejects_path: str,
                 value_schema: StructType | None = None, malformed_path: str | None = None,
                 counts_path: str | None = None, alerts_path: str | None = None) -> Batch:
    """A whole micro-batch: messages (with ``value_schema``) or documents ->
    rejects, counts and alerts, mart. The mart comes last: its pointer marks
    the batch as done."""
    put = upsert_batches(spark, mart_root, rules)

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if malformed_path is not None:
                quarantine_batches(malformed_path)(malformed(batch), batch_id)
            docs = batch if value_schema is None else documents_of(batch, value_schema)
            raw = cleaning.flatten(docs, rules)
            quarantine_batches(rejects_path)(cleaning.rejected(raw, as_of, rules), batch_id)
            if alerts_path is not None:
                alert_batches(spark, counts_path, alerts_path, rules.key[0])(
                    raw.where(F.col(rules.key[0]).isNotNull()), batch_id)
            put(cleaning.accepted(raw, as_of, rules), batch_id)
        finally:
            batch.unpersist()
    return fn


def run_foreach_batch(stream: DataFrame, fn: Batch, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
