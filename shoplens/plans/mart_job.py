"""RAW -> MART stage for purchases and customers: documents (batch) or L0
messages (stream) -> flatten -> checks -> case -> latest per key -> mart +
rejects. Batch and stream give the same mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.operators import cleaning
from shoplens.schemas import DOCUMENT_SCHEMAS, L0_TOPICS, schema
from shoplens.session import scratch_table
from shoplens.sinks.export import write_purchases_mart
from shoplens.streaming import mart_stream as S

RULES = {"purchases": cleaning.PURCHASE_RULES, "customers": cleaning.CUSTOMER_RULES}


def run_batch(raw_docs: DataFrame, as_of, mart_path: str, rejects_path: str, collection: str = "purchases") -> None:
    """RAW is scanned, flattened and checked once; the checked rows are then
    split into mart and rejects."""
    rules = RULES[collection]
    checked = cleaning.with_reasons(cleaning.flatten(raw_docs, rules), as_of, rules)
    with scratch_table(checked, "checked-raw") as rows:
        mart = cleaning.deduplicated(cleaning.to_mart(rows.where("reject_reason IS NULL"), rules), rules)
        if collection == "purchases":
            write_purchases_mart(mart, mart_path)
        else:
            mart.write.mode("overwrite").parquet(mart_path)
        rows.where("reject_reason IS NOT NULL").write.mode("overwrite").parquet(rejects_path)


def run_stream(spark: SparkSession, messages: DataFrame | str, as_of, root: str, collection: str = "purchases",
               documents: bool = False) -> None:
    """One ``availableNow`` run over new messages; restartable from
    ``{root}/checkpoint`` (on shared storage). ``messages``: a folder of L0
    message files or a stream of (topic, value), e.g. ``S.kafka_messages``;
    with ``documents`` a stream of typed documents. Writes ``{root}/mart`` (a
    keyed table, read by ``S.read_mart``), ``rejects``, ``malformed``, ``counts`` and ``alerts``."""
    if isinstance(messages, str):
        messages = S.file_messages(spark, messages, topic=L0_TOPICS[collection])
    fn = S.mart_batches(
        spark, as_of, RULES[collection], f"{root}/mart", f"{root}/rejects",
        value_schema=None if documents else schema(DOCUMENT_SCHEMAS[collection]),
        malformed_path=None if documents else f"{root}/malformed",
        counts_path=f"{root}/counts", alerts_path=f"{root}/alerts")
    S.run_foreach_batch(messages, fn, f"{root}/checkpoint")
