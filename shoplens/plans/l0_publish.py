"""Entry point 2: collections -> PII policy -> one JSON message per row (L0).

Each collection is one ``select`` (S3 -> P7 -> K2), written by executors
to the topic sink; a rerun republishes everything, which is why the
cleaning stage deduplicates and the duplicate alert exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.functions.pii import PiiHasher
from shoplens.operators.pii import PII_POLICY, protect
from shoplens.schemas import L0_TOPICS
from shoplens.sinks.export import publish, to_messages


def l0_messages(collections: dict[str, DataFrame], hasher: PiiHasher) -> dict[str, DataFrame]:
    return {name: to_messages(protect(df, name, hasher, PII_POLICY), name, L0_TOPICS)
            for name, df in collections.items()}


def run(spark: SparkSession, collections: dict[str, DataFrame], hasher: PiiHasher,
        fmt: str = "kafka", options: dict[str, str] | None = None, path: str | None = None) -> dict[str, str]:
    """Publish every collection; ``fmt="kafka"`` needs the connector jar and
    ``kafka.bootstrap.servers`` in ``options``; file formats take ``path``."""
    done = {}
    for name, msgs in l0_messages(collections, hasher).items():
        publish(msgs, fmt=fmt, options=options, path=None if path is None else f"{path}/{name}")
        done[name] = L0_TOPICS[name]
    return done


def main(env: dict[str, str] | None = None) -> dict[str, str]:
    """``python -m shoplens.plans.l0_publish`` with SOURCE_ROOT (loaded
    collections), PII_SALT, PII_ALGO, SINK_FORMAT and KAFKA_BOOTSTRAP or
    SINK_PATH. Documents are published with all their fields."""
    from shoplens.config import PublishConfig
    from shoplens.plans.loader import read_collection
    from shoplens.session import get_session

    cfg = PublishConfig.from_env(env)
    spark = get_session("l0_publish")
    found = {name: read_collection(spark, cfg.source_root, name) for name in L0_TOPICS}
    options = {"kafka.bootstrap.servers": cfg.bootstrap} if cfg.bootstrap else None
    done = run(spark, {k: v for k, v in found.items() if v is not None}, PiiHasher.from_text(cfg.salt, cfg.algorithm),
               cfg.sink_format, options, cfg.path)
    print(done)
    return done


if __name__ == "__main__":
    main()
