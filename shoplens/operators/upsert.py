"""Keyed load: upsert (replace whole row by key), insert-or-fail, checks.

Without a transactional table format an upsert writes a *new* snapshot
(``base`` minus updated keys, plus the updates); the sink then switches a
pointer to it. The path being read is never overwritten.

A batch is collapsed to one row per key and written once to the shared folder
(``settled``), so that every later use reads files whose size Spark knows: its
own broadcast threshold then decides whether the base is streamed against the
batch or both sides are shuffled. Nothing is counted or hinted here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.dedup import keep_max
from shoplens.session import scratch_path, scratch_table


class KeyError_(ValueError):
    """A required key is missing or collides."""


def last_wins(updates: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    """Collapse repeated keys in one batch: the highest ``seq`` wins (then
    the greatest full row). Without ``seq`` the greatest full row wins."""
    return keep_max(updates, keys, [seq] if seq else [], keep_null_keys=False)


def settled(df: DataFrame, name: str = "batch") -> DataFrame:
    """``df`` written to the shared folder and read back. The lazy forms below
    need it for as long as their result is used, so the file stays; jobs that
    write their result at once use ``session.scratch_table`` instead."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled_batch(base: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """The batch's latest row per key, with the base's columns, settled."""
    return settled(latest(base, updates, keys, seq), "upsert-batch")


def latest(base: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """The batch's latest row per key, with the base's columns."""
    return last_wins(updates, keys, seq).select(*base.columns)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """New snapshot = base rows whose key is not updated + latest updates.

    If ``seq`` is a column of the base, it decides between the base's row and
    the batch's row too: an older row that arrives late does not replace a
    newer one. Otherwise a batch replaces what it touches."""
    return upsert_settled(base, settled_batch(base, updates, keys, seq), keys, seq)


def upsert_settled(base: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """``upsert`` with a batch from ``settled_batch``."""
    keys = list(keys)
    touched = batch.select(*keys)
    winners = batch
    if seq is not None and seq in base.columns:
        winners = keep_max(batch.unionByName(base.join(touched, keys, "left_semi")), keys, [seq], keep_null_keys=False)
    return base.join(touched, keys, "left_anti").unionByName(winners)


def upsert_stats(base: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """One row of counts. ``affected`` = inserted + matched; ``modified``
    = matched rows whose values really changed (NULL-safe compare)."""
    return stats_settled(base, settled_batch(base, updates, keys, seq), keys)


def stats_settled(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert_stats`` with a batch from ``settled_batch``: the base is
    scanned once and left-joined to the batch; counts are combined by one
    global partial aggregate."""
    keys = list(keys)
    vals = [c for c in base.columns if c not in keys]
    new = batch.select(*keys, F.lit(True).alias("_hit"), F.struct(*vals).alias("_new"))
    zero = F.lit(0).cast("bigint")
    of_base = base.select(*keys, F.struct(*vals).alias("_old")).join(new, keys, "left").agg(
        F.count("_hit").alias("m"), F.count_if(F.col("_hit") & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("d"),
        F.count(F.lit(1)).alias("nb"), zero.alias("nu"))
    of_batch = batch.agg(zero.alias("m"), zero.alias("d"), zero.alias("nb"), F.count(F.lit(1)).alias("nu"))
    total = of_base.unionByName(of_batch).agg(*[F.sum(c).alias(c) for c in ("m", "d", "nb", "nu")])
    return total.selectExpr("nu - m AS inserted", "m AS matched", "d AS modified", "nb - m AS untouched",
                            "nu AS affected")


def insert_conflicts(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys an insert-only load would reject: already in ``base``
    ('exists') or repeated inside the batch ('duplicate_in_batch').

    The base is scanned once, against the batch's settled keys."""
    return _conflicts(base, settled(_copies(batch, keys), "insert-keys"), keys)


def _copies(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def _conflicts(base: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    exists = (base.select(*keys).join(counts.select(*keys), keys, "left_semi").distinct()
              .select(*keys, F.lit("exists").alias("reason")))
    dup = counts.where(F.col("copies") > 1).select(*keys, F.lit("duplicate_in_batch").alias("reason"))
    return exists.unionByName(dup)


def assert_insertable(base: DataFrame, batch: DataFrame, keys: Sequence[str], sample: int = 3) -> None:
    """Fail the whole load before writing anything, naming up to ``sample``
    conflicts (the check runs on executors; only the sample reaches the driver)."""
    with scratch_table(_copies(batch, keys), "insert-keys") as counts:
        bad = _conflicts(base, counts, keys).limit(sample).collect()
    if bad:
        raise KeyError_(f"insert would collide on {len(bad)}+ keys; first: {[r.asDict() for r in bad]}")


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U4: keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def missing_ids(df: DataFrame, key: str, collection: str) -> DataFrame:
    """One row per collection: rows without the key field."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("missing"),
                  F.count(F.lit(1)).alias("rows")).select(
        F.lit(collection).alias("collection"), F.lit(key).alias("key_field"), "missing", "rows")


def assert_ids_present(df: DataFrame, key: str, collection: str) -> None:
    if key not in df.columns:
        raise KeyError_(f"documents of collection {collection!r} have no id field {key!r}")
    n = df.where(F.col(key).isNull()).limit(1).count()
    if n:
        raise KeyError_(f"document missing id field {key!r} in collection {collection!r}")
