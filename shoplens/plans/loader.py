"""Entry point 3: NDJSON files -> validated keyed load into snapshot tables.

The whole input is checked (syntax, ids, key collisions in insert mode)
before anything is written, so a bad line or a collision leaves the
target untouched. Upsert replaces whole documents by key, with every field
they have; statistics follow the document store's meaning (affected =
inserted + matched, modified = really changed). With ``drop`` the batch is
checked and loaded against an empty collection and published as one version:
the old one stays live until then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import LoaderConfig
from shoplens.operators import upsert
from shoplens.schemas import COLLECTION_FILES, COLLECTION_KEYS
from shoplens.session import scratch_table
from shoplens.sinks import snapshot
from shoplens.sources.ndjson import DOCUMENT, read_collections, typed_collection, validate_ndjson

MODES = ("upsert", "insert")


def _base(spark: SparkSession, root: str, key: str, drop: bool) -> DataFrame:
    base = None if drop else snapshot.read_current(spark, root)
    return spark.createDataFrame([], f"`{key}` STRING, {DOCUMENT} STRING") if base is None else base


def check_collection(spark: SparkSession, name: str, batch: DataFrame, target_root: str,
                     mode: str = "upsert", drop: bool = False) -> None:
    """Ids present and, for insert mode, no key collision."""
    if mode not in MODES:
        raise ValueError(f"Unknown mode: {mode}")
    key = COLLECTION_KEYS[name]
    upsert.assert_ids_present(batch, key, name)
    if mode == "insert":
        upsert.assert_insertable(_base(spark, f"{target_root.rstrip('/')}/{name}", key, drop), batch, [key])


def load_collection(spark: SparkSession, name: str, batch: DataFrame, target_root: str,
                    mode: str = "upsert", drop: bool = False, checked: bool = False) -> dict:
    if not checked:
        check_collection(spark, name, batch, target_root, mode, drop)
    key = COLLECTION_KEYS[name]
    root = f"{target_root.rstrip('/')}/{name}"
    base = _base(spark, root, key, drop)
    if mode == "insert":
        with scratch_table(batch.select(key, DOCUMENT), "insert-batch") as rows:
            snapshot.publish_snapshot(spark, base.unionByName(rows), root)
            return {"affected": rows.count(), "modified": 0}
    # Later lines win over earlier ones for the same key.
    numbered = batch.withColumn("_seq", F.struct("file", "line")).drop("file", "line")
    with scratch_table(upsert.latest(base, numbered, [key], "_seq"), "upsert-batch") as rows:
        s = upsert.stats_settled(base, rows, [key]).first()
        snapshot.publish_snapshot(spark, upsert.upsert_settled(base, rows, [key]), root)
    return {"affected": s["affected"], "modified": s["modified"]}


def read_collection(spark: SparkSession, target_root: str, name: str) -> DataFrame | None:
    """A loaded collection with its declared and all other fields."""
    rows = snapshot.read_current(spark, f"{target_root.rstrip('/')}/{name}")
    return None if rows is None else typed_collection(rows, name)


def run(spark: SparkSession, input_dir: str, target_root: str, mode: str = "upsert",
        drop: bool = False) -> dict[str, dict]:
    """Load all four collections; ``drop`` reloads from empty.

    Every file is checked (JSON syntax with line numbers, ids, and in
    insert mode key collisions) before the first write, so a bad last file
    leaves all collections untouched."""
    batches = read_collections(spark, input_dir, COLLECTION_FILES)
    for name, batch in batches.items():
        validate_ndjson(spark, f"{input_dir.rstrip('/')}/{COLLECTION_FILES[name]}")
        check_collection(spark, name, batch, target_root, mode, drop)
    return {name: load_collection(spark, name, batch, target_root, mode, drop, checked=True)
            for name, batch in batches.items()}


def main(env: dict[str, str] | None = None) -> dict[str, dict]:
    """``python -m shoplens.plans.loader`` with INPUT_DIR, TARGET_ROOT,
    LOAD_MODE (upsert, insert) and DROP_BEFORE_LOAD (1)."""
    from shoplens.session import get_session

    cfg = LoaderConfig.from_env(env)
    result = run(get_session("collection_loader"), cfg.input_dir, cfg.target_root, cfg.mode, cfg.drop)
    for name, stats in result.items():
        print(f"{name}: {stats}")
    return result


if __name__ == "__main__":
    main()
