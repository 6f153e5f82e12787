"""Target table for the feature matrix.

The matrix is written by executors, with the load stamp set at write time. Rows
are clustered by ``customer_id``: each file of a load holds a range of ids, with
a Bloom filter, so that a lookup of one customer opens one file of a load and
skips its other row groups.

Every load has a run id and leaves a manifest: its files, row count and stamp.
Files are written aside, moved into the table's folder under names that begin
with the run id, and become the run's by its manifest, which is written last. A
load that is repeated under its run id is done already, or clears what a stopped
attempt left and starts over: one copy stays. ``read_target`` and the CSV export
take files by manifest. The catalog's table lists the folder, so it may show a
load's files a moment early, until its manifest is there or it is repeated.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shoplens.config import JobConfig
from shoplens.schemas import MATRIX_COLUMNS, MATRIX_DDL, schema
from shoplens.session import remove_path
from shoplens.sinks import snapshot

TARGET_DDL = f"{MATRIX_DDL}, etl_loaded_at TIMESTAMP"


def target_path(spark: SparkSession, cfg: JobConfig) -> str:
    if not cfg.target_root:
        raise ValueError("TARGET_ROOT is required: the folder of the target database")
    return f"{cfg.target_root.rstrip('/')}/{cfg.tgt_db}/{cfg.tgt_table}"


def check_schema(df: DataFrame) -> None:
    """K3: the result must have the target's columns, order and types."""
    want = schema(MATRIX_DDL)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    exp = [(f.name, f.dataType.simpleString()) for f in want.fields]
    if got != exp:
        raise ValueError(f"matrix schema mismatch: {got} != {exp}")


# ------------------------------------------------------------------ manifests
def runs(spark: SparkSession, path: str) -> dict[str, dict]:
    """Manifests of the complete loads, by run id, oldest first."""
    found = [json.loads(snapshot.read_text(spark, f"{path}/_runs/{name}"))
             for name in snapshot.names(spark, f"{path}/_runs") if name.endswith(".json")]
    return {m["run_id"]: m for m in sorted(found, key=lambda m: (m["loaded_at"], m["run_id"]))}


def read_target(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The rows of all complete loads, or of one."""
    have = runs(spark, path)
    files = [f"{path}/{f}" for m in ([have[run_id]] if run_id is not None else have.values()) for f in m["files"]]
    return spark.read.schema(TARGET_DDL).parquet(*files) if files else spark.createDataFrame([], TARGET_DDL)


def lookup(spark: SparkSession, path: str, customer_id: str) -> DataFrame:
    """A customer's rows of all complete loads; of each, only the files whose
    range of ids holds the customer are opened."""
    files = [f"{path}/{f}" for m in runs(spark, path).values() for f, (low, high) in m["ranges"].items()
             if low is not None and low <= customer_id <= high]
    rows = spark.read.schema(TARGET_DDL).parquet(*files) if files else spark.createDataFrame([], TARGET_DDL)
    return rows.where(F.col("customer_id") == customer_id)


def _clear(spark: SparkSession, path: str, keep: set[str]) -> None:
    """Removes manifests of other runs, then files of no kept run."""
    for name in snapshot.names(spark, f"{path}/_runs"):
        if name.removesuffix(".json") not in keep:
            remove_path(spark, f"{path}/_runs/{name}")
    for name in snapshot.names(spark, path):
        if not name.startswith(("_", ".")) and name.partition("-")[0] not in keep:
            remove_path(spark, f"{path}/{name}")


def write_matrix(spark: SparkSession, matrix: DataFrame, cfg: JobConfig, path: str | None = None,
                 run_id: str | None = None) -> dict:
    """K4/K5/K6/K8: one load, by default under a new run id. With
    ``truncate_before_load`` it replaces all others once it is complete."""
    check_schema(matrix.select(*MATRIX_COLUMNS))
    path = (path or target_path(spark, cfg)).rstrip("/")
    run_id = (run_id or cfg.run_id or uuid.uuid4().hex).replace("-", "_")
    done = runs(spark, path).get(run_id)
    if done is None:
        done = _load(spark, matrix, path, run_id)
    if cfg.truncate_before_load:
        _clear(spark, path, {run_id})
    return {"target": cfg.target, "path": path, "rows": done["rows"], "run_id": run_id,
            "mode": "overwrite" if cfg.truncate_before_load else "append"}


def _load(spark: SparkSession, matrix: DataFrame, path: str, run_id: str) -> dict:
    for name in snapshot.names(spark, path):  # of a stopped attempt
        if name.startswith(f"{run_id}-"):
            remove_path(spark, f"{path}/{name}")
    aside = f"{path}/_loading/{run_id}"
    obs = Observation("matrix_load")
    (matrix.withColumn("etl_loaded_at", F.current_timestamp())
     .repartitionByRange("customer_id").sortWithinPartitions("customer_id")
     .observe(obs, F.count(F.lit(1)).alias("rows"), F.max("etl_loaded_at").cast("string").alias("loaded_at"))
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#customer_id", "true").parquet(aside))
    ids = (spark.read.schema(TARGET_DDL).parquet(aside).groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
           .agg(F.min("customer_id").alias("low"), F.max("customer_id").alias("high")))
    ranges = {f"{run_id}-{unquote(r.file)}": [r.low, r.high] for r in ids.collect()}  # two ids for each file of the load
    parts = sorted(n for n in snapshot.names(spark, aside) if n.startswith("part-"))
    files = [f"{run_id}-{n}" for n in parts]
    for old, new in zip(parts, files):
        snapshot.move(spark, f"{aside}/{old}", f"{path}/{new}")
    seen = obs.get
    manifest = {"run_id": run_id, "files": files, "ranges": ranges, "rows": seen.get("rows", 0) or 0, "loaded_at": seen.get("loaded_at") or ""}
    snapshot.write_text(spark, f"{path}/_runs/{run_id}.json", json.dumps(manifest))
    remove_path(spark, aside)
    return manifest


def ensure_target_table(spark: SparkSession, cfg: JobConfig, path: str | None = None) -> str:
    """K3: register the target in the catalog if absent (fixed schema)."""
    path = path or target_path(spark, cfg)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.tgt_db} LOCATION '{path.rpartition('/')[0]}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {cfg.target} ({TARGET_DDL}) USING parquet LOCATION '{path}'")
    return cfg.target
