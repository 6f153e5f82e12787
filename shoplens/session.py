"""Spark session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall-clock semantics, ANSI arithmetic,
# adaptive execution (coalesce, skew-join split, runtime join choice).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app_name: str = "shoplens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster leave ``master`` unset so spark-submit decides. Shuffle
    partitions default to Spark's own value; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate() on an existing session ignores builder options for
    # runtime SQL settings only in some paths; set them explicitly.
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on shared storage for checkpoints, stream state and snapshots.

    Uses the cluster's ``spark.checkpoint.dir``. Only when it is unset and
    the session runs in local mode (tests) is a fresh scratch folder created
    and registered; on a cluster a machine-local folder would not survive an
    executor loss, so an unset setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        d = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core setting may be read-only at runtime
            pass
    else:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read back, for as long as the
    block lasts; its size is then known to Spark."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)
