"""File exports (K1, K7) and topic messages (K2).

Everything is written by executors; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.schemas import L0_TOPICS
from shoplens.session import remove_path, scratch_path, scratch_table


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1: one JSON object per line, UTF-8, non-ASCII kept as is."""
    df.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", "false").json(path)


def export_csv(df: DataFrame, root: str, year: int, month: int, single_file: bool = False,
               mode: str = "overwrite") -> str:
    """K7: ``{root}/analytic_result_{yyyy}_{MM}``, a folder of CSV parts with
    header rows, written by all executors.

    ``single_file`` makes one file ``analytic_result_{yyyy}_{MM}.csv``: the
    result is computed in parallel and settled first, so the one task that
    writes the file only copies rows."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/analytic_result_{year:04d}_{month:02d}"
    if not single_file:
        df.write.mode(mode).option("header", True).csv(path)
        return path
    parts = scratch_path(spark, "csv")
    with scratch_table(df, "csv-result") as result:
        result.coalesce(1).write.option("header", True).csv(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(parts), hadoop.Path(f"{path}.csv")
    conf = spark._jsc.hadoopConfiguration()
    from_fs, to_fs = source.getFileSystem(conf), target.getFileSystem(conf)
    if to_fs.exists(target) and mode != "overwrite":
        raise FileExistsError(f"{path}.csv")
    part = next(f.getPath() for f in from_fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    to_fs.mkdirs(target.getParent())
    hadoop.FileUtil.copy(from_fs, part, to_fs, target, True, True, conf)
    remove_path(spark, parts)
    return f"{path}.csv"


def to_messages(df: DataFrame, collection: str, topics: dict[str, str] = L0_TOPICS) -> DataFrame:
    """K2: (topic, value) with one JSON document per row; NULL fields are
    kept (as the original serializer did), no message key."""
    return df.select(F.lit(topics[collection]).alias("topic"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias("value"))


def publish(messages: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None,
            path: str | None = None) -> None:
    """Write messages with any batch sink: ``kafka`` (needs the connector
    jar and ``kafka.bootstrap.servers``), or a file format for tests."""
    w = messages.write.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if path is not None:
        w.mode("append").save(path)
    else:
        w.save()


def write_purchases_mart(mart: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Purchases mart partitioned by month of ``purchase_datetime``: a
    time-range query prunes whole months, and the timestamp range inside
    a month is pushed into the parquet reader.

    Rows are rebalanced by month: small months share a task, and a month over
    the advisory partition size is split among several, each writing a file."""
    month = F.date_format("purchase_datetime", "yyyy-MM")
    (mart.withColumn("purchase_month", month).hint("rebalance", F.col("purchase_month"))
     .sortWithinPartitions("purchase_month", "customer_id")
     .write.mode(mode).partitionBy("purchase_month").parquet(path))


def month_filter_sql(as_of, window: str, column: str = "purchase_month") -> str:
    """Partition predicate covering an age window (whole months), to AND
    with the row-level window on a month-partitioned mart."""
    from shoplens.functions.time import AGE_WINDOWS, as_of_sql

    lo, hi = AGE_WINDOWS[window]
    day = f"to_date({as_of_sql(as_of)})"
    return (f"({column} >= date_format(date_sub({day}, {hi}), 'yyyy-MM') AND "
            f"{column} <= date_format(date_sub({day}, {lo}), 'yyyy-MM'))")
