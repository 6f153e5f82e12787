"""Generic table scans.

``read_table`` is a plain columnar scan; the caller's ``select``/``where``
reach the parquet reader as ``ReadSchema``/``PushedFilters``. Parquet
timestamps written without a zone load as ``timestamp_ntz``; they are cast
to ``timestamp`` under the session zone (UTC) at this boundary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the shared tables: a scan with a schema skips
# footer-based inference (a Spark job per read). Timestamps in these files
# carry no zone (timestamp_ntz); ``with_utc_timestamps`` converts them.
KNOWN_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table_path(root: str, name: str, fmt: str = "parquet") -> str:
    return f"{root.rstrip('/')}/{name}.{fmt}"


def with_utc_timestamps(df: DataFrame, ddl: str | None = None) -> DataFrame:
    if ddl is not None:
        ntz = [part.split()[0] for part in ddl.split(",") if "TIMESTAMP_NTZ" in part.upper()]
    else:
        ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
    if not ntz:
        return df
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz})


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               options: dict[str, str] | None = None,
               schema: str | None = None) -> DataFrame:
    """Scan one table; ``fmt`` is any Spark source name (parquet, json, orc, ...)."""
    reader = spark.read.format(fmt)
    ddl = schema or (KNOWN_SCHEMAS.get(name) if fmt == "parquet" else None)
    if ddl:
        reader = reader.schema(ddl)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = with_utc_timestamps(reader.load(table_path(root, name, fmt)), ddl)
    return df


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    A single-partition JDBC read funnels the whole table through one task.
    With a numeric/date ``partition_column`` and bounds the scan is split
    into ``num_partitions`` range queries run by executors in parallel.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    return opts


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
