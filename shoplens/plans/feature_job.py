"""Entry point 1: marts -> customer feature matrix -> target table -> CSV."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from shoplens.config import JobConfig, as_of_text
from shoplens.operators.features import customer_feature_matrix
from shoplens.schemas import CUSTOMERS_MART_DDL, PURCHASES_MART_DDL
from shoplens.sinks.export import export_csv
from shoplens.sinks.matrix import ensure_target_table, read_target, target_path, write_matrix
from shoplens.sources.tables import jdbc_options, read_jdbc, read_table


def run(spark: SparkSession, cfg: JobConfig, customers: DataFrame, purchases: DataFrame) -> dict:
    """Makes sure of the target, builds and writes the matrix (one action) and
    exports this run's files, if an export folder is configured."""
    path = target_path(spark, cfg)
    ensure_target_table(spark, cfg, path)
    result = write_matrix(spark, customer_feature_matrix(customers, purchases, as_of=cfg.as_of, th=cfg.thresholds),
                          cfg, path)
    spark.sql(f"REFRESH TABLE {cfg.target}")
    if cfg.csv_root:
        month = dt.datetime.fromisoformat(as_of_text(cfg.as_of)) if cfg.as_of else dt.datetime.now(dt.timezone.utc)
        mine = read_target(spark, path, result["run_id"]).drop("etl_loaded_at")
        result["csv"] = export_csv(mine, cfg.csv_root, month.year, month.month, cfg.csv_single_file)
    return result


def mart_jdbc_options(cfg: JobConfig, table: str, ranges: str | None) -> dict[str, str]:
    """Options of a mart's JDBC read; with a range it is split into
    ``jdbc_partitions`` queries."""
    if not cfg.jdbc_url:
        raise ValueError("SOURCE_FORMAT=jdbc needs JDBC_URL (or CH_HOST)")
    column, lower, upper = ranges.split(",") if ranges and cfg.jdbc_partitions else (None, None, None)
    return jdbc_options(cfg.jdbc_url, f"{cfg.src_db}.{table}", cfg.jdbc_user, cfg.jdbc_password, cfg.jdbc_driver,
                        column, lower, upper, cfg.jdbc_partitions or None)


def read_marts(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, DataFrame]:
    """The two marts: over JDBC, or ``{source_root}/{src_db}/{table}`` in
    ``cfg.source_format``, read with the declared mart schemas (no inference;
    partition columns of a month-partitioned mart are still discovered)."""
    if cfg.source_format == "jdbc":
        return (read_jdbc(spark, mart_jdbc_options(cfg, cfg.src_customers, cfg.jdbc_customers_range)),
                read_jdbc(spark, mart_jdbc_options(cfg, cfg.src_purchases, cfg.jdbc_purchases_range)))
    if not cfg.source_root:
        raise ValueError("SOURCE_ROOT is required")
    root = f"{cfg.source_root.rstrip('/')}/{cfg.src_db}"
    return (read_table(spark, root, cfg.src_customers, cfg.source_format, schema=CUSTOMERS_MART_DDL),
            read_table(spark, root, cfg.src_purchases, cfg.source_format, schema=PURCHASES_MART_DDL))


def main(env: dict[str, str] | None = None) -> dict:
    """``python -m shoplens.plans.feature_job``, configured by environment."""
    from shoplens.session import get_session

    cfg = JobConfig.from_env(env)
    spark = get_session("customer_feature_matrix")
    result = run(spark, cfg, *read_marts(spark, cfg))
    print(result)
    return result


if __name__ == "__main__":
    main()
