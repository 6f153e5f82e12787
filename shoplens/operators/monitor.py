"""Monitoring: KPI counts, duplicate ratio, duplicate alert (M1-M3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: alert when duplicates exceed half of the rows (strictly).
DUPLICATE_ALERT_RATIO = 0.5


def kpi_counts(purchases: DataFrame) -> DataFrame:
    """M1: purchases, distinct stores, distinct customers (one row).

    Purchases are first counted by store and customer, so only these pairs,
    not the rows, are taken apart for the two distinct counts."""
    pairs = purchases.groupBy("store_id", "customer_id").agg(F.expr("count(1) AS n"))
    return pairs.agg(F.expr("coalesce(sum(n), 0) AS purchases"),
                     F.expr("count(DISTINCT store_id) AS stores"),
                     F.expr("count(DISTINCT customer_id) AS customers"))


def duplicate_ratio(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """M2: ``1 - distinct keys / rows`` (ASSUMPTION: the definition).

    Two partial aggregates: keys are counted map-side first, so a key
    holding a large share of rows never reaches one task as raw rows.
    NULL on an empty table.
    """
    return ratio_of_counts(df.groupBy(*keys).agg(F.expr("count(1) AS copies")), table)


def ratio_of_counts(per_key: DataFrame, table: str) -> DataFrame:
    """``duplicate_ratio`` from one row per key with its ``copies``."""
    return ratio_of_totals(per_key.agg(F.expr("coalesce(sum(copies), 0) AS rows"),
                                       F.expr("count(1) AS distinct_keys")), table)


def ratio_of_totals(totals: DataFrame, table: str) -> DataFrame:
    """``duplicate_ratio`` from one row with ``rows`` and ``distinct_keys``."""
    name = table.replace("'", "''")
    return totals.selectExpr(
        f"'{name}' AS table_name", "rows", "distinct_keys",
        "rows - distinct_keys AS duplicate_rows",
        "try_divide(CAST(rows - distinct_keys AS DOUBLE), rows) AS dup_ratio")


def republished_ratio(df: DataFrame, keys: Sequence[str], times: dict[str, int]) -> DataFrame:
    """M2 for a table sent several times, from one count per key: ``times``
    maps a name to the number of sendings."""
    one = df.groupBy(*keys).agg(F.expr("count(1) AS copies")).agg(
        F.expr("coalesce(sum(copies), 0) AS rows"), F.expr("count(1) AS distinct_keys"))
    sent = F.explode(F.array(*[F.struct(F.lit(k).alias("table_name"), F.lit(n).alias("n")) for k, n in times.items()]))
    return one.select("rows", "distinct_keys", sent.alias("s")).selectExpr(
        "s.table_name AS table_name", "rows * s.n AS rows", "distinct_keys",
        "rows * s.n - distinct_keys AS duplicate_rows",
        "try_divide(CAST(rows * s.n - distinct_keys AS DOUBLE), rows * s.n) AS dup_ratio")


def duplicate_alert(ratios: DataFrame, threshold: float = DUPLICATE_ALERT_RATIO) -> DataFrame:
    """M3: alert rows for tables whose ratio is above ``threshold``."""
    return (ratios.where(F.col("dup_ratio") > threshold)
            .select("table_name", "dup_ratio",
                    F.format_string("duplicates %.1f%% > %.0f%%", F.col("dup_ratio") * 100,
                                    F.lit(threshold * 100)).alias("message")))
