"""Basket and catalogue operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import time as T
from shoplens.functions.text import maker_domain, maker_website

MONEY = "decimal(18,2)"
RECONCILE_TOLERANCE = 0.005


def basket_items(docs: DataFrame) -> DataFrame:
    """G1: one row per line item (``explode`` is a narrow, per-row operator)."""
    return (docs.select("purchase_id", F.explode("items").alias("it"))
            .select("purchase_id", "it.*"))


# Line total = round(price * quantity, 2), summed in decimal inside each
# document (a per-row higher-order function, no shuffle of line items).
DOC_ITEMS_TOTAL_SQL = """aggregate(coalesce(items, array()), CAST(0 AS DECIMAL(28,2)),
    (acc, x) -> CAST(acc + round(CAST(x.price_per_unit AS DECIMAL(18,2)) * x.quantity, 2) AS DECIMAL(28,2)))"""


def reconcile(docs: DataFrame, tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """Compare the line-item sum with the stated total (|diff| < tolerance),
    inside each document."""
    return docs.selectExpr("purchase_id", f"CAST(total_amount AS {MONEY}) AS stated",
                           f"{DOC_ITEMS_TOTAL_SQL} AS summed").selectExpr(
        "purchase_id",
        "CAST(summed AS DOUBLE) AS items_total",
        "CAST(stated AS DOUBLE) AS total_amount",
        "CAST(stated - summed AS DOUBLE) AS diff",
        f"abs(stated - summed) < {tolerance} AS matches",
    )


def reconcile_lines(lines: DataFrame, heads: DataFrame, key: str = "purchase_id",
                    tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """G2 over flat inputs: ``lines(key, price_per_unit, quantity)`` and
    ``heads(key, total_amount)``. Line totals are summed by a partial
    aggregate per key (rows shrink before the shuffle); the heads join
    reuses that partitioning. Lines without a head are ignored, as a
    document holds only its own lines. Same answer as ``reconcile``."""
    totals = lines.groupBy(key).agg(F.expr(
        f"sum(round(CAST(price_per_unit AS {MONEY}) * quantity, 2)) AS items_total"))
    j = heads.selectExpr(key, f"CAST(total_amount AS {MONEY}) AS total_amount").join(totals, key, "left")
    return j.selectExpr(
        key,
        f"CAST(coalesce(items_total, CAST(0 AS {MONEY})) AS DOUBLE) AS items_total",
        "CAST(total_amount AS DOUBLE) AS total_amount",
        f"CAST(total_amount - coalesce(items_total, CAST(0 AS {MONEY})) AS DOUBLE) AS diff",
        f"abs(total_amount - coalesce(items_total, CAST(0 AS {MONEY}))) < {tolerance} AS matches",
    )


def sample_per_group(df: DataFrame, group: str, order, n: int) -> DataFrame:
    """``n`` rows per group by a fixed order (a seeded hash works as a
    reproducible shuffle). row_number <= n is planned with a
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at
    most ``n`` rows per group even when one group is huge."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def maker_domains(makers: DataFrame, name_col: str) -> DataFrame:
    """Web domain and site from a maker name."""
    return makers.select("*", maker_domain(F.col(name_col)).alias("domain"),
                         maker_website(F.col(name_col)).alias("website"))


def iso_z_roundtrip(df: DataFrame, ts_col: str) -> DataFrame:
    """Timestamp -> 'yyyy-MM-ddTHH:mm:ssZ' (fraction dropped) -> timestamp."""
    text = T.format_iso_z(F.col(ts_col))
    back = T.parse_iso_z(text)
    return df.select("*", text.alias("iso_z"), back.alias("parsed"),
                     (back == F.date_trunc("second", F.col(ts_col))).alias("roundtrip_ok"))


def home_store(customers: DataFrame, stores: DataFrame) -> DataFrame:
    """G4 (flattened): each customer with its home store's fields."""
    s = stores.select(F.col("store_id").alias("home_store_id"),
                      F.col("store_name").alias("home_store_name"),
                      F.col("store_network").alias("home_store_network"))
    return customers.join(s, customers["purchase_location.store_id"] == s["home_store_id"], "left")
