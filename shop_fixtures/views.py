"""Shop-shaped views over the driver's generic tables.

These are *derivations* of whole tables (every row of the source is kept);
they give the feature job, the cleaning stage and the keyed load realistic
inputs. The same definitions are written independently in DuckDB SQL in
``shop_fixtures.views_sql``.

Behaviour segments re-time purchase events instead of dropping them:
``user_id % 5 = 0`` lapsing (events from the 15th move 14 days back),
``% 6 = 1`` night owls (hour -> 20..05), ``% 6 = 2`` early shoppers
(hour -> 06..11), ``% 8 = 3`` weekend shoppers (Mon-Fri -> Saturday).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import time as T
from shoplens.sources.tables import read_table

# Fixed reference time of the fixture views (events span 2024-01-01..30).
FIXTURE_AS_OF = "2024-01-31 00:00:00"
LAPSE_FROM = "2024-01-15 00:00:00"
N_STORES = 45


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def r_customers(spark: SparkSession, root: str, as_of: str = FIXTURE_AS_OF) -> DataFrame:
    """customers mart from ``customer``."""
    c = read_table(spark, root, "customer").select("c_custkey")
    return c.selectExpr(
        "concat('cus-', CAST(c_custkey AS STRING)) AS customer_id",
        f"{T.as_of_sql(as_of)} - make_dt_interval(CAST(c_custkey % 366 AS INT)) AS registration_dt",
        "CAST(c_custkey % 3 > 0 AS INT) AS is_loyalty_member",
    )


def purchase_events(spark: SparkSession, root: str) -> DataFrame:
    return purchase_events_of(read_table(spark, root, "events"))


def purchase_events_of(ev: DataFrame) -> DataFrame:
    """Purchase rows of an events DataFrame (batch or streaming).

    ``json_tuple`` parses ``props`` once per row. (With ``get_json_object``
    every predicate that Catalyst pushes below this projection would
    re-parse the JSON once per reference; a generator is a boundary that
    filters on its output do not cross.)"""
    return (ev.where("event_type = 'purchase'")
            .select("event_id", "ts", "user_id", "value", F.json_tuple("props", "k").alias("k_text"))
            .selectExpr("event_id", "ts", "user_id", "value", "CAST(k_text AS INT) AS k"))


# Behaviour segments (see module doc); hours/days shifts as SQL.
SHAPED_TS_SQL = f"""CASE
  WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '{LAPSE_FROM}' THEN ts - make_dt_interval(14)
  WHEN user_id % 6 = 1 THEN ts + make_dt_interval(0, CAST((20 + hour(ts) % 10) % 24 - hour(ts) AS INT))
  WHEN user_id % 6 = 2 THEN ts + make_dt_interval(0, CAST(6 + hour(ts) % 6 - hour(ts) AS INT))
  WHEN user_id % 8 = 3 AND weekday(ts) < 5 THEN ts + make_dt_interval(CAST(5 - weekday(ts) AS INT))
  ELSE ts END"""


def r_purchases(spark: SparkSession, root: str) -> DataFrame:
    """purchases mart from every ``events`` row of type 'purchase'."""
    return r_purchases_of(purchase_events(spark, root))


def r_purchases_of(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "concat('ord-', CAST(event_id AS STRING)) AS purchase_id",
        "concat('cus-', CAST(user_id AS STRING)) AS customer_id",
        "concat('store-', CAST((user_id * 7 + CASE WHEN k < least(99, 50 + (user_id % 7) * 10) "
        f"THEN 0 ELSE k END) % {N_STORES} AS STRING)) AS store_id",
        f"{SHAPED_TS_SQL} AS purchase_datetime",
        "value * 4 AS total_amount",
        "CASE WHEN user_id % 4 = 0 AND k < 90 THEN 'CASH' WHEN user_id % 4 = 1 AND k < 90 THEN 'Card' "
        "WHEN k % 2 = 0 THEN 'cash' ELSE 'card' END AS payment_method",
        "CAST(CASE WHEN user_id % 3 = 0 THEN k % 3 > 0 ELSE k % 3 = 0 END AS INT) AS is_delivery",
    )


def raw_purchases(spark: SparkSession, root: str) -> DataFrame:
    """Dirty RAW purchases (text timestamps, blanks, NULL ids, bad dates,
    future dates, NULL amounts) plus a re-sent copy of some events."""
    return raw_purchases_of(purchase_events(spark, root))


ISO_Z_SQL = "date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def raw_purchases_of(ev: DataFrame, *extra: str) -> DataFrame:
    """``raw_purchases`` over purchase events (batch or streaming).

    One pass over the events: rows with k in 25..34 are emitted twice via
    ``explode`` (copy 1 is the re-send, one hour later, paid by card), so
    the source is scanned once instead of once per branch of a union.
    Blanks are spaces, tabs and no-break spaces; codes have any of these at
    their ends. ``extra`` columns (event_id, k, copy, ...) are kept.
    """
    iso = ISO_Z_SQL.format(ts="ts")
    iso_resent = ISO_Z_SQL.format(ts="ts + INTERVAL 1 HOUR")
    return (ev.selectExpr("*", "explode(CASE WHEN k BETWEEN 25 AND 34 THEN array(0, 1) ELSE array(0) END) AS copy")
            .selectExpr(
                "CASE WHEN k BETWEEN 0 AND 4 THEN CAST(NULL AS STRING) "
                "ELSE concat('ord-', CAST(event_id AS STRING)) END AS purchase_id",
                "concat('cus-', CAST(user_id AS STRING)) AS customer_id",
                f"concat('store-', CAST(k % {N_STORES} AS STRING)) AS store_id",
                f"CASE WHEN copy = 1 THEN {iso_resent} "
                "WHEN k BETWEEN 10 AND 14 THEN 'not-a-date' "
                "WHEN k BETWEEN 15 AND 19 THEN '2034-01-01T00:00:00Z' "
                f"ELSE {iso} END AS purchase_datetime",
                "CASE WHEN k BETWEEN 20 AND 24 THEN CAST(NULL AS DOUBLE) ELSE value * 4 END AS total_amount",
                "CASE WHEN copy = 1 THEN 'card' WHEN k BETWEEN 5 AND 6 THEN '  ' "
                "WHEN k = 7 THEN chr(9) WHEN k = 8 THEN chr(160) WHEN k = 9 THEN concat(' ', chr(9), chr(160)) "
                "WHEN k % 4 = 0 THEN concat('CASH', chr(9)) WHEN k % 4 = 1 THEN concat(chr(160), 'Card') "
                "WHEN k % 2 = 0 THEN ' CASH' ELSE 'Card' END AS payment_method",
                "k % 3 = 0 AS is_delivery", *extra,
            ))


def raw_customers(spark: SparkSession, root: str) -> DataFrame:
    """Dirty RAW customers, every one of them sent twice."""
    reg = ISO_Z_SQL.format(ts=f"{T.as_of_sql(FIXTURE_AS_OF)} - make_dt_interval(CAST(k % 366 AS INT))")
    c = read_table(spark, root, "customer").selectExpr("c_custkey AS k", "explode(array(0, 1)) AS copy")
    return c.selectExpr(
        "CASE k % 23 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN concat(chr(9), chr(160)) "
        "ELSE concat('cus-', CAST(k AS STRING)) END AS customer_id",
        "CASE k % 23 WHEN 2 THEN 'not-a-date' WHEN 3 THEN '2034-01-01T00:00:00Z' WHEN 4 THEN CAST(NULL AS STRING) "
        f"ELSE {reg} END AS registration_date",
        "CASE WHEN k % 23 = 5 THEN '2024-01-31' WHEN k % 23 = 6 THEN '31.01.1990' WHEN k % 2 = 0 "
        "THEN CAST(NULL AS STRING) ELSE '1990-05-17' END AS birth_date",
        "CASE WHEN k % 2 = 0 THEN ' Male' ELSE concat('FEMALE', chr(9)) END AS gender",
        "concat(chr(160), 'RU ') AS preferred_language",
        "k % 3 > 0 AS is_loyalty_member")


# Messy e-mail and phone text derived from a customer row.
CONTACT_SQL = {
    "email": "concat(' ', upper(c_name), '@Mail.Example.com ')",
    "phone": "concat('8 (9', lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), ') 555-12-34')",
}


def pii_contacts(spark: SparkSession, root: str) -> DataFrame:
    """(c_custkey, email, phone) for every ``customer`` row."""
    c = read_table(spark, root, "customer").select("c_custkey", "c_name")
    return c.selectExpr("c_custkey", *[f"{v} AS {k}" for k, v in CONTACT_SQL.items()])
