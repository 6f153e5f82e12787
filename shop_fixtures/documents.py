"""Nested shop documents built from the driver's flat tables.

customers  <- customer ⋈ nation (home store embedded as ``purchase_location``)
stores     <- nation ⋈ region (one store per nation key)
purchases  <- orders ⋈ customer ⋈ lineitem ⋈ part (line items as an array)

A purchase is one document with all its own lines, sorted; a row therefore
grows with one order's number of lines, as the document model has it. Lines
are combined per order by a map-side aggregate of arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import time as T
from shoplens.functions.text import maker_website
from shop_fixtures.views import CONTACT_SQL, FIXTURE_AS_OF
from shoplens.sources.tables import read_table

STORE_ID_SQL = "concat('store-', lpad(CAST({k} AS STRING), 3, '0'))"


def store_id_of(nationkey: Column) -> Column:
    return F.concat(F.lit("store-"), F.lpad(nationkey.cast("string"), 3, "0"))


def customer_documents(spark: SparkSession, root: str, as_of: str = FIXTURE_AS_OF) -> DataFrame:
    c = read_table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = c.selectExpr("*", *[f"{v} AS {k}" for k, v in CONTACT_SQL.items()])
    n = read_table(spark, root, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    reg = T.as_of_col(as_of) - F.make_dt_interval((key % 366).cast("int"))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(
                F.concat(F.lit("cus-"), key.cast("string")).alias("customer_id"),
                F.col("c_name").alias("first_name"),
                F.lit(None).cast("string").alias("last_name"),
                "email", "phone",
                T.format_iso_z(reg).alias("registration_date"),
                ((key % 3) > 0).alias("is_loyalty_member"),
                F.concat(F.lit("LOYAL-"), F.upper(F.substring(F.md5(key.cast("string")), 1, 10)))
                .alias("loyalty_card_number"),
                F.when(F.col("n_nationkey").isNotNull(), F.struct(
                    store_id_of(F.col("n_nationkey")).alias("store_id"),
                    F.col("n_name").alias("store_name"),
                    F.col("n_name").alias("city"))).alias("purchase_location"),
                F.struct(
                    F.lit("ru").alias("preferred_language"),
                    F.when(key % 2 == 0, F.lit("card")).otherwise(F.lit("cash")).alias("preferred_payment_method"),
                    (key % 2 == 0).alias("receive_promotions")).alias("preferences"),
            ))


def store_documents(spark: SparkSession, root: str) -> DataFrame:
    n = read_table(spark, root, "nation")
    r = read_table(spark, root, "region")
    k = F.col("n_nationkey")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(
                store_id_of(k).alias("store_id"),
                F.concat(F.col("n_name"), F.lit(" store")).alias("store_name"),
                F.col("r_name").alias("store_network"),
                F.struct(
                    F.concat(F.lit("Manager "), k.cast("string")).alias("name"),
                    F.concat(F.lit("8 (900) 000-00-"), F.lpad(k.cast("string"), 2, "0")).alias("phone"),
                    F.concat(F.lit(" Manager."), k.cast("string"), F.lit("@Shop.Example.com")).alias("email"),
                ).alias("manager"),
                F.struct(F.col("r_name").alias("country"), F.col("n_name").alias("city")).alias("location"),
            ))


def _line_items(spark: SparkSession, root: str) -> DataFrame:
    """One row per line: order key and the line as a struct."""
    li = read_table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = read_table(spark, root, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
            .selectExpr(
                "l_orderkey",
                """named_struct(
                     'line_no', l_linenumber,
                     'product_id', concat('prd-', CAST(l_partkey AS STRING)),
                     'name', p_name,
                     'category', p_type,
                     'quantity', CAST(l_quantity AS INT),
                     'unit', 'pcs',
                     'price_per_unit', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE),
                     'total_price', CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS INT), 2)
                                         AS DOUBLE)) AS item"""))


def purchase_lines(spark: SparkSession, root: str) -> DataFrame:
    """Flat purchase lines (order_key, price_per_unit, quantity): the rows a
    document's ``items`` array holds."""
    li = read_table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = read_table(spark, root, "part").select("p_partkey", "p_retailprice")
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
            .selectExpr("l_orderkey AS order_key",
                        "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price_per_unit",
                        "CAST(l_quantity AS INT) AS quantity"))


def purchase_heads(spark: SparkSession, root: str) -> DataFrame:
    """(order_key, total_amount) per order, with the documents' totals."""
    lines = (_line_items(spark, root).groupBy("l_orderkey").agg(F.expr(f"{LINES_TOTAL_SQL} AS lines_total")))
    o = read_table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
            .selectExpr("o_orderkey AS order_key", f"{TOTAL_SQL} AS total_amount"))


PURCHASE_ID_SQL = "concat('ord-', CAST(order_key AS STRING))"


# The stated total of a purchase: the rounded sum of its lines, except for
# every third order, which states the order table's own (other) total.
TOTAL_SQL = "CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE coalesce(lines_total, o_totalprice) END"
LINES_TOTAL_SQL = "CAST(sum(CAST(item.total_price AS DECIMAL(18,2))) AS DOUBLE)"


def purchase_documents(spark: SparkSession, root: str) -> DataFrame:
    """G3 + G5: nested purchase documents; the delivery address is present
    only when the purchase is delivered."""
    o = read_table(spark, root, "orders")
    c = read_table(spark, root, "customer").select("c_custkey", "c_name", "c_nationkey")
    c = c.selectExpr("*", *[f"{v} AS {k}" for k, v in CONTACT_SQL.items()])
    n = read_table(spark, root, "nation").select("n_nationkey", "n_name")
    items = (_line_items(spark, root).groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list("item")).alias("items"),
                  F.expr(f"{LINES_TOTAL_SQL} AS lines_total")))
    o = o.join(items, o.o_orderkey == items.l_orderkey, "left")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(n, c.c_nationkey == n.n_nationkey, "left")
            .selectExpr(
                "concat('ord-', CAST(o_orderkey AS STRING)) AS purchase_id",
                """named_struct(
                     'customer_id', concat('cus-', CAST(o_custkey AS STRING)),
                     'first_name', c_name,
                     'last_name', CAST(NULL AS STRING),
                     'email', email,
                     'phone', phone,
                     'is_loyalty_member', c_custkey % 3 > 0,
                     'loyalty_card_number', concat('LOYAL-', upper(substring(md5(CAST(c_custkey AS STRING)), 1, 10)))
                   ) AS customer""",
                f"""named_struct('store_id', {STORE_ID_SQL.format(k='c_nationkey')},
                                 'store_name', concat(n_name, ' store')) AS store""",
                "items",
                f"{TOTAL_SQL} AS total_amount",
                "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'card' ELSE 'cash' END AS payment_method",
                "o_orderstatus = 'O' AS is_delivery",
                """CASE WHEN o_orderstatus = 'O' THEN named_struct(
                     'city', n_name, 'street', concat('Street ', CAST(o_custkey % 100 AS STRING))) END
                   AS delivery_address""",
                "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS purchase_datetime",
            ))


def product_documents(spark: SparkSession, root: str) -> DataFrame:
    """products <- part (brand as the maker)."""
    p = read_table(spark, root, "part")
    return p.select(
        F.concat(F.lit("prd-"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("group"),
        F.col("p_retailprice").alias("price"),
        F.lit("pcs").alias("unit"),
        F.struct(F.col("p_brand").alias("name"), maker_website(F.col("p_brand")).alias("website"))
        .alias("manufacturer"),
    )
