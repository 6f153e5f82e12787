"""Explicit schemas: raw documents, marts and the feature matrix.

Raw documents are read with these schemas (never inferred: inference
reorders fields and drops all-NULL structs).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

STORES_DDL = """
store_id STRING, store_name STRING, store_network STRING, store_type_description STRING, type STRING,
categories ARRAY<STRING>,
manager STRUCT<name: STRING, phone: STRING, email: STRING>,
location STRUCT<country: STRING, city: STRING, street: STRING, house: STRING, postal_code: STRING,
                coordinates: STRUCT<latitude: DOUBLE, longitude: DOUBLE>>,
opening_hours STRUCT<mon_fri: STRING, sat: STRING, sun: STRING>,
accepts_online_orders BOOLEAN, delivery_available BOOLEAN, warehouse_connected BOOLEAN,
last_inventory_date STRING
"""

PRODUCTS_DDL = """
id STRING, name STRING, `group` STRING, description STRING,
kbju STRUCT<calories: DOUBLE, protein: DOUBLE, fat: DOUBLE, carbohydrates: DOUBLE>,
price DOUBLE, unit STRING, origin_country STRING, expiry_days INT, is_organic BOOLEAN, barcode STRING,
manufacturer STRUCT<name: STRING, country: STRING, website: STRING, inn: STRING>
"""

CUSTOMERS_DDL = """
customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING,
birth_date STRING, gender STRING, registration_date STRING,
is_loyalty_member BOOLEAN, loyalty_card_number STRING,
purchase_location STRUCT<store_id: STRING, store_name: STRING, store_network: STRING, store_type_description: STRING,
                         country: STRING, city: STRING, street: STRING, house: STRING, postal_code: STRING>,
delivery_address STRUCT<country: STRING, city: STRING, street: STRING, house: STRING, apartment: STRING, postal_code: STRING>,
preferences STRUCT<preferred_language: STRING, preferred_payment_method: STRING, receive_promotions: BOOLEAN>
"""

PURCHASES_DDL = """
purchase_id STRING,
customer STRUCT<customer_id: STRING, first_name: STRING, last_name: STRING, email: STRING, phone: STRING,
                is_loyalty_member: BOOLEAN, loyalty_card_number: STRING>,
store STRUCT<store_id: STRING, store_name: STRING, store_network: STRING, store_type_description: STRING,
             location: STRUCT<city: STRING, street: STRING, house: STRING, postal_code: STRING>>,
items ARRAY<STRUCT<product_id: STRING, name: STRING, category: STRING, quantity: INT, unit: STRING,
                   price_per_unit: DOUBLE, total_price: DOUBLE,
                   kbju: STRUCT<calories: DOUBLE, protein: DOUBLE, fat: DOUBLE, carbohydrates: DOUBLE>,
                   manufacturer: STRUCT<name: STRING, country: STRING, website: STRING, inn: STRING>>>,
total_amount DOUBLE, payment_method STRING, is_delivery BOOLEAN,
delivery_address STRUCT<country: STRING, city: STRING, street: STRING, house: STRING, apartment: STRING, postal_code: STRING>,
purchase_datetime STRING
"""

CUSTOMERS_MART_DDL = "customer_id STRING, registration_dt TIMESTAMP, is_loyalty_member INT"
PURCHASES_MART_DDL = (
    "purchase_id STRING, customer_id STRING, store_id STRING, purchase_datetime TIMESTAMP, "
    "total_amount DOUBLE, payment_method STRING, is_delivery INT"
)

# Feature matrix, in target-table order (19 columns; the load stamp is
# added by the sink only).
FLAG_COLUMNS = (
    "new_customer", "loyal_customer", "no_purchases", "inactive_14_30", "recurrent_buyer",
    "delivery_user", "prefers_cash", "prefers_card",
    "weekend_shopper", "weekday_shopper", "morning_shopper", "night_shopper",
    "store_loyal", "switching_store", "recent_high_spender", "low_cost_buyer",
)
MATRIX_COLUMNS = ("customer_id",) + FLAG_COLUMNS + ("sum_7d", "sum_30d")
MATRIX_DDL = ", ".join(
    ["customer_id STRING"] + [f"{c} INT" for c in FLAG_COLUMNS] + ["sum_7d DOUBLE", "sum_30d DOUBLE"]
)

# Collection name -> key field and default file name.
COLLECTION_KEYS = {
    "products": "id",
    "customers": "customer_id",
    "stores": "store_id",
    "purchases": "purchase_id",
}
COLLECTION_FILES = {name: f"{name}.jsonl" for name in COLLECTION_KEYS}

# Topic per collection for the L0 layer.
L0_TOPICS = {
    "customers": "retail.customers.l0",
    "products": "retail.products.l0",
    "stores": "retail.stores.l0",
    "purchases": "retail.purchases.l0",
}


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))


DOCUMENT_SCHEMAS = {
    "stores": STORES_DDL,
    "products": PRODUCTS_DDL,
    "customers": CUSTOMERS_DDL,
    "purchases": PURCHASES_DDL,
}
