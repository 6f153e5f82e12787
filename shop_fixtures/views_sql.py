"""DuckDB SQL for the fixture views, written independently of the Spark code.

Each constant is a list of CTE bodies (``name AS (...)``) that query SQL
in ``shoplens.plans.oracle`` prepends with ``WITH``.
"""

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

PE = """pe AS (
  SELECT event_id, ts, user_id, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events WHERE event_type = 'purchase')"""

R_CUSTOMERS = f"""r_customers AS (
  SELECT 'cus-' || CAST(c_custkey AS VARCHAR) AS customer_id,
         {AS_OF} - to_days(CAST(c_custkey % 366 AS INTEGER)) AS registration_dt,
         CAST(c_custkey % 3 > 0 AS INTEGER) AS is_loyalty_member
  FROM customer)"""

R_PURCHASES = """r_purchases AS (
  SELECT 'ord-' || CAST(event_id AS VARCHAR) AS purchase_id,
         'cus-' || CAST(user_id AS VARCHAR) AS customer_id,
         'store-' || CAST((user_id * 7 + CASE WHEN k < least(99, 50 + (user_id % 7) * 10) THEN 0 ELSE k END) % 45 AS VARCHAR) AS store_id,
         CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-15 00:00:00' THEN ts - INTERVAL 14 DAY
              WHEN user_id % 6 = 1 THEN ts + to_hours(CAST((20 + hour(ts) % 10) % 24 - hour(ts) AS BIGINT))
              WHEN user_id % 6 = 2 THEN ts + to_hours(CAST(6 + hour(ts) % 6 - hour(ts) AS BIGINT))
              WHEN user_id % 8 = 3 AND isodow(ts) <= 5 THEN ts + to_days(CAST(6 - isodow(ts) AS INTEGER))
              ELSE ts END AS purchase_datetime,
         value * 4 AS total_amount,
         CASE WHEN user_id % 4 = 0 AND k < 90 THEN 'CASH'
              WHEN user_id % 4 = 1 AND k < 90 THEN 'Card'
              WHEN k % 2 = 0 THEN 'cash' ELSE 'card' END AS payment_method,
         CAST(CASE WHEN user_id % 3 = 0 THEN k % 3 > 0 ELSE k % 3 = 0 END AS INTEGER) AS is_delivery
  FROM pe)"""

RAW_PURCHASES = """raw_base AS (
  SELECT CASE WHEN k BETWEEN 0 AND 4 THEN NULL ELSE 'ord-' || CAST(event_id AS VARCHAR) END AS purchase_id,
         'cus-' || CAST(user_id AS VARCHAR) AS customer_id,
         'store-' || CAST(k % 45 AS VARCHAR) AS store_id,
         CASE WHEN k BETWEEN 10 AND 14 THEN 'not-a-date'
              WHEN k BETWEEN 15 AND 19 THEN '2034-01-01T00:00:00Z'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS purchase_datetime,
         CASE WHEN k BETWEEN 20 AND 24 THEN NULL ELSE value * 4 END AS total_amount,
         CASE WHEN k IN (5, 6) THEN '  ' WHEN k = 7 THEN chr(9) WHEN k = 8 THEN chr(160)
              WHEN k = 9 THEN ' ' || chr(9) || chr(160) WHEN k % 4 = 0 THEN 'CASH' || chr(9)
              WHEN k % 4 = 1 THEN chr(160) || 'Card' WHEN k % 2 = 0 THEN ' CASH' ELSE 'Card' END AS payment_method,
         k % 3 = 0 AS is_delivery,
         k AS _k, ts AS _ts
  FROM pe),
raw_purchases AS (
  SELECT purchase_id, customer_id, store_id, purchase_datetime, total_amount, payment_method, is_delivery
  FROM raw_base
  UNION ALL
  SELECT purchase_id, customer_id, store_id, strftime(_ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ'),
         total_amount, 'card', is_delivery
  FROM raw_base WHERE _k BETWEEN 25 AND 34)"""

RAW_CUSTOMERS = f"""raw_customers AS (
  SELECT CASE k % 23 WHEN 0 THEN NULL WHEN 1 THEN chr(9) || chr(160) ELSE 'cus-' || CAST(k AS VARCHAR) END AS customer_id,
         CASE k % 23 WHEN 2 THEN 'not-a-date' WHEN 3 THEN '2034-01-01T00:00:00Z' WHEN 4 THEN NULL
              ELSE strftime({AS_OF} - to_days(CAST(k % 366 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') END AS registration_date,
         CASE WHEN k % 23 = 5 THEN '2024-01-31' WHEN k % 23 = 6 THEN '31.01.1990'
              WHEN k % 2 = 0 THEN NULL ELSE '1990-05-17' END AS birth_date,
         CASE WHEN k % 2 = 0 THEN ' Male' ELSE 'FEMALE' || chr(9) END AS gender,
         chr(160) || 'RU ' AS preferred_language, k % 3 > 0 AS is_loyalty_member
  FROM (SELECT c_custkey AS k, unnest([0, 1]) AS copy FROM customer))"""

PII_CONTACTS = """pii_contacts AS (
  SELECT c_custkey,
         ' ' || upper(c_name) || '@Mail.Example.com ' AS email,
         '8 (9' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || ') 555-12-34' AS phone
  FROM customer)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
