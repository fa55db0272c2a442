"""Raw order, transaction and customer rows derived from the given tables.

The SQL below is plain enough for both engines, so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreline.session import spread

ORDERS_AS_OF = "2001-07-20 00:00:00"
TXNS_AS_OF = "2024-01-29 12:00:00"
BASELINE_AS_OF = "2024-01-04"
VELOCITY_THRESHOLD = 1

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _pick(values: str, index: str) -> str:
    return f"split_part('{values}', ',', CAST({index} AS INT))"


BRONZE_ORDERS = f"""
WITH counted AS (
  SELECT l_orderkey, count(*) AS n, min(l_suppkey) AS supp FROM {{lineitem}} GROUP BY l_orderkey
), base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, substring(o_orderpriority, 1, 1) AS pri, c_nationkey,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price, coalesce(n, 0) AS n, supp,
         substring(CAST(o_orderdate AS STRING), 1, 10) AS d0,
         substring(CAST(o_orderdate + INTERVAL 1 DAY AS STRING), 1, 10) AS d1,
         substring(CAST(o_orderdate + INTERVAL 3 DAY AS STRING), 1, 10) AS d3,
         lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') AS hm
  FROM {{orders}} LEFT JOIN {{customer}} ON c_custkey = o_custkey LEFT JOIN counted ON l_orderkey = o_orderkey
), rows_ AS (
  SELECT k, d3, hm,
    'ord_' || CAST(k AS STRING) AS order_id,
    CASE WHEN k % 101 <> 0 THEN 'cust_' || CAST(o_custkey AS STRING) END AS customer_id,
    'merch_' || CAST(supp AS STRING) AS merchant_id,
    CASE WHEN k % 97 = 0 THEN 'lost' WHEN k % 103 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' Delivered '
         WHEN o_orderstatus = 'O' THEN 'CONFIRMED'
         ELSE {_pick('pending,shipped,cancelled,refunded', 'k % 4 + 1')} END AS order_status,
    CASE WHEN k % 107 = 0 THEN 'bad' WHEN k % 41 = 0 THEN d0 || 'T' || hm || ':00.000000+00:00'
         WHEN k % 3 = 0 THEN d0 || 'T' || hm || ':00.000Z' WHEN k % 3 = 1 THEN d0 || ' ' || hm || ':00'
         ELSE d0 END AS order_ts,
    d1 || ' ' || hm || ':00' AS updated_ts,
    CASE WHEN k % 109 = 0 THEN 'XXX' ELSE {_pick('usd,eur,gbp,cad,aud,jpy,ngn, ghs', 'k % 8 + 1')} END AS currency,
    CASE WHEN k % 113 = 0 THEN NULL WHEN k % 211 = 0 THEN 'n/a' WHEN k % 89 = 0 THEN '-' || CAST(price AS STRING)
         ELSE CAST(price AS STRING) END AS gross_amount,
    CASE WHEN k % 4 <> 0
         THEN CAST(CAST(price * CAST(k % 30 AS DECIMAL(2,0)) * 0.01 AS DECIMAL(18,2)) AS STRING) END AS discount_amount,
    CASE WHEN k % 127 = 0 THEN NULL ELSE CAST(n AS STRING) END AS item_count,
    CASE WHEN k % 157 = 0 THEN 'Store Credit' WHEN pri = '1' THEN 'Credit Card' WHEN pri = '2' THEN 'Apple Pay'
         WHEN pri = '3' THEN 'PayPal' WHEN pri = '4' THEN ' Bank Transfer' ELSE 'Debit Card' END AS payment_method,
    ' n' || CAST(c_nationkey AS STRING) AS shipping_country,
    'Ecommerce_App' AS source_system,
    d1 || ' 00:00:00' AS ingest_ts
  FROM base
)
SELECT order_id, customer_id, merchant_id, order_status, order_ts, updated_ts, currency, gross_amount,
       discount_amount, item_count, payment_method, shipping_country, source_system, ingest_ts
FROM rows_
UNION ALL
SELECT order_id, customer_id, merchant_id, 'refunded', order_ts, d3 || ' ' || hm || ':00', currency, gross_amount,
       discount_amount, item_count, payment_method, shipping_country, source_system, d3 || ' 00:00:00'
FROM rows_ WHERE k % 50 = 0
"""

BRONZE_TRANSACTIONS = f"""
WITH base AS (
  SELECT event_id AS e, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v,
         CAST(date_trunc('second', ts) AS STRING) AS t,
         CAST(date_trunc('second', ts) + INTERVAL 1 MINUTE AS STRING) AS t1,
         CAST(date_trunc('second', ts) + INTERVAL 1 HOUR AS STRING) AS t2
  FROM {{events}}
), rows_ AS (
  SELECT e, t2,
    'txn_' || CAST(e AS STRING) AS transaction_id,
    CASE WHEN e % 5 <> 0 THEN 'ord_' || CAST(e % 1000 AS STRING) END AS order_id,
    CASE WHEN e % 301 <> 0 THEN 'cust_' || CAST(user_id AS STRING) END AS customer_id,
    'merch_' || CAST(e % 50 AS STRING) AS merchant_id,
    CASE WHEN e % 307 = 0 THEN 'bad' WHEN e % 3 = 0 THEN replace(t, ' ', 'T') || '.000Z' ELSE t END AS transaction_ts,
    CASE WHEN e % 311 = 0 THEN NULL WHEN e % 313 = 0 THEN '-1.50'
         ELSE CAST(CAST(v * 20 AS DECIMAL(18,2)) AS STRING) END AS amount,
    {_pick('usd,eur,gbp', 'e % 3 + 1')} AS currency,
    CASE WHEN e % 317 = 0 THEN 'gift' WHEN event_type = 'signup' THEN 'refund' WHEN event_type = 'error' THEN 'chargeback'
         ELSE 'Purchase ' END AS transaction_type,
    {_pick('credit_card,debit_card,PayPal,bank_transfer,crypto,buy_now_pay_later,apple_pay,google_pay', 'e % 8 + 1')}
      AS payment_method,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN e % 11 = 0 THEN 'pending' ELSE ' COMPLETED' END AS status,
    CAST(400000 + e % 100000 AS STRING) AS card_bin,
    lpad(CAST(e % 10000 AS STRING), 4, '0') AS card_last4,
    {_pick('us,gb,de,ng,gh,fr,ca,au,jp,br', 'e % 10 + 1')} AS ip_country,
    {_pick('Mobile,Desktop,Tablet', 'e % 7 % 3 + 1')} AS device_type,
    {_pick('Electronics,Fashion,Food,Beauty,Sports,Home', 'e % 50 % 6 + 1')} AS merchant_category,
    CASE WHEN e % 97 = 0 THEN NULL WHEN e % 4 = 0 THEN 'true' ELSE 'false' END AS is_international,
    'payments_service' AS source_system,
    t1 AS ingest_ts
  FROM base
)
SELECT transaction_id, order_id, customer_id, merchant_id, transaction_ts, amount, currency, transaction_type,
       payment_method, status, card_bin, card_last4, ip_country, device_type, merchant_category, is_international,
       source_system, ingest_ts
FROM rows_
UNION ALL
SELECT transaction_id, order_id, customer_id, merchant_id, transaction_ts, amount, currency, transaction_type,
       payment_method, 'reversed', card_bin, card_last4, ip_country, device_type, merchant_category, is_international,
       source_system, t2
FROM rows_ WHERE e % 40 = 0
"""

_FIRST = "José,Ana,Li,Omar,Zoë,Ivan,Mia,Noah,Chloé,Raj,Eva,Tom"
_LAST = "Müller,Smith,Okafor,García,Chen,Novak,O''Brien,de  la Cruz,Haddad,Kim,Rossi,Dubois,Silva,Jensen,Kowalski,Nguyen"

BRONZE_CUSTOMERS = f"""
WITH base AS (
  SELECT c_custkey AS k, c_nationkey, c_mktsegment, CAST(c_custkey AS STRING) AS ks,
         {_pick(_FIRST, 'c_custkey % 12 + 1')} AS f, {_pick(_LAST, 'c_custkey % 16 + 1')} AS l,
         CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 15000 AS INT) AS STRING) AS dob,
         CAST(DATE '1951-01-01' + CAST(c_custkey * 37 % 15000 AS INT) AS STRING) AS dob1,
         CAST(DATE '1995-01-01' + CAST(c_custkey * 13 % 2390 AS INT) AS STRING) AS reg,
         lpad(CAST(c_custkey % 10000000 AS STRING), 7, '0') AS ph
  FROM {{customer}}
), person AS (
  SELECT *,
    CASE WHEN k % 9 = 0 THEN 'noreply@shop.example.com' WHEN k % 7 = 0 THEN 'user.' || ks || '@example.org' END AS fixed_mail,
    CASE WHEN k % 131 = 0 THEN '2030-01-01' WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN dob
         WHEN k % 3 = 1 THEN substring(dob, 6, 2) || '/' || substring(dob, 9, 2) || '/' || substring(dob, 1, 4)
         ELSE substring(dob, 9, 2) || '-' || substring(dob, 6, 2) || '-' || substring(dob, 1, 4) END AS birth,
    CASE WHEN k % 17 <> 0 THEN reg || ' 10:00:00' END AS registered,
    CASE WHEN k % 71 = 0 THEN 'whale' WHEN k % 73 = 0 THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN 'New'
         WHEN c_mktsegment = 'BUILDING' THEN ' returning' WHEN c_mktsegment = 'FURNITURE' THEN 'VIP'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'at_risk' ELSE 'churned' END AS seg,
    {_pick('Bronze,Silver,Gold,Platinum,None', 'k % 5 + 1')} AS tier,
    CASE WHEN k % 14 = 0 THEN 'maybe' WHEN k % 6 = 0 THEN 'false' ELSE 'true' END AS active,
    'n' || CAST(c_nationkey AS STRING) AS nation,
    'Ab-' || lpad(CAST(k % 500 AS STRING), 3, '0') AS postal
  FROM base
)
SELECT 'cust_' || ks AS customer_id, 'ecommerce_app' AS source_system, f AS first_name, l AS last_name,
  coalesce(fixed_mail, 'Us.Er' || ks || '+shop@Gmail.com') AS email, '+1 (555) ' || ph AS phone, birth AS date_of_birth,
  CASE WHEN k % 2 = 0 THEN ' F' ELSE 'm' END AS gender, ks || ' Main St' AS address_line1, CAST(NULL AS STRING) AS address_line2,
  ' New  Town ' AS city, 'ST' AS state_province, postal AS postal_code, nation AS country, registered AS registration_ts,
  active AS is_active, seg AS segment, tier AS loyalty_tier, '2001-07-01 00:00:00' AS ingest_ts
FROM person
UNION ALL
SELECT 'cust_' || ks, 'ecommerce_app', f, l, coalesce(fixed_mail, 'Us.Er' || ks || '+shop@Gmail.com'), '+1 (555) ' || ph, birth,
  'f', ks || ' Main St', NULL, 'Old Town', 'ST', postal, nation, registered, active, seg, 'Gold', '2001-07-02 00:00:00'
FROM person WHERE k % 60 = 0
UNION ALL
SELECT 'pay_' || ks, 'payments_service', upper(f), CASE WHEN k % 45 = 0 THEN l || 'son' ELSE l END,
  CASE WHEN k % 10 = 0 THEN NULL WHEN k % 35 = 0 THEN ' user' || ks || '@gmail.com '
       ELSE coalesce(fixed_mail, 'user' || ks || '@gmail.com') END,
  CASE WHEN k % 15 = 0 THEN NULL ELSE '555-' || ph END,
  CASE WHEN k % 20 = 0 THEN dob1 ELSE birth END, NULL, NULL, NULL, 'New Town', 'ST',
  CASE WHEN k % 55 = 0 THEN 'ZZ 999' ELSE lower(postal) END, upper(nation),
  registered, active, seg, tier, '2001-07-01 00:00:00'
FROM person WHERE k % 5 = 0
UNION ALL
SELECT 'mob_' || ks, 'mobile_app', f, l, coalesce(fixed_mail, 'user' || ks || '@gmail.com'), '0015550' || substring(ph, 2, 6), birth, NULL,
  NULL, NULL, NULL, NULL, postal, CASE WHEN k % 50 <> 0 THEN nation END, registered, active, seg, tier, '2001-07-01 00:00:00'
FROM person WHERE k % 25 = 0
"""


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return spark.sql(BRONZE_ORDERS, orders=t["orders"], lineitem=t["lineitem"], customer=t["customer"])


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_TRANSACTIONS, events=spread(tables(spark, sf_dir)["events"]))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_CUSTOMERS, customer=spread(tables(spark, sf_dir)["customer"]))


def as_sql(text: str) -> str:
    """The same rows as a subquery over tables of the given names."""
    return text.format(**{name: name for name in TABLES})
