"""Plain SQL for the registered queries, written without the library's shortcuts.

Every text is one statement over the given tables. Shared steps are common table expressions, added
to a statement when their name occurs in it.
"""

from __future__ import annotations

import re

from oreline.operators.matching import BLOCKS, threshold_signatures
from oreline import schemas as S
from oreline.plans.star import PAYMENT_ROWS

from . import fixtures as X

OAS, TAS, BAS = f"TIMESTAMP '{X.ORDERS_AS_OF}'", f"TIMESTAMP '{X.TXNS_AS_OF}'", f"DATE '{X.BASELINE_AS_OF}'"
ODAY, TDAY = f"DATE '{X.ORDERS_AS_OF[:10]}'", f"DATE '{X.TXNS_AS_OF[:10]}'"
VT = X.VELOCITY_THRESHOLD


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


CTE: dict[str, str] = {}

# ---- orders ---------------------------------------------------------------------------------------

CTE["x_bo"] = X.as_sql(X.BRONZE_ORDERS)
CTE["x_to"] = """
SELECT order_id, customer_id, merchant_id, lower(trim(order_status)) AS order_status,
  TRY_CAST(order_ts AS TIMESTAMP) AS order_ts, TRY_CAST(updated_ts AS TIMESTAMP) AS updated_ts,
  upper(trim(currency)) AS currency, TRY_CAST(gross_amount AS DOUBLE) AS gross_amount,
  TRY_CAST(discount_amount AS DOUBLE) AS discount_amount, TRY_CAST(item_count AS INTEGER) AS item_count,
  lower(trim(replace(payment_method, ' ', '_'))) AS payment_method, upper(trim(shipping_country)) AS shipping_country,
  lower(trim(source_system)) AS source_system, TRY_CAST(ingest_ts AS TIMESTAMP) AS ingest_ts
FROM x_bo"""
ORDER_RULES = {
    "null_order_id": "order_id IS NULL", "null_customer_id": "customer_id IS NULL", "null_order_ts": "order_ts IS NULL",
    "invalid_status": f"order_status NOT IN {_in(S.ORDER_STATUSES)}",
    "invalid_currency": f"currency IS NOT NULL AND currency NOT IN {_in(S.CURRENCIES)}",
    "negative_amount": "gross_amount < 0", "future_order": f"order_ts > {OAS} + INTERVAL 1 HOUR",
    "zero_items": "item_count <= 0",
}


def _checked(source: str, rules: dict[str, str]) -> str:
    flags = ", ".join(f"({rule}) AS _err_{name}" for name, rule in rules.items())
    bad = " OR ".join(f"coalesce(_err_{name}, false)" for name in rules)
    bad3 = " OR ".join(f"_err_{name}" for name in rules)
    strict = " OR ".join(f"coalesce(_err_{name}, true)" for name in rules)
    return (f"SELECT *, NOT ({bad}) AS ok, NOT ({bad3}) AS ok3, NOT ({strict}) AS ok_strict "
            f"FROM (SELECT *, {flags} FROM {source})")


CTE["x_co"] = _checked("x_to", ORDER_RULES)
CTE["x_so"] = f"""
SELECT order_id, customer_id, merchant_id, order_status, order_ts, updated_ts, CAST(order_ts AS DATE) AS order_date,
  year(order_ts) AS order_year, month(order_ts) AS order_month, dayofweek(order_ts) + 1 AS order_dow,
  dayofweek(order_ts) IN (0, 6) AS is_weekend, currency, gross_amount, discount_amount,
  CASE WHEN gross_amount > 0 THEN round(discount_amount / gross_amount * 100, 2) ELSE 0.0 END AS discount_pct,
  round(gross_amount - coalesce(discount_amount, 0.0), 2) AS net_amount, item_count, payment_method, shipping_country,
  source_system, ingest_ts, '2.0' AS pipeline_version, {OAS} AS silver_ts
FROM x_co WHERE ok
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST) = 1"""

# ---- transactions ---------------------------------------------------------------------------------

CTE["x_bt"] = X.as_sql(X.BRONZE_TRANSACTIONS)
CTE["x_tt"] = """
SELECT transaction_id, order_id, customer_id, merchant_id, TRY_CAST(transaction_ts AS TIMESTAMP) AS transaction_ts,
  TRY_CAST(amount AS DOUBLE) AS amount, upper(trim(currency)) AS currency, lower(trim(transaction_type)) AS transaction_type,
  lower(trim(payment_method)) AS payment_method, lower(trim(status)) AS status, card_bin, card_last4,
  upper(trim(ip_country)) AS ip_country, lower(trim(device_type)) AS device_type,
  lower(trim(merchant_category)) AS merchant_category, TRY_CAST(is_international AS BOOLEAN) AS is_international,
  source_system, TRY_CAST(ingest_ts AS TIMESTAMP) AS ingest_ts
FROM x_bt"""
TXN_RULES = {
    "null_txn_id": "transaction_id IS NULL", "null_customer": "customer_id IS NULL", "null_merchant": "merchant_id IS NULL",
    "null_ts": "transaction_ts IS NULL", "null_amount": "amount IS NULL",
    "negative_amount": "amount < 0 AND transaction_type = 'purchase'",
    "invalid_type": f"transaction_type NOT IN {_in(S.TRANSACTION_TYPES)}",
    "invalid_status": f"status NOT IN {_in(S.TRANSACTION_STATUSES)}",
    "future_ts": f"transaction_ts > {TAS} + INTERVAL 1 HOUR",
}
CTE["x_ct"] = _checked("x_tt", TXN_RULES)
CTE["x_ht"] = """
SELECT * FROM x_ct WHERE ok
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC NULLS LAST) = 1"""
CTE["x_bl"] = f"""
SELECT customer_id, avg(amount) AS avg_amount_30d, stddev_samp(amount) AS stddev_amount_30d, count(*) AS txn_count_30d
FROM x_ht WHERE transaction_ts >= {BAS} - INTERVAL 30 DAY AND transaction_ts < {BAS} GROUP BY customer_id"""


def _velocity(seconds: int) -> str:
    return (f"count(transaction_id) OVER (PARTITION BY customer_id ORDER BY CAST(epoch(transaction_ts) AS BIGINT) "
            f"RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW)")


def _flagged(clean: str, base: str | None, compat: bool = False) -> str:
    stats = ("avg_amount_30d, stddev_amount_30d, " + ("txn_count_30d" if compat else "coalesce(txn_count_30d, 0) AS txn_count_30d")
             if base else "CAST(NULL AS DOUBLE) AS avg_amount_30d, CAST(NULL AS DOUBLE) AS stddev_amount_30d, 0 AS txn_count_30d")
    join = f"LEFT JOIN {base} USING (customer_id)" if base else ""
    no = (lambda e: f"({e})") if compat else (lambda e: f"coalesce({e}, false)")
    return f"""
SELECT *, CASE WHEN risk_score >= 6 THEN 'HIGH' WHEN risk_score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier FROM (
 SELECT *, CAST(flag_high_value AS INT) * 2 + CAST(flag_velocity_spike AS INT) * 3 + CAST(flag_amount_anomaly AS INT) * 3
   + CAST(flag_intl_high_value AS INT) * 2 + CAST(flag_new_customer_high_value AS INT) AS risk_score FROM (
  SELECT *, {no('amount > 5000')} AS flag_high_value, {no(f'txn_velocity_1h > {VT}')} AS flag_velocity_spike,
    CASE WHEN stddev_amount_30d > 0 THEN abs(amount - avg_amount_30d) > 3 * stddev_amount_30d ELSE false END AS flag_amount_anomaly,
    {no('is_international AND amount > 1000')} AS flag_intl_high_value,
    {no('txn_count_30d < 5 AND amount > 500')} AS flag_new_customer_high_value
  FROM (SELECT v.*, {stats} FROM (SELECT c.*, {_velocity(3600)} AS txn_velocity_1h FROM {clean} c) v {join})))"""


CTE["x_ft"] = _flagged("(SELECT * FROM x_ct WHERE ok)", "x_bl")
CTE["x_st"] = f"""
SELECT transaction_id, order_id, customer_id, merchant_id, transaction_ts, transaction_type, status, amount, currency,
  payment_method, card_bin, card_last4, is_international, ip_country, device_type, merchant_category, txn_velocity_1h,
  avg_amount_30d, stddev_amount_30d, txn_count_30d, flag_high_value, flag_velocity_spike, flag_amount_anomaly,
  flag_intl_high_value, flag_new_customer_high_value, risk_score, risk_tier, source_system, ingest_ts,
  CAST(transaction_ts AS DATE) AS txn_date, year(transaction_ts) AS txn_year, month(transaction_ts) AS txn_month,
  '2.0' AS pipeline_version, {TAS} AS silver_ts
FROM x_ft QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC NULLS LAST) = 1"""

# ---- customers ------------------------------------------------------------------------------------

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CODES = "01230127022455012623017202"


def _soundex(c: str) -> str:
    code = (f"translate(substr(upper({c}), 1, 1), '{_LETTERS}', '{_CODES}') || replace(translate("
            f"regexp_replace(upper(substr({c}, 2)), '[^A-Z]', 'A', 'g'), '{_LETTERS}', '{_CODES}'), '7', '')")
    for digit in "0123456":
        code = f"regexp_replace({code}, '{digit}+', '{digit}', 'g')"
    return f"upper(substr({c}, 1, 1)) || rpad(substr(replace(substr({code}, 2), '0', ''), 1, 3), 3, '0')"


def _name(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(nullif({c}, ''))), '\\s+', ' ', 'g'))"


def _dob(c: str) -> str:
    return "CAST(coalesce(" + ", ".join(f"try_strptime({c}, '{f}')" for f in ("%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y")) + ") AS DATE)"


CTE["x_bc"] = X.as_sql(X.BRONZE_CUSTOMERS)
CTE["x_tc"] = f"""
SELECT *, substr(last_name_norm, 1, 3) || '_' || postal_code_norm AS block_key_1, email_normalised AS block_key_2,
  phone_normalised AS block_key_3, nullif(split_part(email_normalised, '@', 2), '') AS email_domain,
  {_soundex('last_name_norm')} AS last_name_soundex, concat_ws(' ', first_name_norm, last_name_norm) AS full_name_norm,
  CASE WHEN age IS NULL THEN 'unknown' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
       WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_band,
  CASE WHEN days_since_registration < 30 THEN 'new_30d' WHEN days_since_registration < 90 THEN 'new_90d'
       WHEN days_since_registration < 365 THEN 'established' ELSE 'loyal' END AS customer_tenure_band
FROM (
 SELECT * REPLACE ({_dob('date_of_birth')} AS date_of_birth, TRY_CAST(registration_ts AS TIMESTAMP) AS registration_ts,
     TRY_CAST(ingest_ts AS TIMESTAMP) AS ingest_ts, TRY_CAST(is_active AS BOOLEAN) AS is_active,
     lower(trim(segment)) AS segment, lower(trim(loyalty_tier)) AS loyalty_tier, lower(trim(gender)) AS gender,
     upper(trim(country)) AS country),
   CASE WHEN contains(em, '@gmail.com') THEN split_part(replace(split_part(em, '@', 1), '.', ''), '+', 1) || substr(em, instr(em, '@'))
        ELSE em END AS email_normalised,
   nullif(right(regexp_replace(phone, '[^0-9]', '', 'g'), 10), '') AS phone_normalised,
   {_name('first_name')} AS first_name_norm, {_name('last_name')} AS last_name_norm,
   regexp_replace(upper(trim(postal_code)), '[^A-Z0-9]', '', 'g') AS postal_code_norm,
   lower(regexp_replace(trim(city), '\\s+', '_', 'g')) AS city_norm,
   CAST(floor(date_diff('day', {_dob('date_of_birth')}, {ODAY}) / 365.25) AS BIGINT) AS age,
   date_diff('day', CAST(TRY_CAST(registration_ts AS TIMESTAMP) AS DATE), {ODAY}) AS days_since_registration
 FROM (SELECT *, lower(regexp_replace(nullif(email, ''), '^\\s+|\\s+$', '', 'g')) AS em FROM x_bc))"""
CUSTOMER_RULES = {
    "null_id": "customer_id IS NULL", "no_contact": "email_normalised IS NULL AND phone_normalised IS NULL",
    "invalid_email": r"email IS NOT NULL AND NOT regexp_matches(email, '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$')",
    "invalid_segment": f"segment IS NOT NULL AND segment NOT IN {_in(S.SEGMENTS)}",
    "future_dob": f"date_of_birth > {ODAY}", "underage": "age IS NOT NULL AND age < 13",
}
CTE["x_cc"] = _checked("x_tc", CUSTOMER_RULES)
CTE["x_sc"] = f"""
SELECT {', '.join(c for c in S.SILVER_CUSTOMERS if c not in ('pipeline_version', 'silver_ts', 'resolved_entity_id', 'er_confidence'))},
  '2.0' AS pipeline_version, {OAS} AS silver_ts, CAST(NULL AS VARCHAR) AS resolved_entity_id, CAST(NULL AS DOUBLE) AS er_confidence
FROM x_cc WHERE ok QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingest_ts DESC NULLS LAST) = 1"""

# ---- staging and marts ----------------------------------------------------------------------------

CTE["x_go"] = """
SELECT * REPLACE (CAST(gross_amount AS DECIMAL(18,2)) AS gross_amount,
    coalesce(CAST(discount_amount AS DECIMAL(18,2)), 0) AS discount_amount,
    coalesce(CAST(discount_pct AS DECIMAL(8,4)), 0) AS discount_pct, CAST(net_amount AS DECIMAL(18,2)) AS net_amount,
    coalesce(item_count, 1) AS item_count),
  coalesce(order_status IN ('delivered', 'shipped'), false) AS is_completed
FROM x_so WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_ts IS NOT NULL AND net_amount >= 0"""
CTE["x_gt"] = """
SELECT * REPLACE (CAST(amount AS DECIMAL(18,2)) AS amount, coalesce(CAST(avg_amount_30d AS DECIMAL(18,2)), 0) AS avg_amount_30d,
    coalesce(CAST(stddev_amount_30d AS DECIMAL(18,2)), 0) AS stddev_amount_30d)
FROM x_st"""


def _order_metrics(source: str) -> str:
    return f"""
SELECT *, CASE WHEN customer_lifespan_days > 30 THEN round(total_orders / (customer_lifespan_days / 30.0), 2)
    ELSE total_orders END AS orders_per_month,
  round(cancelled_orders / nullif(total_orders, 0) * 100, 2) AS cancellation_rate_pct,
  round(refunded_orders / nullif(total_orders, 0) * 100, 2) AS refund_rate_pct
FROM (
SELECT customer_id, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders,
  count(DISTINCT CASE WHEN order_status = 'cancelled' THEN order_id END) AS cancelled_orders,
  count(DISTINCT CASE WHEN order_status = 'refunded' THEN order_id END) AS refunded_orders,
  sum(net_amount) AS total_revenue, CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value,
  max(net_amount) AS max_order_value, min(net_amount) AS min_order_value, sum(discount_amount) AS total_discounts,
  CAST(sum(discount_pct) AS DOUBLE) / count(discount_pct) AS avg_discount_pct,
  CAST(sum(item_count) AS BIGINT) AS total_items, avg(item_count) AS avg_items_per_order,
  count(DISTINCT CASE WHEN is_weekend THEN order_id END) AS weekend_orders,
  count(DISTINCT payment_method) AS distinct_payment_methods, count(DISTINCT shipping_country) AS distinct_shipping_countries,
  max(payment_method) AS most_recent_payment_method, min(order_ts) AS first_order_ts, max(order_ts) AS last_order_ts,
  date_diff('day', min(order_ts), max(order_ts)) AS customer_lifespan_days,
  sum(CASE WHEN order_ts >= {OAS} - INTERVAL 30 DAY THEN net_amount END) AS revenue_last_30d,
  sum(CASE WHEN order_ts >= {OAS} - INTERVAL 90 DAY THEN net_amount END) AS revenue_last_90d,
  count(CASE WHEN order_ts >= {OAS} - INTERVAL 30 DAY THEN 1 END) AS orders_last_30d, {OAS} AS updated_at
FROM {source} GROUP BY customer_id)"""


CTE["x_mo"] = _order_metrics("x_go")
CTE["x_mt"] = f"""
SELECT m.*, coalesce(r.total_refunded, 0) AS total_refunded, coalesce(r.refund_count, 0) AS refund_count,
  gross_txn_revenue - coalesce(r.total_refunded, 0) AS net_txn_revenue, f.total_risk_score, f.high_risk_txn_count,
  f.max_risk_score, f.ever_velocity_spike, f.ever_amount_anomaly,
  round((gross_txn_revenue - coalesce(r.total_refunded, 0)) * CASE WHEN active_days > 180 THEN 2.5 WHEN active_days > 90 THEN 1.8
    WHEN active_days > 30 THEN 1.3 ELSE 1.0 END, 2) AS estimated_ltv, {TAS} AS updated_at
FROM (
 SELECT customer_id, count(DISTINCT transaction_id) AS total_txn_count, count(DISTINCT txn_date) AS active_days,
  sum(amount) AS gross_txn_revenue, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_txn_amount, max(amount) AS max_txn_amount,
  count(CASE WHEN is_international THEN 1 END) AS intl_txn_count,
  round(count(CASE WHEN is_international THEN 1 END) / nullif(count(*), 0) * 100, 2) AS intl_txn_rate_pct,
  count(DISTINCT device_type) AS distinct_devices, max(device_type) AS most_recent_device,
  min(transaction_ts) AS first_txn_ts, max(transaction_ts) AS last_txn_ts
 FROM x_gt WHERE transaction_type = 'purchase' AND status = 'completed' GROUP BY customer_id) m
LEFT JOIN (SELECT customer_id, sum(amount) AS total_refunded, count(*) AS refund_count FROM x_gt
  WHERE transaction_type = 'refund' AND status = 'completed' GROUP BY customer_id) r USING (customer_id)
LEFT JOIN (SELECT customer_id, CAST(sum(risk_score) AS BIGINT) AS total_risk_score,
  count(CASE WHEN risk_tier = 'HIGH' THEN 1 END) AS high_risk_txn_count, max(risk_score) AS max_risk_score,
  bool_or(flag_velocity_spike) AS ever_velocity_spike, bool_or(flag_amount_anomaly) AS ever_amount_anomaly
  FROM x_gt GROUP BY customer_id) f USING (customer_id)"""
CTE["x_gc"] = """
SELECT customer_id, source_system, full_name_norm AS customer_name, email_normalised AS email, phone_normalised AS phone,
  last_name_soundex, city, state_province, postal_code, country, age, age_band, segment, loyalty_tier, is_active, registration_ts,
  days_since_registration, customer_tenure_band, coalesce(resolved_entity_id, customer_id) AS resolved_entity_id, er_confidence,
  silver_ts, pipeline_version
FROM x_sc"""
CTE["x_360"] = f"""
SELECT customer_id, resolved_entity_id, customer_name, email, phone, country, city, age_band, segment, loyalty_tier, is_active,
  registration_ts, customer_tenure_band, days_since_registration,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('total_orders', 'delivered_orders', 'cancelled_orders', 'refunded_orders'))},
  coalesce(total_revenue, 0) AS total_order_revenue, coalesce(avg_order_value, 0) AS avg_order_value,
  coalesce(total_items, 0) AS total_items_ordered,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('cancellation_rate_pct', 'refund_rate_pct', 'orders_per_month', 'revenue_last_30d', 'revenue_last_90d', 'orders_last_30d'))},
  first_order_ts, last_order_ts, customer_lifespan_days, most_recent_payment_method,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('total_txn_count', 'gross_txn_revenue', 'net_txn_revenue', 'avg_txn_amount'))},
  coalesce(refund_count, 0) AS txn_refund_count, coalesce(total_refunded, 0) AS total_refunded,
  coalesce(intl_txn_rate_pct, 0) AS intl_txn_rate_pct, most_recent_device, first_txn_ts, last_txn_ts,
  coalesce(estimated_ltv, 0) AS estimated_ltv, coalesce(total_risk_score, 0) AS total_risk_score,
  coalesce(high_risk_txn_count, 0) AS high_risk_txn_count, coalesce(ever_velocity_spike, false) AS ever_velocity_spike,
  coalesce(ever_amount_anomaly, false) AS ever_amount_anomaly,
  CASE WHEN coalesce(estimated_ltv, 0) >= 10000 THEN 'platinum' WHEN coalesce(estimated_ltv, 0) >= 5000 THEN 'gold'
    WHEN coalesce(estimated_ltv, 0) >= 1000 THEN 'silver' WHEN coalesce(estimated_ltv, 0) >= 100 THEN 'bronze' ELSE 'new' END AS ltv_tier,
  CASE WHEN coalesce(orders_last_30d, 0) = 0 AND coalesce(total_orders, 0) > 3 THEN 'at_risk'
    WHEN coalesce(last_order_ts, TIMESTAMP '2000-01-01') < {OAS} - INTERVAL 90 DAY THEN 'churned'
    WHEN coalesce(orders_per_month, 0) >= 2 THEN 'loyal' ELSE 'active' END AS churn_status,
  source_system, er_confidence, {OAS} AS mart_updated_at
FROM x_gc LEFT JOIN (SELECT * EXCLUDE (updated_at) FROM x_mo) USING (customer_id)
LEFT JOIN (SELECT * EXCLUDE (updated_at) FROM x_mt) USING (customer_id)"""
CTE["x_md"] = f"""
SELECT order_date, order_year, order_month, is_weekend, shipping_country, currency, order_status,
  count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS unique_customers, sum(gross_amount) AS gross_revenue,
  sum(discount_amount) AS total_discounts, sum(net_amount) AS net_revenue,
  CAST(sum(net_amount) AS DOUBLE) / count(net_amount) AS avg_order_value, max(net_amount) AS max_order_value,
  CAST(sum(item_count) AS BIGINT) AS total_items, avg(item_count) AS avg_items_per_order,
  CAST(sum(discount_pct) AS DOUBLE) / count(discount_pct) AS avg_discount_pct,
  count(CASE WHEN discount_amount > 0 THEN 1 END) AS discounted_orders,
  count(DISTINCT CASE WHEN order_date = first_order_date THEN customer_id END) AS new_customers,
  count(DISTINCT CASE WHEN order_date > first_order_date THEN customer_id END) AS returning_customers, {OAS} AS mart_updated_at
FROM x_go LEFT JOIN (SELECT customer_id, min(order_date) AS first_order_date FROM x_go GROUP BY customer_id) USING (customer_id)
GROUP BY ALL"""
CTE["x_mf"] = f"""
SELECT txn_date, txn_year, txn_month, risk_tier, merchant_category, is_international, device_type,
  count(DISTINCT transaction_id) AS txn_count, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT merchant_id) AS unique_merchants, sum(amount) AS total_amount, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount,
  count(CASE WHEN flag_high_value THEN 1 END) AS high_value_count, count(CASE WHEN flag_velocity_spike THEN 1 END) AS velocity_spike_count,
  count(CASE WHEN flag_amount_anomaly THEN 1 END) AS amount_anomaly_count,
  count(CASE WHEN flag_intl_high_value THEN 1 END) AS intl_high_value_count,
  count(CASE WHEN flag_new_customer_high_value THEN 1 END) AS new_cust_high_value_count,
  count(CASE WHEN risk_score > 0 THEN 1 END) AS flagged_txn_count, count(CASE WHEN risk_tier = 'HIGH' THEN 1 END) AS high_risk_count,
  round(count(CASE WHEN risk_score > 0 THEN 1 END) / nullif(count(*), 0) * 100, 2) AS flag_rate_pct,
  round(count(CASE WHEN risk_tier = 'HIGH' THEN 1 END) / nullif(count(*), 0) * 100, 2) AS high_risk_rate_pct,
  sum(CASE WHEN risk_score > 0 THEN amount ELSE 0 END) AS amount_at_risk, avg(txn_velocity_1h) AS avg_velocity_1h,
  max(txn_velocity_1h) AS max_velocity_1h, {TAS} AS mart_updated_at
FROM x_gt GROUP BY ALL"""

# ---- entity resolution ----------------------------------------------------------------------------

CTE["x_node"] = """
SELECT source_system AS source, email_normalised AS email, phone_normalised AS phone, last_name_soundex AS soundex,
  postal_code_norm AS postal, country, full_name_norm AS name, age, block_key_1 AS k1, min(customer_id) AS id, count(*) AS n
FROM x_sc GROUP BY ALL"""
_PAIR = ", ".join(f"{s}.{c} AS {c}_{s}" for s in "ab" for c in ("id", "n", "email", "phone", "soundex", "postal", "country", "name", "age", "k1"))
CTE["x_blocked"] = " UNION ".join(
    f"SELECT {_PAIR} FROM x_node a JOIN x_node b ON a.{c} = b.{c} AND a.id < b.id AND a.source <> b.source"
    for c in BLOCKS.values())
CTE["x_scored"] = f"""
SELECT *, least(rule_score / 17.0, 1.0) AS match_probability, least(rule_score / 17.0, 1.0) >= 0.75 AS is_match FROM (
 SELECT *, 5 * CAST(email_match AS INT) + 4 * CAST(phone_match AS INT) + 2 * CAST(soundex_match AS INT) + CAST(postal_match AS INT)
  + CAST(country_match AS INT) + CAST(age_match AS INT) + 3 * name_similarity AS rule_score FROM (
  SELECT *, {', '.join(f'coalesce({c}_a = {c}_b, false) AS {c}_match' for c in ('email', 'phone', 'soundex', 'postal', 'country'))},
   concat_ws(',', {', '.join(f"CASE WHEN {c}_a = {c}_b THEN '{name}' END" for name, c in BLOCKS.items())}) AS block_sources,
   CASE WHEN email_a = email_b THEN 3 WHEN phone_a = phone_b THEN 2 ELSE 1 END AS block_strength,
   coalesce(abs(age_a - age_b), 99) AS age_diff, coalesce(abs(age_a - age_b), 99) <= 2 AS age_match,
   CASE WHEN length(name_a) > 0 AND length(name_b) > 0 THEN jaro_winkler_similarity(name_a, name_b) ELSE 0.0 END AS name_similarity
  FROM x_blocked))"""
# the smallest field sets that decide a match, and those a match must have
_SURE_SETS = threshold_signatures(0.75, certain=True)
_SURE = " OR ".join("(" + " AND ".join(f"coalesce({c}_a = {c}_b, false)" for c in s) + ")" for s in _SURE_SETS)
_REACHABLE = "(" + " OR ".join("(" + " AND ".join(f"{c}_match" for c in s) + ")" for s in threshold_signatures(0.75)) + ")"
for _i, _set in enumerate(_SURE_SETS):
    _keys = ", ".join(_set)
    CTE[f"x_ends{_i}"] = f"""
SELECT {_keys}, first(source ORDER BY source, id) AS ls, first(id ORDER BY source, id) AS li,
  first(source ORDER BY source DESC, id DESC) AS hs, first(id ORDER BY source DESC, id DESC) AS hi
FROM x_node WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _set)} GROUP BY {_keys} HAVING min(source) < max(source)"""
CTE["x_sure"] = "SELECT DISTINCT least(id, other) AS id_a, greatest(id, other) AS id_b FROM (" + " UNION ALL ".join(
    f"SELECT id, CASE WHEN source = ls THEN hi ELSE li END AS other FROM x_node JOIN x_ends{i} USING ({', '.join(c)})"
    for i, c in enumerate(_SURE_SETS)) + ")"


def _components(edges: str) -> tuple[str, str]:
    both = f"SELECT id_a AS u, id_b AS v FROM {edges} UNION SELECT id_b, id_a FROM {edges}"
    return both, "SELECT u AS id, u AS r FROM {b} UNION SELECT x.id, e.v FROM {r} x JOIN {b} e ON x.r = e.u"


for tag, threshold in (("hi", 0.75), ("lo", 0.6)):
    CTE[f"x_edge_{tag}"] = f"SELECT id_a, id_b FROM x_scored WHERE match_probability >= {threshold}"
    both, reach = _components(f"x_edge_{tag}")
    CTE[f"x_both_{tag}"] = both
    CTE[f"x_reach_{tag}"] = reach.format(b=f"x_both_{tag}", r=f"x_reach_{tag}")
    CTE[f"x_comp_{tag}"] = f"SELECT id, min(r) AS component FROM x_reach_{tag} GROUP BY id"
CTE["x_emap"] = f"""
SELECT s.customer_id, coalesce(c.component, s.customer_id) AS component, 'ent_' || coalesce(c.component, s.customer_id) AS resolved_entity_id,
  source_system, full_name_norm, email_normalised, s.country,
  CASE WHEN c.component IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY coalesce(c.component, s.customer_id)) END AS cluster_size,
  CASE WHEN c.component IS NULL THEN 1.0 ELSE 0.75 END AS er_confidence, {ODAY} AS er_run_date, {OAS} AS er_updated_at
FROM x_sc s JOIN x_node n ON n.source = s.source_system AND n.email IS NOT DISTINCT FROM s.email_normalised
  AND n.phone IS NOT DISTINCT FROM s.phone_normalised AND n.soundex IS NOT DISTINCT FROM s.last_name_soundex
  AND n.postal IS NOT DISTINCT FROM s.postal_code_norm AND n.country IS NOT DISTINCT FROM s.country
  AND n.name IS NOT DISTINCT FROM s.full_name_norm AND n.age IS NOT DISTINCT FROM s.age AND n.k1 IS NOT DISTINCT FROM s.block_key_1
LEFT JOIN x_comp_hi c ON c.id = n.id"""

# ---- graph ----------------------------------------------------------------------------------------

CTE["x_placed"] = "SELECT DISTINCT order_id, customer_id FROM x_so WHERE customer_id IN (SELECT customer_id FROM x_emap)"
CTE["x_paid"] = """SELECT DISTINCT order_id, merchant_id FROM x_so
WHERE merchant_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM x_emap)"""
CTE["x_made"] = "SELECT DISTINCT transaction_id, customer_id FROM x_st WHERE customer_id IN (SELECT customer_id FROM x_emap)"
CTE["x_at"] = """SELECT DISTINCT transaction_id, merchant_id FROM x_st
WHERE merchant_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM x_emap)"""
CTE["x_merch"] = """
SELECT merchant_id, max(c) AS merchant_category FROM (
  SELECT merchant_id, NULL AS c FROM x_paid UNION ALL
  SELECT merchant_id, last(merchant_category ORDER BY transaction_ts, transaction_id) FROM x_st
  WHERE customer_id IN (SELECT customer_id FROM x_emap) GROUP BY merchant_id) GROUP BY merchant_id"""
CTE["x_contains"] = "SELECT DISTINCT l_orderkey AS order_id, l_partkey AS product_id FROM lineitem"
CTE["x_os"] = "SELECT customer_id, count(*) AS total_orders, sum(net_amount) AS total_spend FROM x_placed JOIN x_so USING (order_id, customer_id) GROUP BY customer_id"
CTE["x_ts"] = "SELECT customer_id, count(*) AS total_transactions, avg(amount) AS avg_txn_amount FROM x_made JOIN x_st USING (transaction_id, customer_id) GROUP BY customer_id"
CTE["x_ms"] = "SELECT customer_id, count(DISTINCT merchant_id) AS distinct_merchants FROM x_placed JOIN x_paid USING (order_id) GROUP BY customer_id"
CTE["x_g360"] = """
SELECT e.customer_id, e.resolved_entity_id AS entity_id, e.full_name_norm AS name, ltv_tier, churn_status,
  coalesce(x_os.total_orders, 0) AS total_orders, total_spend, coalesce(distinct_merchants, 0) AS distinct_merchants,
  coalesce(total_transactions, 0) AS total_transactions, x_ts.avg_txn_amount, e.cluster_size - 1 AS linked_profiles
FROM x_emap e LEFT JOIN x_360 USING (customer_id) LEFT JOIN x_os USING (customer_id) LEFT JOIN x_ms USING (customer_id)
LEFT JOIN x_ts USING (customer_id)"""

# order network of the given tables
CTE["n_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, m AS merchant_id, CAST(o_totalprice AS DECIMAL(18,2)) AS net_amount,
  CAST(o_orderdate AS DATE) AS order_date
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""
CTE["n_people"] = """
SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS ltv_tier, last_order_date, total_spend, total_spend AS estimated_ltv,
  CASE WHEN last_order_date < DATE '2001-05-01' THEN 'at_risk' ELSE 'active' END AS churn_status
FROM customer LEFT JOIN (SELECT customer_id, max(order_date) AS last_order_date, sum(net_amount) AS total_spend FROM n_orders GROUP BY 1)
  ON customer_id = c_custkey"""
CTE["n_cm"] = """SELECT DISTINCT customer_id, merchant_id FROM n_orders JOIN customer ON c_custkey = customer_id WHERE merchant_id IS NOT NULL"""

# ---- dimensions -----------------------------------------------------------------------------------

_TRACKED = ("resolved_entity_id, full_name_norm AS full_name, email_normalised, phone_normalised, country, city, state_province, "
            "postal_code, age_band, customer_tenure_band, segment, loyalty_tier, is_active, registration_ts")
CTE["d_people"] = """SELECT s.* REPLACE (e.resolved_entity_id AS resolved_entity_id, e.er_confidence AS er_confidence)
FROM x_sc s JOIN x_emap e USING (customer_id)"""
CTE["d_cust"] = f"""
SELECT *, md5(customer_id || '|' || CAST(valid_from AS VARCHAR)) AS customer_sk FROM (
 SELECT customer_id, {_TRACKED}, TIMESTAMP '1995-01-01' AS valid_from,
  CASE WHEN segment = 'vip' AND loyalty_tier <> 'platinum' THEN TIMESTAMP '1999-01-01' END AS valid_to,
  NOT coalesce(segment = 'vip' AND loyalty_tier <> 'platinum', false) AS is_current FROM d_people
 UNION ALL
 SELECT customer_id, {_TRACKED.replace('loyalty_tier,', "'platinum',")}, TIMESTAMP '1999-01-01', NULL, true
 FROM d_people WHERE segment = 'vip' AND loyalty_tier <> 'platinum')"""
CTE["d_merch"] = """
SELECT *, md5(merchant_id || '|' || CAST(valid_from AS VARCHAR)) AS merchant_sk FROM (
 SELECT merchant_id, CAST(NULL AS VARCHAR) AS merchant_name, last(merchant_category ORDER BY transaction_ts, transaction_id) AS merchant_category,
  CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS city, true AS is_active,
  CASE WHEN bool_or(risk_tier = 'HIGH') THEN 'HIGH' WHEN bool_or(risk_tier = 'MEDIUM') THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  TIMESTAMP '1995-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
 FROM x_st GROUP BY merchant_id)"""
_PAY = " ".join(f"WHEN payment_method = '{code}' THEN {sk}" for sk, code, *_ in PAYMENT_ROWS)
PAYMENT_SK = f"CASE WHEN payment_method IS NULL THEN -1 {_PAY} ELSE 99 END"
CTE["f_orders"] = f"""
SELECT md5(order_id) AS order_sk, order_id, coalesce(c.customer_sk, '-1') AS customer_sk, coalesce(m.merchant_sk, '-1') AS merchant_sk,
  CAST(strftime(order_date, '%Y%m%d') AS INT) AS order_date_sk, {PAYMENT_SK} AS payment_method_sk, order_status, gross_amount,
  discount_amount, discount_pct, net_amount, item_count, currency, shipping_country, order_ts, pipeline_version, {OAS} AS loaded_at
FROM x_go o LEFT JOIN d_cust c ON c.customer_id = o.customer_id
  AND (c.valid_from = TIMESTAMP '1995-01-01' OR o.order_ts >= c.valid_from) AND (c.valid_to IS NULL OR o.order_ts < c.valid_to)
LEFT JOIN d_merch m ON m.merchant_id = o.merchant_id"""
CTE["f_txns"] = f"""
SELECT md5(transaction_id) AS transaction_sk, transaction_id, order_id, coalesce(c.customer_sk, '-1') AS customer_sk,
  coalesce(m.merchant_sk, '-1') AS merchant_sk, CAST(strftime(txn_date, '%Y%m%d') AS INT) AS txn_date_sk, {PAYMENT_SK} AS payment_method_sk,
  transaction_type, status, amount, currency, is_international, ip_country, device_type, txn_velocity_1h, risk_score, t.risk_tier,
  flag_high_value, flag_velocity_spike, flag_amount_anomaly, transaction_ts, pipeline_version, {TAS} AS loaded_at
FROM x_gt t LEFT JOIN d_cust c ON c.customer_id = t.customer_id AND t.transaction_ts >= c.valid_from
  AND (c.valid_to IS NULL OR t.transaction_ts < c.valid_to)
LEFT JOIN d_merch m ON m.merchant_id = t.merchant_id AND t.transaction_ts >= m.valid_from"""

# ---- arrived files --------------------------------------------------------------------------------

CTE["a_files"] = """
SELECT CASE event_id % 4 WHEN 0 THEN 'bronze/ecommerce/orders' WHEN 1 THEN 'bronze/financial/transactions'
    WHEN 2 THEN 'bronze/ecommerce/unknown' ELSE 'bronze/financial/merchants' END || '/' ||
  CASE WHEN event_id % 19 = 0 THEN 'latest' ELSE 'date=' || CAST(CAST(ts AS DATE) AS VARCHAR) END || '/hour%3D01/part-' ||
  CAST(event_id AS VARCHAR) || CASE WHEN event_id % 13 = 0 THEN '.keep' ELSE '.parquet' END AS path,
  event_id % 1000 AS length, ts AS m, event_id,
  CASE WHEN event_id % 19 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS execution_date,
  CASE event_id % 4 WHEN 0 THEN 'orders' WHEN 1 THEN 'transactions' WHEN 3 THEN 'merchants' END AS domain
FROM events"""
CTE["a_manifest"] = """
SELECT *, '01' AS hour, 'part-' || CAST(event_id AS VARCHAR) || CASE WHEN event_id % 13 = 0 THEN '.keep' ELSE '.parquet' END AS file_name,
  CASE WHEN event_id % 13 = 0 THEN 'not_parquet' WHEN length < 100 THEN 'too_small' WHEN domain IS NULL THEN 'unknown_domain'
    WHEN execution_date IS NULL THEN 'no_date' END AS reason FROM a_files"""

ORDER = list(CTE)


def _statement(body: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTE[name])

    visit(body)
    if not needed:
        return body
    recursive = "RECURSIVE " if any(n.startswith("x_reach") for n in needed) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({CTE[n]})" for n in ORDER if n in needed) + f"\n{body}"


def portable(body: str, nums: str = "", text: str = "") -> str:
    """Numbers as doubles with four digits, times as text."""
    changes = [f"round(CAST({c} AS DOUBLE) + 1e-9, 4) + 0.0 AS {c}" for c in nums.split()]
    changes += [f"CAST({c} AS VARCHAR) AS {c}" for c in text.split()]
    replaced = f" REPLACE ({', '.join(changes)})" if changes else ""
    return _statement(f"SELECT *{replaced} FROM ({body})")


ORACLES: dict[str, str] = {}


def add(name: str, body: str, nums: str = "", text: str = "") -> None:
    ORACLES[name] = portable(body, nums, text)


# ---- silver ---------------------------------------------------------------------------------------

add("silver_orders", "SELECT * FROM x_so", "gross_amount discount_amount discount_pct net_amount",
    "order_ts updated_ts order_date ingest_ts silver_ts")
add("orders_quarantine", "SELECT order_id, customer_id, order_status, order_ts, gross_amount, item_count, "
    + ", ".join(f"_err_{r}" for r in ORDER_RULES) + " FROM x_co WHERE NOT ok", "gross_amount", "order_ts")


def _rule_counts(checked: str, rules) -> str:
    return " UNION ALL ".join(f"SELECT '{r}' AS rule, count(CASE WHEN _err_{r} THEN 1 END) AS n FROM {checked} WHERE NOT ok" for r in rules)


add("orders_rule_counts", _rule_counts("x_co", ORDER_RULES))
add("transactions_rule_counts", _rule_counts("x_ct", TXN_RULES))
add("customers_rule_counts", _rule_counts("x_cc", CUSTOMER_RULES))
add("orders_error_mask", "SELECT mask, count(*) AS n FROM (SELECT " + " + ".join(
    f"{1 << i} * CAST(coalesce(_err_{r}, false) AS INT)" for i, r in enumerate(ORDER_RULES)) + " AS mask FROM x_co) GROUP BY mask")
add("orders_unknown_policies", " UNION ALL ".join(
    f"SELECT count(*) AS raw_count, count(CASE WHEN {c} THEN 1 END) AS clean_count, count(CASE WHEN NOT {c} THEN 1 END) AS quarantine_count, "
    f"count(CASE WHEN {c} IS NULL THEN 1 END) AS unknown_count, '{p}' AS policy FROM x_co"
    for p, c in (("pass", "ok"), ("quarantine", "ok_strict"), ("drop", "ok3"))))
add("orders_run_metrics", """
SELECT *, round(quarantine_count / raw_count * 100, 2) AS quarantine_rate_pct, round(dupes_removed / clean_count * 100, 2) AS dupe_rate_pct FROM (
 SELECT *, clean_count - silver_count AS dupes_removed FROM (
  SELECT count(*) AS raw_count, count(CASE WHEN NOT ok THEN 1 END) AS quarantine_count, count(CASE WHEN ok THEN 1 END) AS clean_count,
   0 AS unknown_count, (SELECT count(*) FROM x_so) AS silver_count FROM x_co))""", "quarantine_rate_pct dupe_rate_pct")
add("silver_transactions_fraud", "SELECT * FROM x_st", "amount avg_amount_30d stddev_amount_30d",
    "transaction_ts ingest_ts txn_date silver_ts")
add("silver_transactions_first_run", "SELECT transaction_id, txn_velocity_1h, txn_count_30d, flag_new_customer_high_value, risk_score, risk_tier FROM ("
    + _flagged("x_ht", None) + ")")
add("transactions_compat", "SELECT transaction_id, txn_count_30d, flag_intl_high_value, flag_new_customer_high_value, risk_score, risk_tier FROM ("
    + _flagged("(SELECT * FROM x_ct WHERE ok3)", "x_bl", True)
    + ") QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_ts DESC NULLS LAST) = 1")
add("fraud_baseline", "SELECT * FROM x_bl", "avg_amount_30d stddev_amount_30d")
add("fraud_baseline_from_days", """SELECT customer_id, CAST(total AS DOUBLE) / k AS avg_amount_30d,
 CASE WHEN k > 1 THEN sqrt(CAST(k * squares - total * total AS DOUBLE) / (CAST(k AS DOUBLE) * (k - 1))) END AS stddev_amount_30d, n AS txn_count_30d
FROM (SELECT customer_id, count(*) AS n, count(amount) AS k, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total,
  CAST(sum(CAST(amount AS DECIMAL(9,2)) * CAST(amount AS DECIMAL(9,2))) AS DECIMAL(18,4)) AS squares
 FROM x_ht WHERE transaction_ts >= TIMESTAMP '2023-12-29' AND transaction_ts < TIMESTAMP '2024-01-28' GROUP BY 1)""", "avg_amount_30d stddev_amount_30d")
add("txn_velocity", f"SELECT DISTINCT customer_id, CAST(epoch(transaction_ts) AS BIGINT) AS second, {_velocity(6 * 3600)} AS txn_velocity_1h FROM x_ht")
add("transactions_run_metrics", """
SELECT *, round(flagged_count / raw_count * 100, 2) AS flag_rate_pct FROM (
 SELECT count(*) AS raw_count, count(CASE WHEN NOT ok THEN 1 END) AS quarantine_count, 0 AS unknown_count,
  (SELECT count(*) FROM x_st) AS silver_count, (SELECT count(*) FROM x_st WHERE risk_tier = 'HIGH') AS high_risk_count,
  (SELECT count(*) FROM x_st WHERE risk_score > 0) AS flagged_count FROM x_ct)""", "flag_rate_pct")
add("silver_customers", "SELECT * FROM x_sc", "er_confidence", "date_of_birth registration_ts ingest_ts silver_ts")
add("customer_block_keys", """SELECT customer_id, block_key_1, block_key_2, block_key_3, email_domain, last_name_soundex,
 '***@' || split_part(email_normalised, '@', 2) AS email_masked FROM x_sc""")
add("customers_run_metrics", """SELECT *, raw_count - er_ready_count AS no_contact_info FROM (
 SELECT count(*) AS raw_count, count(CASE WHEN NOT ok THEN 1 END) AS quarantine_count, 0 AS unknown_count,
  (SELECT count(*) FROM x_sc) AS silver_count,
  (SELECT count(*) FROM x_sc WHERE block_key_2 IS NOT NULL OR block_key_3 IS NOT NULL) AS er_ready_count FROM x_cc)""")

# ---- dedup, merge ---------------------------------------------------------------------------------

add("latest_order_per_customer", """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""", "o_totalprice", "o_orderdate")
_CUT = "TIMESTAMP '2001-01-01'"
_CHANGED = f"o_orderdate < {_CUT} AND o_orderpriority = '1-URGENT'"
add("upsert", f"SELECT * REPLACE (CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders", "o_totalprice", "o_orderdate")
add("upsert_keep", "SELECT * FROM orders", "o_totalprice", "o_orderdate")
add("insert_new", f"SELECT * FROM orders WHERE o_orderdate >= {_CUT}", "o_totalprice", "o_orderdate")
add("update_columns", f"SELECT * REPLACE (CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderdate < {_CUT}",
    "o_totalprice", "o_orderdate")
add("append_new_columns", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS VARCHAR) AS batch
FROM orders WHERE o_orderdate < {_CUT}
UNION ALL SELECT o_orderkey, o_custkey, CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END, o_totalprice, o_orderdate, o_orderpriority, 'b1'
FROM orders WHERE {_CHANGED} OR o_orderdate >= {_CUT}""", "o_totalprice", "o_orderdate")
add("newer_than_mark", f"SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < {_CUT})",
    "o_totalprice", "o_orderdate")
add("incremental_order_metrics", "SELECT customer_id, total_orders, total_revenue, revenue_last_90d, last_order_ts FROM x_mo",
    "total_revenue revenue_last_90d", "last_order_ts")
add("scd2_customers", """
SELECT *, md5(CAST(customer_id AS VARCHAR) || '|' || CAST(valid_from AS VARCHAR)) AS sk FROM (
 SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_nationkey AS nation, TIMESTAMP '2001-01-01' AS valid_from,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN TIMESTAMP '2001-06-01' END AS valid_to, c_mktsegment <> 'FURNITURE' AS is_current FROM customer
 UNION ALL SELECT c_custkey, 'HOME', c_nationkey, TIMESTAMP '2001-06-01', NULL, true FROM customer WHERE c_mktsegment = 'FURNITURE')""",
    "", "valid_from valid_to")

# ---- marts ----------------------------------------------------------------------------------------

_MONEY_O = "gross_amount discount_amount discount_pct net_amount"
add("stg_orders", "SELECT * FROM x_go", _MONEY_O, "order_ts updated_ts order_date ingest_ts silver_ts")
add("stg_transactions", "SELECT * REPLACE (round(avg_amount_30d, 1) AS avg_amount_30d, round(stddev_amount_30d, 1) AS stddev_amount_30d) FROM x_gt", "amount avg_amount_30d stddev_amount_30d", "transaction_ts ingest_ts txn_date silver_ts")
add("stg_customers", "SELECT g.* REPLACE (e.resolved_entity_id AS resolved_entity_id, e.er_confidence AS er_confidence) "
    "FROM x_gc g JOIN x_emap e USING (customer_id)", "er_confidence", "registration_ts silver_ts")
_MO_NUM = ("total_revenue avg_order_value max_order_value min_order_value total_discounts avg_discount_pct avg_items_per_order "
           "orders_per_month cancellation_rate_pct refund_rate_pct revenue_last_30d revenue_last_90d")
for _name in ("customer_order_metrics", "customer_order_metrics_distinct"):
    add(_name, "SELECT * FROM x_mo", _MO_NUM, "first_order_ts last_order_ts updated_at")
add("customer_txn_metrics", "SELECT * FROM x_mt",
    "gross_txn_revenue avg_txn_amount max_txn_amount intl_txn_rate_pct total_refunded net_txn_revenue estimated_ltv",
    "first_txn_ts last_txn_ts updated_at")
_360_NUM = ("total_order_revenue avg_order_value cancellation_rate_pct refund_rate_pct orders_per_month revenue_last_30d revenue_last_90d "
            "gross_txn_revenue net_txn_revenue avg_txn_amount total_refunded intl_txn_rate_pct estimated_ltv er_confidence")
_360_TS = "registration_ts first_order_ts last_order_ts first_txn_ts last_txn_ts mart_updated_at"
add("customer_360", "SELECT * FROM x_360", _360_NUM, _360_TS)
_MD_NUM = "gross_revenue total_discounts net_revenue avg_order_value max_order_value avg_items_per_order avg_discount_pct"
add("daily_order_summary", "SELECT * FROM x_md", _MD_NUM, "order_date mart_updated_at")
add("fraud_summary", "SELECT * FROM x_mf",
    "total_amount avg_amount flag_rate_pct high_risk_rate_pct amount_at_risk avg_velocity_1h", "txn_date mart_updated_at")
add("vw_customer_segments", """SELECT country, ltv_tier, churn_status, segment, loyalty_tier, count(*) AS customer_count,
 avg(CAST(estimated_ltv AS DOUBLE)) AS avg_ltv, sum(estimated_ltv) AS total_ltv, avg(total_orders) AS avg_orders,
 avg(CAST(revenue_last_30d AS DOUBLE)) AS avg_revenue_30d, count(CASE WHEN ever_velocity_spike THEN 1 END) AS risky_customers
FROM x_360 WHERE is_active GROUP BY ALL""", "avg_ltv total_ltv avg_orders avg_revenue_30d")
add("vw_revenue_trend", f"""SELECT *, avg(CAST(net_revenue AS DOUBLE)) OVER (PARTITION BY shipping_country ORDER BY order_date
  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_7d_rolling_avg FROM (
 SELECT order_date, shipping_country, sum(net_revenue) AS net_revenue, CAST(sum(order_count) AS BIGINT) AS order_count,
  CAST(sum(unique_customers) AS BIGINT) AS unique_customers, avg(avg_order_value) AS avg_order_value, CAST(sum(new_customers) AS BIGINT) AS new_customers
 FROM x_md WHERE order_date >= {ODAY} - INTERVAL 90 DAY GROUP BY ALL)""", "net_revenue avg_order_value revenue_7d_rolling_avg", "order_date")
_DASH = f"""SELECT txn_date, risk_tier, merchant_category, CAST(sum(txn_count) AS BIGINT) AS total_txns, CAST(sum(flagged_txn_count) AS BIGINT) AS total_flagged,
 CAST(sum(high_risk_count) AS BIGINT) AS total_high_risk, sum(amount_at_risk) AS total_amount_at_risk, avg(flag_rate_pct) AS avg_flag_rate,
 avg(high_risk_rate_pct) AS avg_high_risk_rate FROM x_mf WHERE txn_date >= {TDAY} - INTERVAL 90 DAY GROUP BY ALL"""
_DASH_NUM = "total_amount_at_risk avg_flag_rate avg_high_risk_rate"
add("vw_fraud_dashboard", f"""SELECT *, total_high_risk - high_risk_count_prev_week AS high_risk_wow_change FROM (
 SELECT *, lag(total_high_risk, 7) OVER (PARTITION BY risk_tier ORDER BY txn_date, merchant_category) AS high_risk_count_prev_week FROM ({_DASH}))""",
    _DASH_NUM, "txn_date")
add("vw_fraud_dashboard_calendar", f"""SELECT a.*, b.total_high_risk AS high_risk_count_prev_week, a.total_high_risk - b.total_high_risk AS high_risk_wow_change
FROM ({_DASH}) a LEFT JOIN ({_DASH}) b ON b.risk_tier = a.risk_tier AND b.merchant_category = a.merchant_category
 AND b.txn_date = a.txn_date - INTERVAL 7 DAY""", _DASH_NUM, "txn_date")
add("vw_executive_summary", """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(net_revenue) AS monthly_revenue,
 CAST(sum(order_count) AS BIGINT) AS monthly_orders, CAST(sum(unique_customers) AS BIGINT) AS monthly_active_customers,
 CAST(sum(new_customers) AS BIGINT) AS monthly_new_customers, round(sum(new_customers) / nullif(sum(unique_customers), 0) * 100, 1) AS new_customer_rate_pct
FROM x_md GROUP BY 1""", "monthly_revenue new_customer_rate_pct", "month")
add("monthly_active_customers", "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT customer_id) AS active_customers FROM x_go GROUP BY 1",
    "", "month")

add("monthly_active_rollup", "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT customer_id) AS active_customers FROM x_go GROUP BY 1",
    "", "month")

# ---- entity resolution ----------------------------------------------------------------------------

add("er_source_systems", "SELECT DISTINCT source_system FROM x_sc")


def _block_join(key: str) -> str:
    return f"FROM x_sc a JOIN x_sc b ON a.{key} = b.{key} AND a.customer_id < b.customer_id AND a.source_system <> b.source_system"


add("er_blocking_counts", " UNION ALL ".join(
    f"SELECT '{k}' AS keys, (SELECT count(*) {_block_join(k)}) AS pairs, max(n) AS largest_block FROM (SELECT count(*) AS n FROM x_sc WHERE {k} IS NOT NULL GROUP BY {k})"
    for k in BLOCKS))
_ALL_PAIRS = " UNION ".join(f"SELECT a.customer_id AS a, b.customer_id AS b {_block_join(k)}" for k in BLOCKS)
_RATIO = f"SELECT (SELECT count(*) FROM x_sc) AS total_customers, (SELECT count(*) FROM ({_ALL_PAIRS})) AS candidate_pairs"
add("er_reduction_ratio", f"SELECT *, total_customers * total_customers / 2.0 / nullif(candidate_pairs, 0) AS reduction_factor FROM ({_RATIO})", "reduction_factor")
_SCORES = ("id_a, id_b, n_a, n_b, block_sources, block_strength, email_match, phone_match, soundex_match, postal_match, country_match, age_match, "
           "age_diff, name_similarity, rule_score, match_probability, is_match")
_SCORE_NUM = "name_similarity rule_score match_probability"
add("er_candidate_pairs", f"SELECT id_a, id_b, n_a, n_b, block_sources, block_strength FROM x_scored WHERE {_REACHABLE}")
add("er_scored_pairs", f"SELECT {_SCORES} FROM x_scored WHERE {_REACHABLE}", _SCORE_NUM)
add("er_matches", f"""SELECT {_SCORES} FROM x_scored WHERE is_match AND (NOT ({_SURE}) OR (id_a, id_b) IN (SELECT (id_a, id_b) FROM x_sure))""", _SCORE_NUM)
add("er_components", "SELECT id, coalesce(component, id) AS component FROM x_node LEFT JOIN x_comp_lo USING (id)")
add("er_components_two_days", "SELECT id, coalesce(component, id) AS component FROM x_node LEFT JOIN x_comp_lo USING (id)")
add("er_resolved", "SELECT * FROM x_emap", "er_confidence", "er_run_date er_updated_at")
add("er_metrics", f"""SELECT *, total_customers * total_customers / 2.0 / nullif(candidate_pairs, 0) AS reduction_factor,
 CAST((SELECT sum(n_a * n_b) FROM x_scored WHERE is_match) AS BIGINT) AS matched_pairs,
 (SELECT count(DISTINCT component) FROM x_emap) AS unique_entities,
 (SELECT count(DISTINCT component) FROM x_emap WHERE cluster_size > 1) AS multi_member_clusters, 0.75 AS match_threshold
FROM ({_RATIO})""", "reduction_factor match_threshold")
add("er_write_back", "SELECT customer_id, resolved_entity_id, er_confidence FROM x_emap", "er_confidence")

# ---- graph ----------------------------------------------------------------------------------------

for _name, _factor in (("graph_metrics", "1"), ("graph_metrics_compat", "greatest(coalesce(total_transactions, 0), 1)")):
    add(_name, f"""SELECT customer_id, coalesce(total_orders, 0) AS graph_order_count, coalesce(total_transactions, 0) AS graph_txn_count,
 coalesce(total_spend, 0) * {_factor} AS graph_total_spend FROM x_emap LEFT JOIN x_os USING (customer_id) LEFT JOIN x_ts USING (customer_id)""",
        "graph_total_spend")
add("graph_customer_360", "SELECT * FROM x_g360", "total_spend avg_txn_amount")
add("graph_context", """SELECT customer_id, total_orders, coalesce(total_spend, 0) AS total_spend, distinct_merchants, total_transactions,
 coalesce(avg_txn_amount, 0) AS avg_txn_amount, linked_profiles FROM x_g360""", "total_spend avg_txn_amount")
_VERTICES = {"customers": "x_emap", "orders": "x_so", "transactions": "x_st", "merchants": "x_merch", "products": "part"}
_EDGES = {"placed": "x_placed", "paid_via": "x_paid", "made": "x_made", "at": "x_at", "contains": "x_contains"}


def _counts(parts: dict[str, str], label: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS {label}, count(*) AS n FROM {t}" for n, t in parts.items())


add("graph_stats", _counts(_VERTICES, "label") + f""" UNION ALL SELECT 'relationships', CAST(sum(n) AS BIGINT) FROM ({_counts(_EDGES, 'label')})
UNION ALL SELECT 'same_as', count(*) FROM x_emap a JOIN x_emap b ON a.component = b.component AND a.customer_id < b.customer_id""")
_STAR = "(SELECT * FROM x_emap WHERE cluster_size > 1 AND customer_id <> component)"
add("graph_load_counts", _counts({**_VERTICES, **_EDGES, "same_as": _STAR}, "part"))
_KEYS = {"customers": "customer_id", "orders": "order_id", "transactions": "transaction_id", "merchants": "merchant_id", "products": "p_partkey"}


def _unique(table: str, source: str, column: str, shown: str | None = None) -> str:
    return (f"SELECT '{table}' AS \"table\", '{shown or column}' AS \"column\", 'unique' AS test, (SELECT count(*) FROM (SELECT {column} FROM {source} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)) AS failures")


def _failing(table: str, source: str, column: str, test: str, condition: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{test}' AS test, "
            f"(SELECT count(CASE WHEN {condition} THEN 1 END) FROM {source}) AS failures")


def _suite(parts: list[str]) -> str:
    return "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + " UNION ALL ".join(parts) + ")"


add("graph_constraints", _suite(
    [_unique(t, _VERTICES[t], k, "product_id" if t == "products" else None) for t, k in _KEYS.items()]
    + [_unique("locations", "(SELECT concat_ws('|', country, city_norm) AS location_key FROM x_sc WHERE country IS NOT NULL OR city_norm IS NOT NULL "
               "UNION SELECT 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier)", "location_key"),
       _failing("customers", "x_emap", "resolved_entity_id", "not_null", "resolved_entity_id IS NULL")]))
add("same_as_edges", f"SELECT component AS id_a, customer_id AS id_b, er_confidence AS confidence FROM {_STAR}", "confidence")
add("same_as_edges_cross_source", """WITH RECURSIVE links AS (
 SELECT a.customer_id AS x, b.customer_id AS y, a.resolved_entity_id AS e FROM x_emap a
 JOIN x_emap b ON a.resolved_entity_id = b.resolved_entity_id AND a.source_system <> b.source_system),
reach(id, other) AS (SELECT DISTINCT x, x FROM links UNION SELECT r.id, l.y FROM reach r JOIN links l ON l.x = r.other),
counted AS (SELECT e, count(*) // 2 AS pairs FROM links GROUP BY e)
SELECT id AS customer_id, min(other) AS component, any_value(pairs) AS pairs FROM reach
JOIN (SELECT DISTINCT x, e FROM links) ON x = id JOIN counted USING (e) GROUP BY id""")
add("fraud_rings", """
WITH t AS (SELECT event_id, user_id AS c, event_id % 50 AS m, CAST(ts AS DATE) AS d FROM events WHERE value * 20 > 2000),
n AS (SELECT m, c, count(*) AS n_all, count(CASE WHEN d >= DATE '2024-01-30' - INTERVAL 10 DAY THEN 1 END) AS n_recent FROM t GROUP BY ALL),
cat AS (SELECT event_id % 50 AS m, last(event_type ORDER BY ts, event_id) AS category FROM events GROUP BY 1)
SELECT a.c AS customer_1, b.c AS customer_2, a.m AS shared_merchant, category, a.n_recent * b.n_all AS shared_risk_events
FROM n a JOIN n b ON a.m = b.m AND a.c <> b.c JOIN cat ON cat.m = a.m WHERE a.n_recent * b.n_all >= 3
ORDER BY shared_risk_events DESC, customer_1, customer_2, shared_merchant LIMIT 50""")
add("product_affinity", """SELECT product_1, p1.p_name AS product_1_name, product_2, p2.p_name AS product_2_name, co_purchases FROM (
 SELECT a.product_id AS product_1, b.product_id AS product_2, count(*) AS co_purchases
 FROM x_contains a JOIN x_contains b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY 1, 2 HAVING count(*) >= 2
 ORDER BY 3 DESC, 1, 2 LIMIT 100) JOIN part p1 ON p1.p_partkey = product_1 JOIN part p2 ON p2.p_partkey = product_2""")
add("merchant_risk", """SELECT merchant_id, CAST(NULL AS VARCHAR) AS merchant_name, merchant_category AS category, risky_customers, avg_customer_risk FROM (
 SELECT merchant_id, count(DISTINCT customer_id) AS risky_customers, avg(total_risk_score) AS avg_customer_risk
 FROM x_placed JOIN x_paid USING (order_id) JOIN x_360 USING (customer_id) WHERE high_risk_txn_count > 0 GROUP BY merchant_id
 HAVING count(DISTINCT customer_id) >= 2 ORDER BY risky_customers DESC, merchant_id LIMIT 20) JOIN x_merch USING (merchant_id)""", "avg_customer_risk")
add("churn_contagion", """SELECT customer_id, ltv_tier, total_spend, churned_in_network FROM (
 SELECT a.customer_id, p.ltv_tier, p.total_spend, p.estimated_ltv, count(DISTINCT b.customer_id) AS churned_in_network
 FROM n_people p JOIN n_cm a ON a.customer_id = p.customer_id JOIN n_cm b ON b.merchant_id = a.merchant_id
 JOIN n_people q ON q.customer_id = b.customer_id AND q.churn_status = 'at_risk'
 WHERE p.churn_status = 'active' AND p.last_order_date >= DATE '2001-08-01' - INTERVAL 60 DAY GROUP BY ALL HAVING count(DISTINCT b.customer_id) >= 3)
ORDER BY estimated_ltv DESC, customer_id LIMIT 100""", "total_spend")
add("entity_profiles", """SELECT customer_id, resolved_entity_id, source_system, email_normalised AS email, er_confidence AS confidence,
 CASE WHEN cluster_size >= 3 THEN cluster_size ELSE cluster_size - 1 END AS linked_profiles FROM x_emap""", "confidence")
add("linked_profiles", """SELECT customer_id AS linked_customer_id FROM x_emap WHERE component = (SELECT component FROM x_emap WHERE customer_id = 'cust_25')
 AND cluster_size > 1 AND (customer_id <> 'cust_25' OR cluster_size >= 3)""")


def _pagerank(edges: str, rounds: int = 20, d: float = 0.85) -> str:
    parts = [f"pr_e AS MATERIALIZED ({edges})", "pr_b AS MATERIALIZED (SELECT src, dst FROM pr_e UNION SELECT dst, src FROM pr_e)",
             "pr_w AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS deg FROM pr_b)",
             f"pr_0 AS (SELECT DISTINCT src AS id, CAST({1 - d} AS DOUBLE) AS score FROM pr_b)"]
    for i in range(1, rounds + 1):
        parts.append(f"pr_{i} AS MATERIALIZED (SELECT dst AS id, {1 - d} + {d} * sum(score / deg) AS score FROM pr_w JOIN pr_{i - 1} ON id = src GROUP BY dst)")
    return "WITH " + ", ".join(parts) + f" SELECT id, score AS pagerank_score FROM pr_{rounds}"


add("customer_pagerank", _pagerank("SELECT DISTINCT 'c' || CAST(o_custkey AS VARCHAR) AS src, 'm' || CAST(l_suppkey AS VARCHAR) AS dst "
                                   "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"), "pagerank_score")
add("influential_customers", "SELECT customer_id, full_name AS name, ltv_tier, pagerank_score FROM (SELECT CAST(substr(id, 3) AS BIGINT) AS customer_id, "
    "pagerank_score FROM (" + _pagerank("SELECT 'c:' || CAST(customer_id AS VARCHAR) AS src, 'm:' || CAST(merchant_id AS VARCHAR) AS dst FROM n_cm")
    + ") WHERE starts_with(id, 'c:')) JOIN n_people USING (customer_id) ORDER BY pagerank_score DESC, customer_id LIMIT 50", "pagerank_score")
add("location_graph", """WITH p AS (SELECT customer_id, concat_ws('|', country, city_norm) AS k FROM x_sc WHERE country IS NOT NULL OR city_norm IS NOT NULL)
SELECT 'locations' AS part, (SELECT count(*) FROM (SELECT k FROM p UNION SELECT 'N' || CAST(s_nationkey AS VARCHAR) FROM supplier)) AS n
UNION ALL SELECT 'lives_in', count(*) FROM p UNION ALL SELECT 'located_in', count(*) FROM supplier""")
for _name in ("search_customers", "search_customers_indexed"):
    add(_name, """SELECT customer_id, full_name_norm AS full_name, email_normalised, hits FROM (
 SELECT *, len(list_intersect(regexp_split_to_array(lower(concat_ws(' ', full_name_norm, email_normalised)), '[^\\p{L}\\p{N}]+'), ['garcia', 'jose', 'org'])) AS hits
 FROM x_sc) WHERE hits > 0""")

# ---- star schema ----------------------------------------------------------------------------------

_FQ = "CASE WHEN month({d}) IN (4,5,6) THEN 1 WHEN month({d}) IN (7,8,9) THEN 2 WHEN month({d}) IN (10,11,12) THEN 3 ELSE 4 END"
_FY = "CASE WHEN month({d}) >= 4 THEN year({d}) ELSE year({d}) - 1 END"
add("order_calendar", f"""SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, d AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
 strftime(d, '%B') AS month_name, weekofyear(d) AS week_of_year, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name,
 dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday, {_FY.format(d='d')} AS fiscal_year, {_FQ.format(d='d')} AS fiscal_quarter,
 'Q' || CAST({_FQ.format(d='d')} AS VARCHAR) AS fiscal_label FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""", "", "full_date")
add("dim_customer", "SELECT * FROM d_cust", "", "registration_ts valid_from valid_to")
add("dim_merchant", "SELECT * FROM d_merch", "", "valid_from valid_to")
_PATHS = """l AS (SELECT * FROM (SELECT o_orderkey AS link, lag(o_custkey) OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey) AS src,
  o_custkey AS dst FROM orders WHERE o_orderpriority = '1-URGENT') WHERE src IS NOT NULL),
steps AS (SELECT src AS a, dst AS b, link FROM l UNION ALL SELECT dst, src, link FROM l WHERE src <> dst),
p(start, node, hops, used) AS (SELECT c_custkey, c_custkey, 0, CAST([] AS BIGINT[]) FROM customer
  UNION ALL SELECT start, b, hops + 1, list_append(used, link) FROM p JOIN steps ON a = node WHERE hops < 3 AND NOT list_contains(used, link))"""
add("customer_paths", f"WITH RECURSIVE {_PATHS} SELECT start, hops, count(*) AS n_paths, count(DISTINCT node) AS n_ends FROM p WHERE hops > 0 GROUP BY 1, 2")
add("customers_reached", f"""WITH RECURSIVE {_PATHS} SELECT start, hops, count(*) AS n_reached FROM (SELECT start, node, min(hops) AS hops FROM p WHERE node <> start GROUP BY 1, 2)
 GROUP BY 1, 2""")
add("orders_as_of", """WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS TIMESTAMP) AS placed_ts FROM orders),
v AS (SELECT c_custkey, CAST(DATE '1995-06-01' + CAST(c_custkey * 17 % 500 + i * 600 AS INT) AS TIMESTAMP) AS since, c_mktsegment || '-' || i AS segment
  FROM customer, (SELECT unnest([0, 1, 2]) AS i)),
w AS (SELECT o_orderpriority AS p, max(placed_ts) AS since, count(*) AS level FROM o GROUP BY o_orderpriority, date_trunc('month', placed_ts))
SELECT o.*, v.segment, w.level FROM o ASOF LEFT JOIN v ON o_custkey = c_custkey AND placed_ts >= v.since ASOF LEFT JOIN w ON o_orderpriority = p AND placed_ts >= w.since""", "", "placed_ts")
add("fact_orders", "SELECT * FROM f_orders", _MONEY_O, "order_ts loaded_at")
add("fact_transactions", "SELECT * FROM f_txns", "amount", "transaction_ts loaded_at")
add("orders_by_fiscal_quarter", f"""SELECT {_FY.format(d='order_date')} AS fiscal_year, {_FQ.format(d='order_date')} AS fiscal_quarter, count(*) AS orders,
 sum(net_amount) AS revenue FROM x_go GROUP BY 1, 2""", "revenue")
_CAT = " ".join(f"WHEN {sk} THEN '{cat}'" for sk, _, _, cat, _ in PAYMENT_ROWS)
_DIG = " ".join(f"WHEN {sk} THEN {str(dig).lower()}" for sk, _, _, _, dig in PAYMENT_ROWS)
add("payments_by_category", f"""SELECT CASE sk {_CAT} END AS payment_category, CASE sk {_DIG} END AS is_digital, count(*) AS n, sum(amount) AS amount
FROM (SELECT amount, {PAYMENT_SK} AS sk FROM x_gt) GROUP BY 1, 2""", "amount")

# ---- quality, publishing, serving -----------------------------------------------------------------

_SOURCES = {"orders": "x_so", "transactions": "x_st", "customers": "x_sc", "customer_360": "x_360", "daily_order_summary": "x_md",
            "fraud_summary": "x_mf", "customer_order_metrics": "x_mo", "customer_txn_metrics": "x_mt"}


def _tests(table: str, source: str, unique: str, required: str, ranges=(), values=()) -> list[str]:
    parts = [_unique(table, source, c) for c in unique.split()]
    parts += [_failing(table, source, c, "not_null", f"{c} IS NULL") for c in required.split()]
    parts += [_failing(table, source, c, "accepted_range", t) for c, t in ranges]
    return parts + [_failing(table, source, c, "accepted_values", f"{c} NOT IN {_in(v)}") for c, v in values]


add("dq_suite", _suite(
    _tests("orders", "x_so", "order_id", "order_id customer_id order_ts net_amount", (), [("order_status", S.ORDER_STATUSES)])
    + _tests("transactions", "x_st", "transaction_id", "transaction_id customer_id merchant_id amount", (), [("risk_tier", S.RISK_TIERS)])
    + _tests("customers", "x_sc", "customer_id", "customer_id")
    + _tests("customer_360", "x_360", "customer_id", "customer_id resolved_entity_id total_orders estimated_ltv",
             [("total_orders", "total_orders < 0"), ("estimated_ltv", "estimated_ltv < 0")],
             [("ltv_tier", S.LTV_TIERS), ("churn_status", S.CHURN_STATUSES)])
    + _tests("daily_order_summary", "x_md", "", "order_date order_count net_revenue",
             [("order_count", "order_count < 0"), ("net_revenue", "net_revenue < 0")])
    + _tests("fraud_summary", "x_mf", "", "txn_date", [(c, f"{c} < 0 OR {c} > 100") for c in ("flag_rate_pct", "high_risk_rate_pct")])
    + _tests("customer_order_metrics", "x_mo", "customer_id", "customer_id", [("total_orders", "total_orders < 1")])
    + _tests("customer_txn_metrics", "x_mt", "customer_id", "customer_id", [("estimated_ltv", "estimated_ltv < 0")])))
_RAW = ("(SELECT *, round(gross_amount - coalesce(discount_amount, 0.0), 2) AS net_amount, CASE WHEN gross_amount > 0 "
        "THEN round(discount_amount / gross_amount * 100, 2) ELSE 0.0 END AS discount_pct FROM x_to)")
add("dq_raw_orders", _suite(_tests("orders", _RAW, "order_id", "order_id customer_id order_ts net_amount",
                                   [("discount_pct", "discount_pct < 0 OR discount_pct > 25")], [("order_status", S.ORDER_STATUSES)])))
add("dq_freshness", """SELECT *, CASE WHEN age_hours > 48 THEN 'fail' WHEN age_hours > 25 THEN 'warn' ELSE 'pass' END AS status FROM (
 SELECT max(ts) AS newest, (epoch(TIMESTAMP '2024-02-01 06:00:00') - epoch(max(ts))) / 3600 AS age_hours FROM events)""", "age_hours", "newest")
_MARTS = {"customer_360": "x_360", "daily_order_summary": "x_md", "fraud_summary": "x_mf"}
add("table_counts", _counts(_MARTS, '"table"'))
add("sync_marts", f"SELECT \"table\", n AS rows_loaded, n AS rows_stored, '2001-07-20' AS execution_date FROM ({_counts(_MARTS, chr(34) + 'table' + chr(34))})")


def _gold(table: str, source: str) -> tuple[str, str, str]:
    cols = [part.strip().split(" ", 1) for part in re.split(r",\s*(?![^()]*\))", S.GOLD_DDL[table])]
    kinds = {"string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "date": "DATE"}
    # means are doubles here: the nudge makes an exact half round up, as it does for decimals
    shown = [(n, f"CAST({n} AS DOUBLE) + 1e-9" if t.startswith("decimal") else n, kinds.get(t, t)) for n, t in cols]
    body = "SELECT " + ", ".join(f"CAST({value} AS {kind}) AS {n}" for n, value, kind in shown) + f" FROM {source}"
    return body, " ".join(n for n, t in cols if t.startswith("decimal")), " ".join(n for n, t in cols if t in ("timestamp", "date"))


add("published_360", *_gold("customer_360", "x_360"))
_body, _nums, _text = _gold("daily_order_summary", "x_md")
add("autoload_daily", f"SELECT *, {OAS} AS _loaded_at FROM ({_body})", _nums, _text + " _loaded_at")
add("stored_upsert", f"""SELECT *, year(o_orderdate) AS yr, o_orderstatus AS st FROM (
 SELECT * REPLACE (CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders)""", "o_totalprice", "o_orderdate")
add("clustered_orders", "SELECT * FROM orders WHERE o_custkey < 100 AND o_orderdate >= TIMESTAMP '1996-01-01'", "o_totalprice", "o_orderdate")
_SERVE = ("customer_id, resolved_entity_id, customer_name, email, country, segment, loyalty_tier, ltv_tier, churn_status, total_orders, "
          "total_order_revenue, avg_order_value, revenue_last_30d, estimated_ltv, total_risk_score, high_risk_txn_count, ever_velocity_spike, "
          "ever_amount_anomaly")
_SERVE_NUM = "total_order_revenue avg_order_value revenue_last_30d estimated_ltv"
add("serve_customers", f"SELECT {_SERVE} FROM x_360 WHERE ltv_tier = 'platinum' ORDER BY estimated_ltv DESC, customer_id LIMIT 50 OFFSET 5", _SERVE_NUM)
add("serve_customer", f"SELECT {_SERVE} FROM x_360 WHERE customer_id = 'cust_7'", _SERVE_NUM)
add("serve_order_summary", f"""SELECT order_date, shipping_country, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, CAST(sum(order_count) AS INT) AS order_count,
 CAST(sum(unique_customers) AS INT) AS unique_customers, avg(avg_order_value) AS avg_order_value, CAST(sum(new_customers) AS INT) AS new_customers,
 CAST(sum(returning_customers) AS INT) AS returning_customers FROM x_md WHERE order_date >= {ODAY} - INTERVAL 60 DAY GROUP BY ALL
ORDER BY order_date DESC, shipping_country LIMIT 500""", "net_revenue avg_order_value", "order_date")
add("serve_fraud_summary", f"""SELECT txn_date, risk_tier, merchant_category, CAST(sum(txn_count) AS INT) AS txn_count,
 CAST(sum(flagged_txn_count) AS INT) AS flagged_txn_count, CAST(sum(high_risk_count) AS INT) AS high_risk_count, avg(flag_rate_pct) AS flag_rate_pct,
 CAST(sum(amount_at_risk) AS DOUBLE) AS amount_at_risk FROM x_mf WHERE txn_date >= {TDAY} - INTERVAL 20 DAY AND risk_tier = 'MEDIUM' GROUP BY ALL
ORDER BY txn_date DESC, high_risk_count DESC, risk_tier, merchant_category LIMIT 200""", "flag_rate_pct amount_at_risk", "txn_date")
add("serve_top_ltv", "SELECT customer_id, customer_name, country, estimated_ltv, ltv_tier FROM x_360 ORDER BY estimated_ltv DESC, customer_id LIMIT 10", "estimated_ltv")
add("serve_safe_sql", "SELECT ltv_tier, churn_status, strftime(max(last_order_ts), '%Y-%m-%dT%H:%M:%S') AS newest, count(*) AS n, sum(estimated_ltv) AS ltv FROM x_360 GROUP BY ALL", "ltv")
add("platform_metrics", f"""SELECT (SELECT count(*) FROM x_sc) AS total_customers, (SELECT count(*) FROM x_so) AS total_orders,
 (SELECT count(*) FROM x_st) AS total_transactions, (SELECT count(DISTINCT component) FROM x_emap) AS total_entity_clusters,
 CAST((SELECT sum(n) FROM ({_counts({k: v for k, v in _EDGES.items() if k != 'contains'}, 'label')})) AS BIGINT) AS graph_relationships, 12 AS sync_lag_minutes""")

# ---- streams and files ----------------------------------------------------------------------------

_CUT_SHORT = "coalesce(transaction_id LIKE '%77', false)"
add("stream_land", "SELECT " + ", ".join(S.TRANSACTION_FIELDS) + f""", 'transaction' AS event_type,
 '["' || currency || '","' || ip_country || '"]' AS tags, 'transactions' AS domain, customer_id AS _partition_key FROM x_bt WHERE NOT {_CUT_SHORT}""")
add("stream_bad_records", f"""SELECT substr('{{"transaction_id":"' || transaction_id || '",' || CASE WHEN order_id IS NULL THEN '' ELSE '"order_id":"' || order_id || '",' END
 || CASE WHEN customer_id IS NULL THEN '' ELSE '"customer_id":"' || customer_id || '",' END || '"merchant_id":"' || merchant_id || '",', 1, 40) AS text
FROM x_bt WHERE {_CUT_SHORT}""")
_STREAM = "(SELECT * FROM x_tt WHERE transaction_ts IS NOT NULL AND customer_id IS NOT NULL)"
add("stream_dedup", f"SELECT DISTINCT transaction_id, customer_id, transaction_ts FROM {_STREAM}", "", "transaction_ts")
add("stream_velocity_window", f"""SELECT customer_id, w AS window_start, w + INTERVAL 1 HOUR AS window_end, count(*) AS n FROM (
 SELECT customer_id, unnest([time_bucket(INTERVAL 30 MINUTE, transaction_ts), time_bucket(INTERVAL 30 MINUTE, transaction_ts) - INTERVAL 30 MINUTE]) AS w
 FROM {_STREAM}) WHERE w + INTERVAL 1 HOUR <= (SELECT max(transaction_ts) FROM {_STREAM}) GROUP BY 1, 2""", "", "window_start window_end")
add("stream_velocity", f"SELECT transaction_id, customer_id, transaction_ts, {_velocity(6 * 3600)} AS txn_velocity_1h FROM {_STREAM}", "", "transaction_ts")
add("stream_upsert", "SELECT order_id, order_status, updated_ts, order_year, net_amount FROM x_so", "net_amount", "updated_ts")
add("file_manifest", "SELECT path, execution_date, hour, domain, file_name, CASE WHEN reason IS NULL THEN 'ready' ELSE 'skipped' END AS status, reason FROM a_manifest")
add("new_work", """
WITH early AS (SELECT execution_date, domain FROM a_manifest WHERE reason IS NULL AND m < TIMESTAMP '2024-01-05' GROUP BY ALL),
r AS (SELECT a.*, e.domain IS NOT NULL AS done, row_number() OVER (PARTITION BY a.execution_date, a.domain, a.reason IS NULL ORDER BY m, path) AS rn
  FROM a_manifest a LEFT JOIN early e ON a.reason IS NULL AND e.execution_date = a.execution_date AND e.domain = a.domain)
SELECT path, execution_date, domain, CASE WHEN reason IS NULL AND NOT done AND rn = 1 THEN 'processed' ELSE 'skipped' END AS status,
 CASE WHEN reason IS NOT NULL THEN reason WHEN done OR rn > 1 THEN 'already_processed' END AS reason FROM r""")
add("work_summary", "SELECT count(CASE WHEN reason IS NULL THEN 1 END) AS processed, count(CASE WHEN reason IS NOT NULL THEN 1 END) AS skipped FROM a_manifest")


def _quarantined(domain: str, checked: str, cut: str) -> str:
    return (f"SELECT 'quarantine_{domain}', CASE WHEN ingest_ts < TIMESTAMP '{cut}' THEN '2001-07-18' ELSE '2001-07-19' END, CAST(count(*) AS VARCHAR) "
            f"FROM {checked} WHERE NOT ok GROUP BY 2")


add("daily_run", f"""SELECT 'order' AS part, order_id AS key, order_status AS value FROM x_so
UNION ALL SELECT 'customer', customer_id, resolved_entity_id FROM x_emap
UNION ALL SELECT 'entity', customer_id, CAST(cluster_size AS VARCHAR) FROM x_emap
UNION ALL SELECT 'metrics', customer_id, CAST(total_orders AS VARCHAR) FROM x_mo
UNION ALL SELECT 'transaction', customer_id, CAST(count(DISTINCT transaction_id) AS VARCHAR) FROM x_ht GROUP BY customer_id
UNION ALL {_quarantined("orders", "x_co", "1998-06-01")}
UNION ALL {_quarantined("transactions", "x_ct", "2024-01-15")}
UNION ALL {_quarantined("customers", "x_cc", "2001-07-01 12:00:00")}""")
