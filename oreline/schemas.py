"""Column contracts of the raw, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns in landing order; every one is text at rest.
ORDER_FIELDS = [
    "order_id", "customer_id", "merchant_id", "order_status", "order_ts", "updated_ts", "currency", "gross_amount",
    "discount_amount", "item_count", "payment_method", "shipping_country", "source_system", "ingest_ts",
]
TRANSACTION_FIELDS = [
    "transaction_id", "order_id", "customer_id", "merchant_id", "transaction_ts", "amount", "currency",
    "transaction_type", "payment_method", "status", "card_bin", "card_last4", "ip_country", "device_type",
    "merchant_category", "is_international", "source_system", "ingest_ts",
]
CUSTOMER_FIELDS = [
    "customer_id", "source_system", "first_name", "last_name", "email", "phone", "date_of_birth", "gender",
    "address_line1", "address_line2", "city", "state_province", "postal_code", "country", "registration_ts",
    "is_active", "segment", "loyalty_tier", "ingest_ts",
]
CLICK_FIELDS = [
    "event_type", "session_id", "customer_id", "page", "product_id", "device_type", "country", "event_ts",
    "source_system",
]

RAW_FIELDS = {
    "orders": ORDER_FIELDS,
    "transactions": TRANSACTION_FIELDS,
    "customers": CUSTOMER_FIELDS,
    "clickstream": CLICK_FIELDS,
}

# Accepted domains.
ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled", "refunded"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY", "NGN", "GHS"]
PAYMENT_METHODS = [
    "credit_card", "debit_card", "paypal", "bank_transfer",
    "crypto", "buy_now_pay_later", "apple_pay", "google_pay",
]
TRANSACTION_TYPES = ["purchase", "refund", "chargeback", "adjustment", "fee", "transfer"]
TRANSACTION_STATUSES = ["pending", "completed", "failed", "reversed", "disputed"]
SEGMENTS = ["new", "returning", "vip", "at_risk", "churned", "prospect"]
LOYALTY_TIERS = ["bronze", "silver", "gold", "platinum", "none"]
RISK_TIERS = ["LOW", "MEDIUM", "HIGH"]
LTV_TIERS = ["platinum", "gold", "silver", "bronze", "new"]
CHURN_STATUSES = ["loyal", "active", "at_risk", "churned"]

# Silver column order.
SILVER_ORDERS = [
    "order_id", "customer_id", "merchant_id", "order_status", "order_ts", "updated_ts", "order_date", "order_year",
    "order_month", "order_dow", "is_weekend", "currency", "gross_amount", "discount_amount", "discount_pct",
    "net_amount", "item_count", "payment_method", "shipping_country", "source_system", "ingest_ts",
    "pipeline_version", "silver_ts",
]
SILVER_TRANSACTIONS = [
    "transaction_id", "order_id", "customer_id", "merchant_id", "transaction_ts", "transaction_type", "status",
    "amount", "currency", "payment_method", "card_bin", "card_last4", "is_international", "ip_country", "device_type",
    "merchant_category", "txn_velocity_1h", "avg_amount_30d", "stddev_amount_30d", "txn_count_30d", "flag_high_value",
    "flag_velocity_spike", "flag_amount_anomaly", "flag_intl_high_value", "flag_new_customer_high_value",
    "risk_score", "risk_tier", "source_system", "ingest_ts", "txn_date", "txn_year", "txn_month", "pipeline_version",
    "silver_ts",
]
SILVER_CUSTOMERS = [
    "customer_id", "source_system", "first_name", "last_name", "email", "phone", "date_of_birth", "gender",
    "first_name_norm", "last_name_norm", "full_name_norm", "email_normalised", "phone_normalised",
    "last_name_soundex", "address_line1", "address_line2", "city", "city_norm", "state_province", "postal_code",
    "postal_code_norm", "country", "block_key_1", "block_key_2", "block_key_3", "email_domain", "age", "age_band",
    "days_since_registration", "customer_tenure_band", "segment", "loyalty_tier", "is_active", "registration_ts",
    "ingest_ts", "pipeline_version", "silver_ts", "resolved_entity_id", "er_confidence",
]

MONEY = T.DecimalType(18, 2)


def text_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


def raw_schema(domain: str) -> T.StructType:
    return text_schema(RAW_FIELDS[domain])


# Column types of the published gold tables.
GOLD_DDL = {
    "customer_360": (
        "customer_id string, resolved_entity_id string, customer_name string, email string, "
        "country string, city string, age_band string, segment string, loyalty_tier string, "
        "is_active boolean, registration_ts timestamp, customer_tenure_band string, "
        "total_orders decimal(10,0), delivered_orders decimal(10,0), "
        "total_order_revenue decimal(18,2), avg_order_value decimal(18,2), "
        "orders_per_month decimal(8,2), revenue_last_30d decimal(18,2), "
        "revenue_last_90d decimal(18,2), total_txn_count decimal(10,0), "
        "net_txn_revenue decimal(18,2), avg_txn_amount decimal(18,2), "
        "estimated_ltv decimal(18,2), ltv_tier string, churn_status string, "
        "total_risk_score decimal(8,0), high_risk_txn_count decimal(8,0), "
        "ever_velocity_spike boolean, ever_amount_anomaly boolean, mart_updated_at timestamp"
    ),
    "daily_order_summary": (
        "order_date date, order_year decimal(4,0), order_month decimal(2,0), is_weekend boolean, "
        "shipping_country string, currency string, order_status string, "
        "order_count decimal(10,0), unique_customers decimal(10,0), "
        "gross_revenue decimal(18,2), total_discounts decimal(18,2), net_revenue decimal(18,2), "
        "avg_order_value decimal(18,2), new_customers decimal(10,0), "
        "returning_customers decimal(10,0), mart_updated_at timestamp"
    ),
    "fraud_summary": (
        "txn_date date, txn_year decimal(4,0), txn_month decimal(2,0), risk_tier string, "
        "merchant_category string, is_international boolean, device_type string, "
        "txn_count decimal(10,0), unique_customers decimal(10,0), total_amount decimal(18,2), "
        "flagged_txn_count decimal(10,0), high_risk_count decimal(10,0), "
        "flag_rate_pct decimal(8,2), high_risk_rate_pct decimal(8,2), "
        "amount_at_risk decimal(18,2), avg_velocity_1h decimal(8,2), mart_updated_at timestamp"
    ),
}


def gold_schema(table: str) -> T.StructType:
    """Needs a running session, which parses the type text."""
    return T.StructType.fromDDL(GOLD_DDL[table])
