"""Star schema: date, payment, customer and merchant dimensions; order and transaction facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.calendar import AsOf, fiscal_quarter, fiscal_year
from ..operators.asof import asof_join
from ..operators.merge import scd2_apply, surrogate_key
from ..schemas import MONEY

UNKNOWN_SK = "-1"
UNKNOWN_CODE = -1

# The payment methods.
PAYMENT_ROWS = [
    (1, "credit_card", "Credit Card", "card", True),
    (2, "debit_card", "Debit Card", "card", True),
    (3, "paypal", "PayPal", "wallet", True),
    (4, "bank_transfer", "Bank Transfer", "bank", True),
    (5, "crypto", "Cryptocurrency", "crypto", True),
    (6, "buy_now_pay_later", "Buy Now Pay Later", "bnpl", True),
    (7, "apple_pay", "Apple Pay", "wallet", True),
    (8, "google_pay", "Google Pay", "wallet", True),
    (9, "cash_on_delivery", "Cash on Delivery", "cash", False),
    (99, "other", "Other / Unknown", "other", False),
]

CUSTOMER_TRACKED = [
    "resolved_entity_id", "full_name", "email_normalised", "phone_normalised", "country", "city", "state_province",
    "postal_code", "age_band", "customer_tenure_band", "segment", "loyalty_tier", "is_active", "registration_ts",
]
MERCHANT_TRACKED = ["merchant_name", "merchant_category", "country", "city", "is_active", "risk_tier"]


def date_sk(day: Column | str) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2029-12-31") -> DataFrame:
    """One row per day. Weekday 1 is Sunday; weeks are ISO weeks; names are not padded."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """Calendar columns for a table of ``full_date``."""
    d = F.col("full_date")
    return days.select(
        date_sk(d).alias("date_sk"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), F.lit(False).alias("is_holiday"),
        fiscal_year(d).alias("fiscal_year"), fiscal_quarter(d).alias("fiscal_quarter"))


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_ROWS,
        "payment_method_sk int, payment_method_code string, payment_method_name string, payment_category string, "
        "is_digital boolean")


def dim_customer(silver: DataFrame, prev: DataFrame | None, as_of: AsOf) -> DataFrame:
    """Customer history: a new row whenever a tracked field changes."""
    updates = silver.withColumn("full_name", F.col("full_name_norm"))
    previous = None if prev is None else prev.drop("customer_sk")
    return scd2_apply(previous, updates, "customer_id", CUSTOMER_TRACKED, as_of) \
        .withColumn("customer_sk", surrogate_key("customer_id", "valid_from"))


def merchant_updates(txns: DataFrame) -> DataFrame:
    """Merchants as their transactions describe them: latest category, highest risk tier seen."""
    rank = F.when(F.col("risk_tier") == "HIGH", 3).when(F.col("risk_tier") == "MEDIUM", 2).otherwise(1)
    newest = F.struct("transaction_ts", "transaction_id")
    void = F.lit(None).cast("string")
    return txns.where("merchant_id is not null").groupBy("merchant_id").agg(
        F.max_by("merchant_category", newest).alias("merchant_category"),
        F.max_by("risk_tier", rank).alias("risk_tier"),
    ).withColumns({"merchant_name": void, "country": void, "city": void, "is_active": F.lit(True)})


def dim_merchant(txns: DataFrame, prev: DataFrame | None, as_of: AsOf) -> DataFrame:
    previous = None if prev is None else prev.drop("merchant_sk")
    return scd2_apply(previous, merchant_updates(txns), "merchant_id", MERCHANT_TRACKED, as_of) \
        .withColumn("merchant_sk", surrogate_key("merchant_id", "valid_from"))


def lookup_sk(fact: DataFrame, dim: DataFrame, key: str, ts: str, sk: str, first_version: bool = False,
              times: DataFrame | None = None) -> DataFrame:
    """Key of the dimension row valid at the fact's time, or the unknown member.

    ``first_version`` lets a fact older than the first row of its key use that row. ``times`` is that of ``asof_join``.
    """
    since = F.col("valid_from")
    if first_version:
        oldest = dim.groupBy(key).agg(F.min("valid_from").alias("_first"))
        versions = dim.select(key, "valid_from", "valid_to", sk).join(oldest, key)
        since = F.when(F.col("valid_from") == F.col("_first"), F.lit("0001-01-01").cast("timestamp")).otherwise(since)
    else:
        versions = dim.select(key, "valid_from", "valid_to", sk)
    spans = versions.select(key, since.alias("_since"), F.col("valid_to").alias("_until"), sk)
    return asof_join(fact, spans, key, ts, "_since", [sk], "_until", times=times).withColumn(sk, F.coalesce(sk, F.lit(UNKNOWN_SK)))


def payment_sk(code: str) -> Column:
    """Ten fixed codes need no join; unlisted methods are ``other``, a missing one is unknown."""
    known = F.create_map(*[F.lit(v) for sk, name, *_ in PAYMENT_ROWS for v in (name, sk)])
    return F.when(F.col(code).isNull(), F.lit(UNKNOWN_CODE)).otherwise(F.coalesce(known[F.col(code)], F.lit(99)))


def fact_orders(stg: DataFrame, customers: DataFrame, merchants: DataFrame, as_of: AsOf,
                first_version: bool = False) -> DataFrame:
    keyed = lookup_sk(stg, customers, "customer_id", "order_ts", "customer_sk", first_version)
    keyed = lookup_sk(keyed, merchants, "merchant_id", "order_ts", "merchant_sk", first_version, stg)
    return keyed.select(
        F.md5("order_id").alias("order_sk"), "order_id", "customer_sk", "merchant_sk",
        date_sk("order_date").alias("order_date_sk"), payment_sk("payment_method").alias("payment_method_sk"),
        "order_status", F.col("gross_amount").cast(MONEY).alias("gross_amount"),
        F.col("discount_amount").cast(MONEY).alias("discount_amount"),
        F.col("discount_pct").cast("decimal(8,4)").alias("discount_pct"),
        F.col("net_amount").cast(MONEY).alias("net_amount"), F.col("item_count").cast("int").alias("item_count"),
        "currency", "shipping_country", "order_ts", "pipeline_version", F.lit(str(as_of)).cast("timestamp").alias("loaded_at"))


def fact_transactions(stg: DataFrame, customers: DataFrame, merchants: DataFrame, as_of: AsOf,
                      first_version: bool = False) -> DataFrame:
    keyed = lookup_sk(stg, customers, "customer_id", "transaction_ts", "customer_sk", first_version)
    keyed = lookup_sk(keyed, merchants, "merchant_id", "transaction_ts", "merchant_sk", first_version, stg)
    return keyed.select(
        F.md5("transaction_id").alias("transaction_sk"), "transaction_id", "order_id", "customer_sk", "merchant_sk",
        date_sk("txn_date").alias("txn_date_sk"), payment_sk("payment_method").alias("payment_method_sk"),
        "transaction_type", "status", F.col("amount").cast(MONEY).alias("amount"), "currency", "is_international",
        "ip_country", "device_type", F.col("txn_velocity_1h").cast("int").alias("txn_velocity_1h"), "risk_score",
        "risk_tier", "flag_high_value", "flag_velocity_spike", "flag_amount_anomaly", "transaction_ts",
        "pipeline_version", F.lit(str(as_of)).cast("timestamp").alias("loaded_at"))


def orders_by_fiscal_quarter(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders and revenue per fiscal quarter; the fact is summed per day before it meets the calendar."""
    daily = fact.groupBy("order_date_sk").agg(F.count("*").alias("n"), F.sum("net_amount").alias("revenue"))
    return daily.join(dates, F.col("order_date_sk") == F.col("date_sk")).groupBy("fiscal_year", "fiscal_quarter").agg(
        F.sum("n").alias("orders"), F.sum("revenue").alias("revenue"))
