"""Staging projections, customer metrics and the gold marts.

Order and transaction ids are unique in silver (they are its upsert keys and the quality suite tests
it), so counting ids is counting rows and needs no distinct. Pass ``unique_ids=False`` for input
without that guarantee. Distinct customers come from a first aggregation that has the customer among
its keys: it also spreads large groups over many tasks before the second, small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from ..functions.calendar import AsOf, at_ts, stepped
from ..operators.filters import within_days
from ..operators.merge import incremental_replace
from ..schemas import MONEY


def _zero(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def _money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def _pct(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 2)


def with_run_audit(df: DataFrame, run_ts: AsOf, run_id: str) -> DataFrame:
    return df.withColumns({"mart_created_at": at_ts(run_ts), "run_started_at": at_ts(run_ts), "run_id": F.lit(run_id)})


# ---- staging --------------------------------------------------------------------------------------

def stg_orders(silver: DataFrame) -> DataFrame:
    kept = silver.where(
        F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
        & F.col("order_ts").isNotNull() & (F.col("net_amount") >= 0))
    return kept.withColumns({
        "is_completed": F.coalesce(F.col("order_status").isin("delivered", "shipped"), F.lit(False)),
        "gross_amount": _money("gross_amount"),
        "discount_amount": _zero(_money("discount_amount")).cast(MONEY),
        "discount_pct": _zero(F.col("discount_pct").cast("decimal(8,4)")).cast("decimal(8,4)"),
        "net_amount": _money("net_amount"),
        "item_count": F.coalesce("item_count", F.lit(1)),
    })


def stg_transactions(silver: DataFrame) -> DataFrame:
    required = ("transaction_id", "customer_id", "merchant_id", "transaction_ts", "amount")
    kept = silver
    for name in required:
        kept = kept.where(F.col(name).isNotNull())
    return kept.withColumns({
        "amount": _money("amount"),
        "avg_amount_30d": _zero(_money("avg_amount_30d")).cast(MONEY),
        "stddev_amount_30d": _zero(_money("stddev_amount_30d")).cast(MONEY),
        "txn_count_30d": _zero("txn_count_30d").cast("long"),
    })


def stg_customers(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "source_system",
        F.col("full_name_norm").alias("customer_name"),
        F.col("email_normalised").alias("email"),
        F.col("phone_normalised").alias("phone"),
        "last_name_soundex", "city", "state_province", "postal_code", "country", "age", "age_band",
        "segment", "loyalty_tier", "is_active", "registration_ts", "days_since_registration",
        "customer_tenure_band",
        F.coalesce("resolved_entity_id", "customer_id").alias("resolved_entity_id"),
        F.col("er_confidence").cast("decimal(6,4)").alias("er_confidence"),
        "silver_ts", "pipeline_version",
    )


# ---- customer metrics -----------------------------------------------------------------------------

def _status_count(status: str) -> Column:
    return F.count_if(F.col("order_status") == status)


MOST_RECENT = ("max", "latest", "mode")


def _representative(col: str, ts: str, method: str) -> Column:
    if method not in MOST_RECENT:
        raise ValueError(f"method must be one of {MOST_RECENT}")
    if method == "latest":
        return F.max_by(col, ts)
    return F.mode(col, deterministic=True) if method == "mode" else F.max(col)


def customer_order_metrics(stg: DataFrame, as_of: AsOf, method: str = "max", unique_ids: bool = True) -> DataFrame:
    """One row per customer: volume, revenue, behaviour, rates, trailing sums."""
    if not unique_ids:
        return _customer_order_metrics_distinct(stg, as_of, method)
    recent_30, recent_90 = within_days(F.col("order_ts"), 30, as_of), within_days(F.col("order_ts"), 90, as_of)
    # the few payment methods of a customer are grouped first, which shrinks what is shuffled and makes their distinct count a count
    parts = stg.groupBy("customer_id", "payment_method").agg(
        F.count("order_id").alias("total_orders"),
        *[_status_count(s).alias(f"{s}_orders") for s in ("delivered", "cancelled", "refunded")],
        F.sum("net_amount").alias("total_revenue"),
        F.max("net_amount").alias("max_order_value"), F.min("net_amount").alias("min_order_value"),
        F.count("net_amount").alias("_n_value"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("discount_pct").alias("_sum_pct"), F.count("discount_pct").alias("_n_pct"),
        F.sum("item_count").alias("total_items"), F.count("item_count").alias("_n_items"),
        F.count_if("is_weekend").alias("weekend_orders"),
        F.min("order_ts").alias("first_order_ts"), F.max("order_ts").alias("last_order_ts"),
        F.sum(F.when(recent_30, F.col("net_amount"))).alias("revenue_last_30d"),
        F.sum(F.when(recent_90, F.col("net_amount"))).alias("revenue_last_90d"),
        F.count_if(recent_30).alias("orders_last_30d"),
    )
    total = lambda c: F.sum(c).alias(c)
    if method == "mode":
        # most orders wins; the larger text decides a tie
        chosen = parts.where(F.col("payment_method").isNotNull()).groupBy("customer_id").agg(
            F.max(F.struct("total_orders", "payment_method"))["payment_method"].alias("most_recent_payment_method"))
        representative = None
    else:
        representative = F.max("payment_method") if method == "max" else F.max_by("payment_method", "last_order_ts")
    merged = _per_customer(parts, stg.select("customer_id", "shipping_country").distinct()).agg(
        *[total(c) for c in ("total_orders", "delivered_orders", "cancelled_orders", "refunded_orders",
                             "total_revenue")],
        F.max("max_order_value").alias("max_order_value"), F.min("min_order_value").alias("min_order_value"),
        *[total(c) for c in ("total_discounts", "total_items", "weekend_orders", "revenue_last_30d",
                             "revenue_last_90d", "orders_last_30d", "_n_value", "_sum_pct", "_n_pct", "_n_items")],
        F.count("payment_method").alias("distinct_payment_methods"),
        F.count("shipping_country").alias("distinct_shipping_countries"),
        *([representative.alias("most_recent_payment_method")] if representative is not None else []),
        F.min("first_order_ts").alias("first_order_ts"), F.max("last_order_ts").alias("last_order_ts"),
    )
    if method == "mode":
        merged = merged.join(chosen, "customer_id", "left")
    averaged = merged.withColumns({
        "avg_order_value": _mean("total_revenue", "_n_value"),
        "avg_discount_pct": _mean("_sum_pct", "_n_pct"),
        "avg_items_per_order": _mean("total_items", "_n_items"),
    })
    return _order_rates(averaged, as_of)


def _per_customer(parts: DataFrame, kinds: DataFrame) -> GroupedData:
    """Partial rows of each customer and, in the same groups, one row per value of another column.

    Counting the latter counts distinct values; two distinct counts in one aggregation would shuffle every partial row three times.
    Text in a result makes it a sorted aggregation, so a hash of the customer is sorted first: ids begin alike.
    """
    return parts.unionByName(kinds, allowMissingColumns=True).groupBy(F.xxhash64("customer_id").alias("_hash"), "customer_id")


def _mean(total: str | Column, n: str | Column) -> Column:
    """Decimal totals are divided as decimals, so the mean is the nearest double to the true one."""
    return F.try_divide(total, n).cast("double")


def _customer_order_metrics_distinct(stg: DataFrame, as_of: AsOf, method: str) -> DataFrame:
    recent_30, recent_90 = within_days(F.col("order_ts"), 30, as_of), within_days(F.col("order_ts"), 90, as_of)
    order_if = lambda test: F.count_distinct(F.when(test, F.col("order_id")))
    return _order_rates(stg.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        *[order_if(F.col("order_status") == s).alias(f"{s}_orders") for s in ("delivered", "cancelled", "refunded")],
        F.sum("net_amount").alias("total_revenue"),
        F.max("net_amount").alias("max_order_value"), F.min("net_amount").alias("min_order_value"),
        F.sum("discount_amount").alias("total_discounts"), F.sum("item_count").alias("total_items"),
        order_if(F.col("is_weekend")).alias("weekend_orders"),
        F.sum(F.when(recent_30, F.col("net_amount"))).alias("revenue_last_30d"),
        F.sum(F.when(recent_90, F.col("net_amount"))).alias("revenue_last_90d"),
        F.count_if(recent_30).alias("orders_last_30d"),
        F.count_distinct("payment_method").alias("distinct_payment_methods"),
        F.count_distinct("shipping_country").alias("distinct_shipping_countries"),
        _representative("payment_method", "order_ts", method).alias("most_recent_payment_method"),
        F.min("order_ts").alias("first_order_ts"), F.max("order_ts").alias("last_order_ts"),
        _mean(F.sum("net_amount"), F.count("net_amount")).alias("avg_order_value"),
        _mean(F.sum("discount_pct"), F.count("discount_pct")).alias("avg_discount_pct"),
        F.avg("item_count").alias("avg_items_per_order"),
    ), as_of)


def _order_rates(df: DataFrame, as_of: AsOf) -> DataFrame:
    days = F.datediff("last_order_ts", "first_order_ts")
    per_month = F.round(F.col("total_orders") / (days / F.lit(30.0)), 2)
    return df.withColumns({
        "customer_lifespan_days": days,
        "orders_per_month": F.when(days > 30, per_month).otherwise(F.col("total_orders").cast("double")),
        "cancellation_rate_pct": _pct(F.col("cancelled_orders"), F.col("total_orders")),
        "refund_rate_pct": _pct(F.col("refunded_orders"), F.col("total_orders")),
        "updated_at": at_ts(as_of),
    }).select(
        "customer_id", "total_orders", "delivered_orders", "cancelled_orders", "refunded_orders", "total_revenue",
        "avg_order_value", "max_order_value", "min_order_value", "total_discounts", "avg_discount_pct",
        "total_items", "avg_items_per_order", "weekend_orders", "distinct_payment_methods",
        "distinct_shipping_countries", "most_recent_payment_method", "first_order_ts", "last_order_ts",
        "customer_lifespan_days", "orders_per_month", "cancellation_rate_pct", "refund_rate_pct",
        "revenue_last_30d", "revenue_last_90d", "orders_last_30d", "updated_at")


# Retention factor by number of active days.
RETENTION = [(180, 2.5), (90, 1.8), (30, 1.3)]


def _retention(days: Column) -> Column:
    factor = None
    for bound, value in RETENTION:
        factor = F.when(days > bound, value) if factor is None else factor.when(days > bound, value)
    return factor.otherwise(1.0)


def customer_txn_metrics(stg: DataFrame, as_of: AsOf, method: str = "max") -> DataFrame:
    """One row per customer with at least one completed purchase.

    Purchases, refunds and risk are conditional parts of one aggregation, first by customer and device, then by customer;
    the days of purchases are counted beside it, in the same groups. There are no joins.
    """
    if method not in ("max", "latest"):
        raise ValueError("method must be 'max' or 'latest'")
    settled = F.col("status") == "completed"
    bought = F.coalesce(settled & (F.col("transaction_type") == "purchase"), F.lit(False))
    returned = F.coalesce(settled & (F.col("transaction_type") == "refund"), F.lit(False))
    abroad = F.coalesce(F.col("is_international"), F.lit(False))
    on = lambda test, c: F.when(test, F.col(c))
    parts = stg.groupBy("customer_id", "device_type").agg(
        F.count_if(bought).alias("n"), F.sum(on(bought, "amount")).alias("gross"),
        F.max(on(bought, "amount")).alias("largest"), F.count_if(bought & abroad).alias("intl"),
        F.min(on(bought, "transaction_ts")).alias("first_ts"), F.max(on(bought, "transaction_ts")).alias("last_ts"),
        F.sum(on(returned, "amount")).alias("refunded"), F.count_if(returned).alias("refunds"),
        F.sum("risk_score").alias("risk"), F.count_if(F.col("risk_tier") == "HIGH").alias("high"),
        F.max("risk_score").alias("max_risk"),
        F.bool_or("flag_velocity_spike").alias("spike"), F.bool_or("flag_amount_anomaly").alias("odd"),
    )
    active = F.col("n") > 0
    device = F.when(active, F.col("device_type"))
    totals = _per_customer(parts, stg.where(bought).select("customer_id", "txn_date").distinct()).agg(
        F.sum("n").alias("total_txn_count"), F.count("txn_date").alias("active_days"),
        F.sum("gross").alias("gross_txn_revenue"), F.max("largest").alias("max_txn_amount"),
        F.sum("intl").alias("intl_txn_count"),
        F.count(device).alias("distinct_devices"),
        (F.max(device) if method == "max" else F.max_by(device, F.col("last_ts"))).alias("most_recent_device"),
        F.min("first_ts").alias("first_txn_ts"), F.max("last_ts").alias("last_txn_ts"),
        F.sum("refunded").alias("total_refunded"), F.sum("refunds").alias("refund_count"),
        F.sum("risk").alias("total_risk_score"), F.sum("high").alias("high_risk_txn_count"),
        F.max("max_risk").alias("max_risk_score"),
        F.bool_or("spike").alias("ever_velocity_spike"), F.bool_or("odd").alias("ever_amount_anomaly"),
    ).where(F.col("total_txn_count") > 0)
    net = F.col("gross_txn_revenue") - _zero("total_refunded")
    return totals.select(
        "customer_id", "total_txn_count", "active_days", "gross_txn_revenue",
        _mean("gross_txn_revenue", "total_txn_count").alias("avg_txn_amount"), "max_txn_amount", "intl_txn_count",
        _pct(F.col("intl_txn_count"), F.col("total_txn_count")).alias("intl_txn_rate_pct"),
        "distinct_devices", "most_recent_device", "first_txn_ts", "last_txn_ts",
        _zero("total_refunded").alias("total_refunded"), "refund_count", net.alias("net_txn_revenue"),
        _zero("total_risk_score").alias("total_risk_score"), "high_risk_txn_count",
        _zero("max_risk_score").alias("max_risk_score"),
        F.coalesce("ever_velocity_spike", F.lit(False)).alias("ever_velocity_spike"),
        F.coalesce("ever_amount_anomaly", F.lit(False)).alias("ever_amount_anomaly"),
        F.round(net * _retention(F.col("active_days")).cast("decimal(2,1)"), 2).alias("estimated_ltv"),
        at_ts(as_of).alias("updated_at"),
    )


def incremental_order_metrics(target: DataFrame, stg: DataFrame, delta: DataFrame, as_of: AsOf) -> DataFrame:
    return incremental_replace(target, stg, delta, "customer_id", lambda facts: customer_order_metrics(facts, as_of))


def incremental_txn_metrics(target: DataFrame, stg: DataFrame, delta: DataFrame, as_of: AsOf) -> DataFrame:
    return incremental_replace(target, stg, delta, "customer_id", lambda facts: customer_txn_metrics(facts, as_of))


# ---- marts ----------------------------------------------------------------------------------------

# Lower bounds of the value tiers.
LTV_BOUNDS = [(10000, "platinum"), (5000, "gold"), (1000, "silver"), (100, "bronze")]
NO_ORDER_TS = "2000-01-01"


def ltv_tier(value: Column) -> Column:
    return stepped(_zero(value), LTV_BOUNDS, "new", ">=")


def churn_status(as_of: AsOf) -> Column:
    """First rule that holds: lapsed regular, long silent, frequent, else active."""
    last = F.coalesce(F.col("last_order_ts"), F.lit(NO_ORDER_TS).cast("timestamp"))
    return F.when((_zero("orders_last_30d") == 0) & (_zero("total_orders") > 3), "at_risk") \
        .when(~within_days(last, 90, as_of), "churned") \
        .when(_zero("orders_per_month") >= 2, "loyal") \
        .otherwise("active")


def customer_360(customers: DataFrame, orders_m: DataFrame, txns_m: DataFrame, as_of: AsOf) -> DataFrame:
    """Profile, order and transaction metrics of every customer, zero where there are none."""
    o = orders_m.drop("updated_at", "total_discounts")
    t = txns_m.drop("updated_at")
    joined = customers.join(o, "customer_id", "left").join(t, "customer_id", "left")
    zero = lambda c, name=None: _zero(c).alias(name or c)
    no = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return joined.select(
        "customer_id", "resolved_entity_id", "customer_name", "email", "phone",
        "country", "city", "age_band", "segment", "loyalty_tier", "is_active", "registration_ts",
        "customer_tenure_band", "days_since_registration",
        zero("total_orders"), zero("delivered_orders"), zero("cancelled_orders"), zero("refunded_orders"),
        zero("total_revenue", "total_order_revenue"), zero("avg_order_value"),
        zero("total_items", "total_items_ordered"), zero("cancellation_rate_pct"), zero("refund_rate_pct"),
        zero("orders_per_month"), zero("revenue_last_30d"), zero("revenue_last_90d"), zero("orders_last_30d"),
        "first_order_ts", "last_order_ts", "customer_lifespan_days", "most_recent_payment_method",
        zero("total_txn_count"), zero("gross_txn_revenue"), zero("net_txn_revenue"), zero("avg_txn_amount"),
        zero("refund_count", "txn_refund_count"), zero("total_refunded"), zero("intl_txn_rate_pct"),
        "most_recent_device", "first_txn_ts", "last_txn_ts",
        zero("estimated_ltv"), zero("total_risk_score"), zero("high_risk_txn_count"),
        no("ever_velocity_spike"), no("ever_amount_anomaly"),
        ltv_tier(F.col("estimated_ltv")).alias("ltv_tier"), churn_status(as_of).alias("churn_status"),
        "source_system", "er_confidence", at_ts(as_of).alias("mart_updated_at"),
    )


DAILY_KEYS = ["order_date", "order_year", "order_month", "is_weekend", "shipping_country", "currency", "order_status"]


def daily_order_summary(stg: DataFrame, as_of: AsOf) -> DataFrame:
    """Order figures per day, country, currency and status, with new and returning customers."""
    per_customer = stg.groupBy(*DAILY_KEYS, "customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("gross_amount").alias("gross_revenue"), F.sum("discount_amount").alias("total_discounts"),
        F.sum("net_amount").alias("net_revenue"), F.count("net_amount").alias("_n_value"),
        F.max("net_amount").alias("max_order_value"),
        F.sum("item_count").alias("total_items"), F.count("item_count").alias("_n_items"),
        F.sum("discount_pct").alias("_sum_pct"), F.count("discount_pct").alias("_n_pct"),
        F.count_if(F.col("discount_amount") > 0).alias("discounted_orders"),
    )
    first_seen = stg.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    dated = per_customer.join(first_seen, "customer_id", "left")
    total = lambda c: F.sum(c).alias(c)
    # within one day a customer is either new or returning, so rows count customers
    return dated.groupBy(*DAILY_KEYS).agg(
        total("order_count"), F.count("customer_id").alias("unique_customers"),
        total("gross_revenue"), total("total_discounts"), total("net_revenue"),
        _mean(F.sum("net_revenue"), F.sum("_n_value")).alias("avg_order_value"),
        F.max("max_order_value").alias("max_order_value"),
        total("total_items"), _mean(F.sum("total_items"), F.sum("_n_items")).alias("avg_items_per_order"),
        _mean(F.sum("_sum_pct"), F.sum("_n_pct")).alias("avg_discount_pct"),
        total("discounted_orders"),
        F.count_if(F.col("order_date") == F.col("first_order_date")).alias("new_customers"),
        F.count_if(F.col("order_date") > F.col("first_order_date")).alias("returning_customers"),
    ).withColumn("mart_updated_at", at_ts(as_of))


FRAUD_KEYS = ["txn_date", "txn_year", "txn_month", "risk_tier", "merchant_category", "is_international", "device_type"]
FLAG_COUNTS = {
    "high_value_count": "flag_high_value",
    "velocity_spike_count": "flag_velocity_spike",
    "amount_anomaly_count": "flag_amount_anomaly",
    "intl_high_value_count": "flag_intl_high_value",
    "new_cust_high_value_count": "flag_new_customer_high_value",
}


def fraud_summary(stg: DataFrame, as_of: AsOf) -> DataFrame:
    """Fraud figures per day, tier, category, reach and device.

    The two distinct counts share one aggregation: Spark pairs each group with the customer or the
    merchant before the shuffle, so even a group holding a third of the rows is spread.
    """
    scored = F.col("risk_score") > 0
    return stg.groupBy(*FRAUD_KEYS).agg(
        F.count("transaction_id").alias("txn_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.sum("amount").alias("total_amount"),
        *[F.count_if(flag).alias(name) for name, flag in FLAG_COUNTS.items()],
        F.count_if(scored).alias("flagged_txn_count"),
        F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_count"),
        F.sum(F.when(scored, F.col("amount")).otherwise(F.lit(0).cast(MONEY))).alias("amount_at_risk"),
        F.avg("txn_velocity_1h").alias("avg_velocity_1h"),
        F.max("txn_velocity_1h").alias("max_velocity_1h"),
    ).withColumns({
        "avg_amount": _mean("total_amount", "txn_count"),
        "flag_rate_pct": _pct(F.col("flagged_txn_count"), F.col("txn_count")),
        "high_risk_rate_pct": _pct(F.col("high_risk_count"), F.col("txn_count")),
        "mart_updated_at": at_ts(as_of),
    }).select(*FRAUD_KEYS, "txn_count", "unique_customers", "unique_merchants", "total_amount", "avg_amount",
              *FLAG_COUNTS, "flagged_txn_count", "high_risk_count", "flag_rate_pct", "high_risk_rate_pct",
              "amount_at_risk", "avg_velocity_1h", "max_velocity_1h", "mart_updated_at")
