"""Analytics views over the gold marts. All inputs are already aggregated per day and group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import AsOf, at_ts
from ..operators.filters import last_days
from ..operators.windows import calendar_change, lag_change, rolling_avg


def vw_customer_segments(c360: DataFrame) -> DataFrame:
    return c360.where("is_active").groupBy("country", "ltv_tier", "churn_status", "segment", "loyalty_tier").agg(
        F.count("*").alias("customer_count"),
        F.avg(F.col("estimated_ltv").cast("double")).alias("avg_ltv"),
        F.sum("estimated_ltv").alias("total_ltv"),
        F.avg("total_orders").alias("avg_orders"),
        F.avg(F.col("revenue_last_30d").cast("double")).alias("avg_revenue_30d"),
        F.count_if("ever_velocity_spike").alias("risky_customers"),
    ).orderBy(F.desc("total_ltv"))


def vw_revenue_trend(daily: DataFrame, as_of: AsOf, days: int = 90) -> DataFrame:
    """Revenue per day and country with the mean of seven rows; customers add up over groups, as published."""
    per_day = last_days(daily, "order_date", days, as_of).groupBy("order_date", "shipping_country").agg(
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("unique_customers").alias("unique_customers"),
        F.avg("avg_order_value").alias("avg_order_value"),
        F.sum("new_customers").alias("new_customers"),
    ).withColumn("_revenue", F.col("net_revenue").cast("double"))
    rolled = rolling_avg(per_day, ["shipping_country"], "order_date", "_revenue", 7, "revenue_7d_rolling_avg")
    return rolled.drop("_revenue").orderBy(F.desc("order_date"))


def vw_fraud_dashboard(fraud: DataFrame, as_of: AsOf, days: int = 90, wow: str = "rows") -> DataFrame:
    """Fraud figures per day, tier and category.

    ``wow="rows"`` compares with the value seven rows back in the tier; ``"calendar"`` with the same
    tier and category seven days earlier.
    """
    if wow not in ("rows", "calendar"):
        raise ValueError("wow must be 'rows' or 'calendar'")
    per_day = last_days(fraud, "txn_date", days, as_of).groupBy("txn_date", "risk_tier", "merchant_category").agg(
        F.sum("txn_count").alias("total_txns"),
        F.sum("flagged_txn_count").alias("total_flagged"),
        F.sum("high_risk_count").alias("total_high_risk"),
        F.sum("amount_at_risk").alias("total_amount_at_risk"),
        F.avg("flag_rate_pct").alias("avg_flag_rate"),
        F.avg("high_risk_rate_pct").alias("avg_high_risk_rate"),
    )
    names = {"previous": "high_risk_count_prev_week", "change": "high_risk_wow_change"}
    if wow == "rows":
        compared = lag_change(per_day, ["risk_tier"], ["txn_date", "merchant_category"], "total_high_risk", 7, **names)
    else:
        compared = calendar_change(per_day, ["risk_tier", "merchant_category"], "txn_date", "total_high_risk", 7, **names)
    return compared.orderBy(F.desc("txn_date"), F.desc("total_high_risk"))


def vw_executive_summary(daily: DataFrame) -> DataFrame:
    newcomers, actives = F.sum("new_customers"), F.sum("unique_customers")
    return daily.groupBy(F.date_trunc("month", "order_date").cast("date").alias("month")).agg(
        F.sum("net_revenue").alias("monthly_revenue"),
        F.sum("order_count").alias("monthly_orders"),
        actives.alias("monthly_active_customers"),
        newcomers.alias("monthly_new_customers"),
        F.round(F.try_divide(newcomers, actives) * 100, 1).alias("new_customer_rate_pct"),
    ).orderBy(F.desc("month"))


def exact_active_customers(stg: DataFrame) -> DataFrame:
    """Customers per month, each counted once (the summed figure counts one person per group)."""
    month = F.date_trunc("month", "order_date").cast("date").alias("month")
    return stg.select(month, "customer_id").groupBy("month", "customer_id").agg(F.lit(1).alias("seen")) \
        .groupBy("month").agg(F.count("*").alias("active_customers"))


def with_snapshot_ts(df: DataFrame, as_of: AsOf) -> DataFrame:
    return df.withColumn("snapshot_ts", at_ts(as_of))
