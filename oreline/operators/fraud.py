"""Fraud signals: trailing velocity, customer baseline, flags, score, tier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendar import AsOf, at_date, stepped


@dataclass(frozen=True)
class FraudConfig:
    """Thresholds and weights."""

    high_value: float = 5000.0
    velocity_threshold: int = 5
    velocity_hours: int = 1
    sigmas: float = 3.0
    intl_value: float = 1000.0
    new_customer_txns: int = 5
    new_customer_value: float = 500.0
    baseline_days: int = 30
    high_score: int = 6
    medium_score: int = 3


WEIGHTS = {
    "flag_high_value": 2,
    "flag_velocity_spike": 3,
    "flag_amount_anomaly": 3,
    "flag_intl_high_value": 2,
    "flag_new_customer_high_value": 1,
}


def per_second_counts(txns: DataFrame) -> DataFrame:
    """(customer_id, second, n)."""
    second = F.col("transaction_ts").cast("timestamp").cast("long").alias("second")
    return txns.select("customer_id", second, "transaction_id") \
        .groupBy("customer_id", "second").agg(F.count("transaction_id").alias("n"))


def trailing_counts(per_second: DataFrame, hours: int = 1) -> DataFrame:
    """(customer_id, second, txn_velocity_1h): own transactions in the trailing window, ends included.

    Every second is placed in its own and in the next window-wide slot, and the trailing sum runs per
    customer and slot. A window partition so holds at most two windows of seconds, however many
    transactions one customer makes.
    """
    width = hours * 3600
    slot = F.floor(F.col("second") / F.lit(width))
    placed = per_second.withColumn("slot", F.explode(F.array(slot, slot + F.lit(1))))
    # sorted by a hash first: ids begin alike and take long to compare
    trailing = Window.partitionBy(F.xxhash64("customer_id", "slot"), "customer_id", "slot").orderBy("second").rangeBetween(-width, 0)
    return placed.withColumn("txn_velocity_1h", F.sum("n").over(trailing)) \
        .where(F.col("slot") == slot) \
        .select("customer_id", "second", "txn_velocity_1h")


def velocity_table(txns: DataFrame, hours: int = 1) -> DataFrame:
    return trailing_counts(per_second_counts(txns), hours)


def baseline(history: DataFrame, as_of: AsOf, days: int = 30, bounded: bool = True) -> DataFrame:
    """Mean, sample deviation and number of a customer's transactions in the days before ``as_of``."""
    ts = F.col("transaction_ts")
    window = history.where(ts >= F.date_sub(at_date(as_of), days))
    if bounded:
        window = window.where(ts < at_date(as_of))
    return window.groupBy("customer_id").agg(
        F.avg("amount").alias("avg_amount_30d"),
        F.stddev_samp("amount").alias("stddev_amount_30d"),
        F.count("*").alias("txn_count_30d"),
    )


def daily_partials(history: DataFrame) -> DataFrame:
    """(customer_id, day, n, total, squares): what a baseline needs of a customer's day, exact and mergeable."""
    money = F.col("amount").cast("decimal(18,2)")
    return history.where("transaction_ts is not null").groupBy("customer_id", F.to_date("transaction_ts").alias("day")).agg(
        F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum(money).cast("decimal(28,2)").alias("total"),
        F.sum((money * money).cast("decimal(36,4)")).cast("decimal(38,4)").alias("squares"))


def merged_partials(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Partials of all days; late rows of a stored day add to it."""
    return stored.unionByName(more).groupBy("customer_id", "day").agg(
        F.sum("n").alias("n"), F.sum("amounts").alias("amounts"), F.sum("total").cast("decimal(28,2)").alias("total"),
        F.sum("squares").cast("decimal(38,4)").alias("squares"))


def baseline_from_partials(partials: DataFrame, as_of: AsOf, days: int = 30, bounded: bool = True) -> DataFrame:
    """``baseline`` from stored days: a run reads one row per customer and day of the window. Sums are decimals, so neither the order of
    rows nor the number of tasks shows in the deviation."""
    window = partials.where(F.col("day") >= F.date_sub(at_date(as_of), days))
    if bounded:
        window = window.where(F.col("day") < at_date(as_of))
    sums = window.groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.sum("amounts").alias("k"), F.sum("total").cast("decimal(38,2)").alias("total"), F.sum("squares").cast("decimal(38,4)").alias("squares"))
    k, total = F.col("k"), F.col("total")
    # k * squares - total * total is the exact k * (k - 1) fold of the variance
    spread = (k.cast("decimal(18,0)") * F.col("squares")).cast("decimal(38,4)") - (total * total).cast("decimal(38,4)")
    return sums.select(
        "customer_id", F.try_divide(total.cast("double"), k.cast("double")).alias("avg_amount_30d"),
        F.when(k > 1, F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0)) / (k.cast("double") * (k - 1).cast("double")))).alias("stddev_amount_30d"),
        F.col("n").alias("txn_count_30d"))


def with_signals(txns: DataFrame, base: DataFrame | None = None, hours: int = 1) -> DataFrame:
    """Attach velocity and baseline to each transaction in one shuffle of the transactions.

    The baseline joins the per-second velocity table, which is small and even per customer, and the
    outcome joins the rows on (customer, second). The wide rows are never gathered by customer alone, nor
    sorted: the signals, one row a customer and second, are looked up in a hash table per partition.
    """
    signals = velocity_table(txns, hours)
    if base is None:
        signals = signals.withColumns({
            "avg_amount_30d": F.lit(None).cast("double"),
            "stddev_amount_30d": F.lit(None).cast("double"),
            "txn_count_30d": F.lit(0).cast("long"),
        })
    else:
        signals = signals.join(base, "customer_id", "left")
    second = F.col("transaction_ts").cast("timestamp").cast("long")
    return txns.withColumn("second", second).join(signals.hint("shuffle_hash"), ["customer_id", "second"], "left").drop("second")


def flag_columns(cfg: FraudConfig = FraudConfig(), compat: bool = False) -> dict[str, Column]:
    """Five boolean signals; an unknown input means "not flagged" unless ``compat``."""
    amount = F.col("amount")
    seen = F.col("txn_count_30d") if compat else F.coalesce("txn_count_30d", F.lit(0))
    spread = F.col("stddev_amount_30d")
    drift = F.abs(amount - F.col("avg_amount_30d")) > spread * F.lit(cfg.sigmas)
    raw = {
        "flag_high_value": amount > cfg.high_value,
        "flag_velocity_spike": F.col("txn_velocity_1h") > cfg.velocity_threshold,
        "flag_amount_anomaly": F.when(spread > 0, drift).otherwise(F.lit(False)),
        "flag_intl_high_value": F.col("is_international") & (amount > cfg.intl_value),
        "flag_new_customer_high_value": (seen < cfg.new_customer_txns) & (amount > cfg.new_customer_value),
    }
    return raw if compat else {name: F.coalesce(flag, F.lit(False)) for name, flag in raw.items()}


def risk_score() -> Column:
    score = None
    for name, weight in WEIGHTS.items():
        term = F.col(name).cast("int") * F.lit(weight)
        score = term if score is None else score + term
    return score


def risk_tier(score: Column | str, cfg: FraudConfig = FraudConfig()) -> Column:
    value = F.col(score) if isinstance(score, str) else score
    return stepped(value, [(cfg.high_score, "HIGH"), (cfg.medium_score, "MEDIUM")], "LOW", ">=")


def with_risk(df: DataFrame, cfg: FraudConfig = FraudConfig(), compat: bool = False) -> DataFrame:
    flagged = df.withColumns(flag_columns(cfg, compat))
    if not compat:
        flagged = flagged.withColumn("txn_count_30d", F.coalesce("txn_count_30d", F.lit(0).cast("long")))
    return flagged.withColumn("risk_score", risk_score()).withColumn("risk_tier", risk_tier("risk_score", cfg))
