"""Raw text rows to typed, checked, deduplicated silver rows for the three domains.

Each domain has ``typed_*`` (parse, normalise, derive), ``*_rules`` and ``silver_*``; ``checked_*``
is the flagged frame from which clean rows, quarantine and counts are all taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import schemas as S
from ..functions import calendar as cal, normalise as norm
from ..functions.parse import (
    BIRTH_LAYOUTS, EVENT_LAYOUTS, ORDER_LAYOUTS, as_text, lenient_cast, parse_date, parse_ts,
)
from ..operators.dedupe import latest_per_key
from ..operators.fraud import FraudConfig, baseline, with_risk, with_signals
from ..operators.validate import Rules, clean_rows, validate

VERSION = "2.0"

# Fixed value: address pattern of the e-mail check, applied to the raw text.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
MIN_AGE = 13


def with_audit(df: DataFrame, as_of: cal.AsOf, version: str = VERSION) -> DataFrame:
    return df.withColumns({"pipeline_version": F.lit(version), "silver_ts": cal.at_ts(as_of)})


def _soon(as_of: cal.AsOf) -> Column:
    return cal.at_ts(as_of) + F.expr("INTERVAL 1 HOUR")


def _outside(value: str, allowed: list[str]) -> Column:
    return ~F.col(value).isin(allowed)


# ---- orders ---------------------------------------------------------------------------------------

def typed_orders(raw: DataFrame, compat: bool = False) -> DataFrame:
    text = as_text(raw, S.ORDER_FIELDS)
    typed = text.withColumns({
        "order_ts": parse_ts("order_ts", ORDER_LAYOUTS, compat),
        "updated_ts": parse_ts("updated_ts", EVENT_LAYOUTS, compat),
        "ingest_ts": parse_ts("ingest_ts"),
        "gross_amount": lenient_cast("gross_amount", "double"),
        "discount_amount": lenient_cast("discount_amount", "double"),
        "item_count": lenient_cast("item_count", "int"),
        "order_status": norm.norm_lower("order_status"),
        "currency": norm.norm_upper("currency"),
        "payment_method": norm.norm_token("payment_method"),
        "shipping_country": norm.norm_upper("shipping_country"),
        "source_system": norm.norm_lower("source_system"),
    })
    return with_order_derived(typed)


def with_order_derived(df: DataFrame) -> DataFrame:
    gross, discount, placed = F.col("gross_amount"), F.col("discount_amount"), F.col("order_ts")
    weekday = F.dayofweek(placed)
    return df.withColumns({
        "net_amount": F.round(gross - F.coalesce(discount, F.lit(0.0)), 2),
        "discount_pct": F.when(gross > 0, F.round(discount / gross * 100, 2)).otherwise(F.lit(0.0)),
        "order_date": F.to_date(placed),
        "order_year": F.year(placed),
        "order_month": F.month(placed),
        "order_dow": weekday,
        "is_weekend": weekday.isin(1, 7),
    })


def order_rules(as_of: cal.AsOf) -> Rules:
    return {
        "null_order_id": F.col("order_id").isNull(),
        "null_customer_id": F.col("customer_id").isNull(),
        "null_order_ts": F.col("order_ts").isNull(),
        "invalid_status": _outside("order_status", S.ORDER_STATUSES),
        "invalid_currency": F.col("currency").isNotNull() & _outside("currency", S.CURRENCIES),
        "negative_amount": F.col("gross_amount") < 0,
        "future_order": F.col("order_ts") > _soon(as_of),
        "zero_items": F.col("item_count") <= 0,
    }


def checked_orders(raw: DataFrame, as_of: cal.AsOf, on_unknown: str = "pass", compat: bool = False) -> DataFrame:
    return validate(typed_orders(raw, compat), order_rules(as_of), on_unknown)


def silver_orders(raw: DataFrame, as_of: cal.AsOf, on_unknown: str = "pass", compat: bool = False,
                  seen: Observation | None = None) -> DataFrame:
    clean = clean_rows(checked_orders(raw, as_of, on_unknown, compat), seen)
    latest = latest_per_key(clean, ["order_id"], "updated_ts", ["ingest_ts"])
    return with_audit(latest, as_of).select(*S.SILVER_ORDERS)


# ---- transactions ---------------------------------------------------------------------------------

def typed_transactions(raw: DataFrame, compat: bool = False) -> DataFrame:
    return as_text(raw, S.TRANSACTION_FIELDS).withColumns({
        "transaction_ts": parse_ts("transaction_ts", EVENT_LAYOUTS, compat),
        "ingest_ts": parse_ts("ingest_ts"),
        "amount": lenient_cast("amount", "double"),
        "is_international": lenient_cast("is_international", "boolean"),
        **{c: norm.norm_lower(c) for c in
           ("transaction_type", "status", "payment_method", "merchant_category", "device_type")},
        **{c: norm.norm_upper(c) for c in ("currency", "ip_country")},
    })


def transaction_rules(as_of: cal.AsOf) -> Rules:
    return {
        "null_txn_id": F.col("transaction_id").isNull(),
        "null_customer": F.col("customer_id").isNull(),
        "null_merchant": F.col("merchant_id").isNull(),
        "null_ts": F.col("transaction_ts").isNull(),
        "null_amount": F.col("amount").isNull(),
        "negative_amount": (F.col("amount") < 0) & (F.col("transaction_type") == "purchase"),
        "invalid_type": _outside("transaction_type", S.TRANSACTION_TYPES),
        "invalid_status": _outside("status", S.TRANSACTION_STATUSES),
        "future_ts": F.col("transaction_ts") > _soon(as_of),
    }


def checked_transactions(raw: DataFrame, as_of: cal.AsOf, on_unknown: str = "pass",
                         compat: bool = False) -> DataFrame:
    return validate(typed_transactions(raw, compat), transaction_rules(as_of), on_unknown)


def flagged_transactions(clean: DataFrame, history: DataFrame | None, baseline_as_of: cal.AsOf,
                         cfg: FraudConfig = FraudConfig(), compat: bool = False) -> DataFrame:
    base = None if history is None else baseline(history, baseline_as_of, cfg.baseline_days, bounded=not compat)
    return with_risk(with_signals(clean, base, cfg.velocity_hours), cfg, compat)


def silver_transactions(raw: DataFrame, history: DataFrame | None, as_of: cal.AsOf,
                        baseline_as_of: cal.AsOf | None = None, cfg: FraudConfig = FraudConfig(),
                        on_unknown: str = "pass", compat: bool = False,
                        dedupe_first: bool = False, seen: Observation | None = None) -> DataFrame:
    """``history`` is earlier silver; None is the first run.

    Velocity counts delivered copies as well, unless ``dedupe_first``.
    """
    def latest(df: DataFrame) -> DataFrame:
        return latest_per_key(df, ["transaction_id"], "ingest_ts")

    clean = clean_rows(checked_transactions(raw, as_of, on_unknown, compat), seen)
    start = as_of if baseline_as_of is None else baseline_as_of
    if dedupe_first:
        final = flagged_transactions(latest(clean), history, start, cfg, compat)
    else:
        final = latest(flagged_transactions(clean, history, start, cfg, compat))
    made = F.col("transaction_ts")
    dated = final.withColumns({"txn_date": F.to_date(made), "txn_year": F.year(made), "txn_month": F.month(made)})
    return with_audit(dated, as_of).select(*S.SILVER_TRANSACTIONS)


# ---- customers ------------------------------------------------------------------------------------

def typed_customers(raw: DataFrame, as_of: cal.AsOf, compat: bool = False) -> DataFrame:
    typed = as_text(raw, S.CUSTOMER_FIELDS).withColumns({
        "registration_ts": parse_ts("registration_ts", EVENT_LAYOUTS, compat),
        "date_of_birth": parse_date("date_of_birth", BIRTH_LAYOUTS),
        "ingest_ts": parse_ts("ingest_ts"),
        "is_active": lenient_cast("is_active", "boolean"),
        **{c: norm.norm_lower(c) for c in ("segment", "loyalty_tier", "gender")},
        "country": norm.norm_upper("country"),
        "email_normalised": norm.norm_email("email"),
        "phone_normalised": norm.norm_phone("phone"),
        "first_name_norm": norm.norm_name("first_name"),
        "last_name_norm": norm.norm_name("last_name"),
        "postal_code_norm": norm.norm_postal("postal_code"),
        "city_norm": norm.norm_city("city"),
    }).withColumn("full_name_norm", F.concat_ws(" ", "first_name_norm", "last_name_norm"))
    return norm.with_block_keys(typed) \
        .withColumns({"age": cal.age_on("date_of_birth", as_of),
                      "days_since_registration": cal.tenure_days("registration_ts", as_of)}) \
        .withColumns({"age_band": cal.age_band("age"),
                      "customer_tenure_band": cal.tenure_band("days_since_registration")})


def customer_rules(as_of: cal.AsOf) -> Rules:
    return {
        "null_id": F.col("customer_id").isNull(),
        "no_contact": F.col("email_normalised").isNull() & F.col("phone_normalised").isNull(),
        "invalid_email": F.col("email").isNotNull() & ~F.col("email").rlike(EMAIL_PATTERN),
        "invalid_segment": F.col("segment").isNotNull() & _outside("segment", S.SEGMENTS),
        "future_dob": F.col("date_of_birth") > cal.at_date(as_of),
        "underage": F.col("age").isNotNull() & (F.col("age") < MIN_AGE),
    }


def checked_customers(raw: DataFrame, as_of: cal.AsOf, on_unknown: str = "pass", compat: bool = False) -> DataFrame:
    return validate(typed_customers(raw, as_of, compat), customer_rules(as_of), on_unknown)


def silver_customers(raw: DataFrame, as_of: cal.AsOf, on_unknown: str = "pass", compat: bool = False,
                     seen: Observation | None = None) -> DataFrame:
    clean = clean_rows(checked_customers(raw, as_of, on_unknown, compat), seen)
    latest = latest_per_key(clean, ["customer_id"], "ingest_ts")
    return with_audit(latest, as_of).withColumns({
        "resolved_entity_id": F.lit(None).cast("string"),
        "er_confidence": F.lit(None).cast("double"),
    }).select(*S.SILVER_CUSTOMERS)


# ---- run metrics ----------------------------------------------------------------------------------

def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def order_run_metrics(checked: DataFrame) -> DataFrame:
    """One row of counts and rates; distinct ids need no second pass over the silver rows."""
    valid = F.col("_is_valid")
    per_order = checked.groupBy("order_id").agg(
        F.count("*").alias("raw"), F.count_if(valid).alias("clean"),
        F.count_if(~valid).alias("bad"), F.count_if(valid.isNull()).alias("unknown"))
    total = per_order.agg(
        F.sum("raw").alias("raw_count"), F.sum("bad").alias("quarantine_count"),
        F.sum("clean").alias("clean_count"), F.sum("unknown").alias("unknown_count"),
        F.count_if(F.col("clean") > 0).alias("silver_count"))
    return total.withColumn("dupes_removed", F.col("clean_count") - F.col("silver_count")).withColumns({
        "quarantine_rate_pct": _rate(F.col("quarantine_count"), F.col("raw_count")),
        "dupe_rate_pct": _rate(F.col("dupes_removed"), F.col("clean_count")),
    })


def transaction_run_metrics(checked: DataFrame, silver: DataFrame) -> DataFrame:
    valid = F.col("_is_valid")
    before = checked.agg(F.count("*").alias("raw_count"), F.count_if(~valid).alias("quarantine_count"),
                         F.count_if(valid.isNull()).alias("unknown_count"))
    after = silver.agg(F.count("*").alias("silver_count"),
                       F.count_if(F.col("risk_tier") == "HIGH").alias("high_risk_count"),
                       F.count_if(F.col("risk_score") > 0).alias("flagged_count"))
    return _one_row(before, after).withColumn("flag_rate_pct", _rate(F.col("flagged_count"), F.col("raw_count")))


def customer_run_metrics(checked: DataFrame, silver: DataFrame) -> DataFrame:
    valid = F.col("_is_valid")
    reachable = F.col("block_key_2").isNotNull() | F.col("block_key_3").isNotNull()
    before = checked.agg(F.count("*").alias("raw_count"), F.count_if(~valid).alias("quarantine_count"),
                         F.count_if(valid.isNull()).alias("unknown_count"))
    after = silver.agg(F.count("*").alias("silver_count"), F.count_if(reachable).alias("er_ready_count"))
    return _one_row(before, after).withColumn("no_contact_info", F.col("raw_count") - F.col("er_ready_count"))


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put two one-row totals side by side."""
    one = F.lit(1).alias("_one")
    return left.select("*", one).join(right.select("*", one), "_one").drop("_one")
