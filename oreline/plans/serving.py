"""Read queries behind the service endpoints. Bounds are checked before anything is planned."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import AsOf, at_ts
from ..operators.filters import check_range, filter_optional, last_days, page, top_k

# Columns that customer queries return.
CUSTOMER_COLUMNS = [
    "customer_id", "resolved_entity_id", "customer_name", "email", "country", "segment", "loyalty_tier", "ltv_tier", "churn_status",
    "total_orders", "total_order_revenue", "avg_order_value", "revenue_last_30d", "estimated_ltv", "total_risk_score",
    "high_risk_txn_count", "ever_velocity_spike", "ever_amount_anomaly",
]

ORDER_ROWS = 500
FRAUD_ROWS = 200


def customer(c360: DataFrame, customer_id: str) -> DataFrame:
    return c360.where(F.col("customer_id") == customer_id).select(*CUSTOMER_COLUMNS).limit(1)


def customers(c360: DataFrame, country: str | None = None, ltv_tier: str | None = None,
              churn_status: str | None = None, limit: int = 20, offset: int = 0) -> DataFrame:
    check_range("limit", limit, 1, 100)
    check_range("offset", offset, 0)
    found = filter_optional(c360, country=country, ltv_tier=ltv_tier, churn_status=churn_status)
    return page(found.select(*CUSTOMER_COLUMNS), [F.desc("estimated_ltv"), F.asc("customer_id")], limit, offset)


def order_summary(daily: DataFrame, as_of: AsOf, days: int = 30, country: str | None = None) -> DataFrame:
    check_range("days", days, 1, 365)
    found = filter_optional(last_days(daily, "order_date", days, as_of), shipping_country=country)
    summed = found.groupBy("order_date", "shipping_country").agg(
        F.sum("net_revenue").cast("double").alias("net_revenue"),
        F.sum("order_count").cast("int").alias("order_count"),
        F.sum("unique_customers").cast("int").alias("unique_customers"),
        F.avg(F.col("avg_order_value").cast("double")).alias("avg_order_value"),
        F.sum("new_customers").cast("int").alias("new_customers"),
        F.sum("returning_customers").cast("int").alias("returning_customers"))
    return top_k(summed, [F.desc("order_date"), F.asc_nulls_last("shipping_country")], ORDER_ROWS)


def fraud_summary(fraud: DataFrame, as_of: AsOf, days: int = 30, risk_tier: str | None = None) -> DataFrame:
    check_range("days", days, 1, 180)
    tier = risk_tier.upper() if risk_tier else None
    found = filter_optional(last_days(fraud, "txn_date", days, as_of), risk_tier=tier)
    summed = found.groupBy("txn_date", "risk_tier", "merchant_category").agg(
        F.sum("txn_count").cast("int").alias("txn_count"),
        F.sum("flagged_txn_count").cast("int").alias("flagged_txn_count"),
        F.sum("high_risk_count").cast("int").alias("high_risk_count"),
        F.avg(F.col("flag_rate_pct").cast("double")).alias("flag_rate_pct"),
        F.sum("amount_at_risk").cast("double").alias("amount_at_risk"))
    order = [F.desc("txn_date"), F.desc("high_risk_count"), F.asc("risk_tier"), F.asc_nulls_last("merchant_category")]
    return top_k(summed, order, FRAUD_ROWS)


def top_ltv(c360: DataFrame, n: int = 10) -> DataFrame:
    return top_k(c360.select("customer_id", "customer_name", "country", "estimated_ltv", "ltv_tier"),
                 [F.desc("estimated_ltv"), F.asc("customer_id")], n)


# Statements a read query may not contain.
FORBIDDEN = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "MERGE")


def is_safe(sql: str | None, compat: bool = False) -> bool:
    """A single SELECT (or WITH) without a forbidden word; ``compat`` looks for them inside names too."""
    if not sql or not sql.strip():
        return False
    text = sql.strip().upper()
    if compat:
        return text.startswith("SELECT") and not any(word in text for word in FORBIDDEN[:7])
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", text, flags=re.S).strip()
    statement = bare.removesuffix(";").rstrip()
    words = set(re.findall(r"[A-Z_][A-Z0-9_]*", statement))
    return statement.split(None, 1)[0:1] in (["SELECT"], ["WITH"]) and ";" not in statement and not words & set(FORBIDDEN)


# Functions that call Java methods.
JAVA_FUNCTIONS = ("REFLECT", "JAVA_METHOD", "TRY_REFLECT")


def check_references(spark: SparkSession, sql: str, tables: Collection[str]) -> None:
    """Raise unless the parsed statement reads named tables only and calls no Java method.

    Files, catalog tables, computed identifiers and table functions are refused, in subqueries too.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    own = {name.strip().lower() for names in re.findall(r"CTE \[(.*?)\]", plan) for name in names.split(",")}
    read = {name.lower() for name in re.findall(r"UnresolvedRelation \[(.*?)\]", plan)}
    # a name of a WITH counts in its own scope only: one that a view or table outside has as well could stand for either
    shadowing = {name for name in own - {t.lower() for t in tables} if spark.catalog.tableExists(name)}
    outside = (read - own - {t.lower() for t in tables}) | shadowing
    if outside or re.search("UnresolvedTableValuedFunction|UnresolvedTVF|UnresolvedIdentifier|TableFunction", plan):
        raise ValueError(f"only the given tables may be read: {sorted(outside)}")
    text = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).upper()
    if set(re.findall(r"[A-Z_][A-Z0-9_]*", text)) & set(JAVA_FUNCTIONS):
        raise ValueError("functions that call Java methods are not allowed")


def safe_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame], max_rows: int = 100) -> DataFrame:
    """Run a read query over the given tables and nothing else; at most ``max_rows`` rows, times as ISO text.

    The names are views only while the statement is analysed; views of the caller with the same names come back after it.
    """
    check_range("max_rows", max_rows, 1, 100)
    if not is_safe(sql):
        raise ValueError("only a single read query is allowed")
    statement = sql.strip().rstrip(";")
    check_references(spark, statement, tables)
    hidden = {name: spark.table(name) for name in tables if any(t.name == name.lower() and t.isTemporary for t in spark.catalog.listTables())}
    files = spark.conf.get("spark.sql.runSQLOnFiles")
    try:
        spark.conf.set("spark.sql.runSQLOnFiles", "false")
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return iso_times(spark.sql(statement).limit(max_rows))
    finally:
        spark.conf.set("spark.sql.runSQLOnFiles", files)
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def iso_times(df: DataFrame) -> DataFrame:
    layouts = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd'T'HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd'T'HH:mm:ss"}
    return df.select(*[
        F.date_format(F.col(f"`{name}`"), layouts[kind]).alias(name) if kind in layouts else F.col(f"`{name}`")
        for name, kind in df.dtypes])


def platform_metrics(customers: DataFrame, orders: DataFrame, txns: DataFrame, entity_map: DataFrame,
                     edges: dict[str, DataFrame], published_at: AsOf | None = None,
                     as_of: AsOf | None = None) -> DataFrame:
    """One row of platform totals, all counted."""
    from ..operators.quality import table_counts

    totals = {"total_customers": customers, "total_orders": orders, "total_transactions": txns,
              "total_entity_clusters": entity_map.where("customer_id = component"),
              **{f"edge:{k}": v for k, v in edges.items()}}
    counts = table_counts(totals)
    pick = lambda name: F.max(F.when(F.col("table") == name, F.col("n"))).alias(name)
    row = counts.agg(
        pick("total_customers"), pick("total_orders"), pick("total_transactions"), pick("total_entity_clusters"),
        F.coalesce(F.sum(F.when(F.startswith("table", F.lit("edge:")), F.col("n"))), F.lit(0)).alias("graph_relationships"))
    if published_at is None or as_of is None:
        return row
    lag = (F.unix_timestamp(at_ts(as_of)) - F.unix_timestamp(at_ts(published_at))) / 60
    return row.withColumn("sync_lag_minutes", lag.cast("long"))
