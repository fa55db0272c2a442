"""Declarative data tests: one aggregate per table, one grouped count per uniqueness test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import AsOf, at_ts


@dataclass(frozen=True)
class Test:
    kind: str
    column: str
    failing: Column | None = None


def unique(column: str) -> Test:
    return Test("unique", column)


def not_null(column: str) -> Test:
    return Test("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Sequence) -> Test:
    """A NULL passes."""
    return Test("accepted_values", column, ~F.col(column).isin(list(values)))


def accepted_range(column: str, low=None, high=None) -> Test:
    tests = []
    if low is not None:
        tests.append(F.col(column) < F.lit(low))
    if high is not None:
        tests.append(F.col(column) > F.lit(high))
    return Test("accepted_range", column, reduce(lambda a, b: a | b, tests, F.lit(False)))


def _unique_failures(df: DataFrame, column: str) -> DataFrame:
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("failures"))


def failures(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """(column, test, failures) of one table."""
    parts = [_unique_failures(df, t.column).select(F.lit(t.column).alias("column"), F.lit(t.kind).alias("test"), "failures")
             for t in tests if t.kind == "unique"]
    counted = [t for t in tests if t.failing is not None]
    if counted:
        one = df.agg(*[F.count_if(t.failing).alias(f"t{i}") for i, t in enumerate(counted)])
        parts.append(one.select(F.explode(F.array(*[
            F.struct(F.lit(t.column).alias("column"), F.lit(t.kind).alias("test"), F.col(f"t{i}").alias("failures"))
            for i, t in enumerate(counted)])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def run_suite(tables: dict[str, DataFrame], suite: dict[str, Sequence[Test]]) -> DataFrame:
    """(table, column, test, failures, status) over all tables that are present."""
    parts = [failures(tables[name], tests).select(F.lit(name).alias("table"), "column", "test", "failures")
             for name, tests in suite.items() if name in tables and tests]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def freshness(df: DataFrame, column: str, as_of: AsOf, warn_hours: float = 25, error_hours: float = 48) -> DataFrame:
    """One row: newest time, its age in hours, and pass, warn or fail; no rows at all is fail."""
    newest = df.agg(F.max(column).alias("newest"))
    age = (at_ts(as_of).cast("double") - F.col("newest").cast("double")) / 3600
    return newest.withColumn("age_hours", age).withColumn(
        "status", F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "fail")
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()])


def standard_suite() -> dict[str, list[Test]]:
    """The tests every run applies to silver, metrics and marts."""
    from .. import schemas as S

    return {
        "orders": [unique("order_id"), not_null("order_id"), not_null("customer_id"), not_null("order_ts"),
                   accepted_values("order_status", S.ORDER_STATUSES), not_null("net_amount")],
        "transactions": [unique("transaction_id"), not_null("transaction_id"), not_null("customer_id"),
                         not_null("merchant_id"), not_null("amount"), accepted_values("risk_tier", S.RISK_TIERS)],
        "customers": [unique("customer_id"), not_null("customer_id")],
        "customer_360": [unique("customer_id"), not_null("customer_id"), not_null("resolved_entity_id"),
                         not_null("total_orders"), accepted_range("total_orders", 0), not_null("estimated_ltv"),
                         accepted_range("estimated_ltv", 0), accepted_values("ltv_tier", S.LTV_TIERS),
                         accepted_values("churn_status", S.CHURN_STATUSES)],
        "daily_order_summary": [not_null("order_date"), not_null("order_count"), accepted_range("order_count", 0),
                                not_null("net_revenue"), accepted_range("net_revenue", 0)],
        "fraud_summary": [not_null("txn_date"), accepted_range("flag_rate_pct", 0, 100),
                          accepted_range("high_risk_rate_pct", 0, 100)],
        "customer_order_metrics": [unique("customer_id"), not_null("customer_id"), accepted_range("total_orders", 1)],
        "customer_txn_metrics": [unique("customer_id"), not_null("customer_id"), accepted_range("estimated_ltv", 0)],
    }
