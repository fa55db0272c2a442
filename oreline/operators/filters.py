"""Optional filters, relative dates, paging and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import AsOf, at_date, at_ts


def filter_optional(df: DataFrame, **equals) -> DataFrame:
    """Equality on every argument that is set; empty text counts as not set."""
    wanted = {k: v for k, v in equals.items() if v is not None and v != ""}
    return reduce(lambda d, item: d.where(F.col(item[0]) == F.lit(item[1])), wanted.items(), df)


def last_days(df: DataFrame, col: str, days: int, as_of: AsOf) -> DataFrame:
    return df.where(F.col(col) >= F.date_sub(at_date(as_of), days))


def within_days(ts: Column, days: int, as_of: AsOf) -> Column:
    return ts >= at_ts(as_of) - F.make_interval(days=F.lit(days))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def check_range(name: str, value: int, low: int, high: int | None = None) -> int:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be at least {low}" + (f" and at most {high}" if high is not None else ""))
    return value


def project_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])
