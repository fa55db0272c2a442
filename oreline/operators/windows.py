"""Windows over aggregated rows, where a partition holds at most one row per period and group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rolling_avg(df: DataFrame, part: Sequence[str], order: str, col: str, rows: int, alias: str) -> DataFrame:
    """Mean of the current and the ``rows - 1`` rows before it."""
    frame = Window.partitionBy(*part).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(alias, F.avg(col).over(frame))


def lag_change(df: DataFrame, part: Sequence[str], order: Sequence[Column | str], col: str, n: int,
               previous: str, change: str) -> DataFrame:
    """Value ``n`` rows back and the difference to it."""
    seen = F.lag(col, n).over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn(previous, seen).withColumn(change, F.col(col) - F.col(previous))


def calendar_change(df: DataFrame, part: Sequence[str], day: str, col: str, days: int,
                    previous: str, change: str) -> DataFrame:
    """Value of the same group ``days`` calendar days back, by an equi-join on the shifted day."""
    shifted = df.select(*part, F.date_add(day, days).alias(day), F.col(col).alias(previous))
    joined = df.join(shifted, [*part, day], "left")
    return joined.withColumn(change, F.col(col) - F.col(previous))
