"""Bands, fiscal calendar and relative dates; "now" is always an argument."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F

from .parse import _column

AsOf = str | date | datetime


def at_ts(as_of: AsOf) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def at_date(as_of: AsOf) -> Column:
    return F.lit(str(as_of)[:10]).cast("date")


def stepped(value: Column, steps: Sequence[tuple[float, str]], otherwise: str, op: str = "<") -> Column:
    """First step whose bound holds names the band."""
    tests = {"<": lambda b: value < b, ">=": lambda b: value >= b, ">": lambda b: value > b}
    band = None
    for bound, label in steps:
        test = tests[op](F.lit(bound))
        band = F.when(test, label) if band is None else band.when(test, label)
    return band.otherwise(otherwise)


# Upper bounds of the age and tenure bands.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
TENURE_BANDS = [(30, "new_30d"), (90, "new_90d"), (365, "established")]


def age_on(birth: Column | str, as_of: AsOf) -> Column:
    return F.floor(F.datediff(at_date(as_of), _column(birth)) / F.lit(365.25))


def age_band(age: Column | str) -> Column:
    years = _column(age)
    return F.when(years.isNull(), "unknown").otherwise(stepped(years, AGE_BANDS, "65+"))


def tenure_days(registered: Column | str, as_of: AsOf) -> Column:
    return F.datediff(at_date(as_of), F.to_date(_column(registered)))


def tenure_band(days: Column | str) -> Column:
    """An unknown registration counts as ``loyal``."""
    return stepped(_column(days), TENURE_BANDS, "loyal")


def fiscal_quarter(d: Column | str) -> Column:
    """The fiscal year starts in April."""
    return ((F.quarter(_column(d)) + F.lit(2)) % F.lit(4) + F.lit(1)).cast("int")


def fiscal_quarter_label(d: Column | str) -> Column:
    # a missing date falls to the last quarter
    return F.concat(F.lit("Q"), F.coalesce(fiscal_quarter(d), F.lit(4)).cast("string"))


def fiscal_year(d: Column | str) -> Column:
    day = _column(d)
    return F.year(F.add_months(day, -3))
