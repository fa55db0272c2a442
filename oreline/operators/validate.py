"""Row rules: flag, split, count.

A rule is a boolean column that is true for a bad row. A rule that is NULL (its input is missing) is
"unknown"; the caller says whether that passes, is quarantined, or drops the row from both outputs.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, functions as F

Rules = dict[str, Column]

VALID = "_is_valid"
UNKNOWN_POLICIES = ("pass", "quarantine", "drop")


def flag_name(rule: str) -> str:
    return f"_err_{rule}"


def _any(flags: list[Column]) -> Column:
    return reduce(or_, flags, F.lit(False))


def validity(rules: Rules, on_unknown: str = "pass") -> Column:
    """True, false, or NULL for a row that belongs to neither side."""
    if on_unknown not in UNKNOWN_POLICIES:
        raise ValueError(f"on_unknown must be one of {UNKNOWN_POLICIES}")
    if on_unknown == "drop":
        return ~_any(list(rules.values()))
    unknown = F.lit(on_unknown == "quarantine")
    return ~_any([F.coalesce(rule, unknown) for rule in rules.values()])


def validate(df: DataFrame, rules: Rules, on_unknown: str = "pass") -> DataFrame:
    flagged = df.withColumns({flag_name(name): rule for name, rule in rules.items()})
    flags = {name: F.col(flag_name(name)) for name in rules}
    return flagged.withColumn(VALID, validity(flags, on_unknown))


def error_mask(rules: Rules) -> Column:
    """Bit ``i`` is set when rule ``i`` fired."""
    bits = [F.coalesce(rule, F.lit(False)).cast("int") * F.lit(1 << i) for i, rule in enumerate(rules.values())]
    return reduce(lambda a, b: a + b, bits, F.lit(0))


def clean_rows(validated: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Valid rows without their flags.

    The counts of ``validation_counts`` are observed on the way: ``seen`` has them after the clean rows
    were written. Observing also keeps the filter above the parsing, which would otherwise be done a
    second time below it.
    """
    flags = [c for c in validated.columns if c.startswith("_err_")]
    watched = validated.observe(seen or f"validated-{uuid.uuid4().hex}", *_counts())
    return watched.where(F.col(VALID)).drop(VALID, *flags)


def quarantined_rows(validated: DataFrame) -> DataFrame:
    return validated.where(~F.col(VALID))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_rows(validated), quarantined_rows(validated)


def rule_counts(validated: DataFrame) -> DataFrame:
    """(rule, n) among quarantined rows: one aggregate for all rules."""
    flags = [c for c in validated.columns if c.startswith("_err_")]
    totals = quarantined_rows(validated).agg(*[F.count_if(F.col(c)).alias(c) for c in flags])
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(c.removeprefix("_err_")).alias("rule"), F.col(c).alias("n")) for c in flags
    ])).alias("r")).select("r.*")


def _counts() -> list[Column]:
    valid = F.col(VALID)
    return [
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(valid).alias("clean_count"),
        F.count_if(~valid).alias("quarantine_count"),
        F.count_if(valid.isNull()).alias("unknown_count"),
    ]


def validation_counts(validated: DataFrame) -> DataFrame:
    """raw = clean + quarantine + unknown."""
    return validated.agg(*_counts())
