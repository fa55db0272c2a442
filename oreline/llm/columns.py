"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: other columns of any name can't clash."""
    return df.select(*[df[f"`{theirs}`"].alias(ours) for ours, theirs in columns.items()])


def field(df: DataFrame, name: str) -> T.StructField:
    """A nullable field of the same type as column ``name``."""
    return T.StructField(name, df.schema[name].dataType, True)


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
