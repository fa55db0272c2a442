"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key, unknown times last; full ties go by row hash.

    Catalyst turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so every map
    task sends at most one row per key and a key with very many copies stays cheap. A hash of the keys is
    the first sort key: ids begin alike, and whole rows would be fetched to compare them.
    """
    newest = [F.col(c).desc_nulls_last() for c in (order_col, *tiebreak)]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    ranked = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*newest, spread)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")
