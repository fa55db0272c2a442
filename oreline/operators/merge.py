"""Upserts, inserts, column updates, incremental replacement and slowly changing dimensions.

All take and return DataFrames; ``oreline.sources.tables`` applies them to stored tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import AsOf, at_ts


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Source rows replace target rows of the same key; new keys are added.

    ``keep`` names columns whose stored value survives the update of an existing row.
    """
    incoming = source
    if keep:
        stored = target.select(*keys, F.lit(True).alias("_stored"), *[F.col(c).alias(f"_old_{c}") for c in keep])
        incoming = source.join(stored, list(keys), "left").select(*[
            F.when(F.col("_stored"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c)
            for c in source.columns
        ])
    untouched = target.join(source.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(incoming, allowMissingColumns=True)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; the caller appends them."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def update_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Set ``cols`` on matched rows, NULL included; other rows stay as they are."""
    fresh = source.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    return target.join(fresh, list(keys), "left").select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ])


def align_append_new(target: DataFrame, source: DataFrame) -> DataFrame:
    """Union by name; columns only one side has are NULL on the other."""
    return target.unionByName(source, allowMissingColumns=True)


def high_water_mark(target: DataFrame | None, col: str, start: str):
    """Newest stored value, as a literal that prunes files; ``start`` on the first run."""
    if target is None:
        return start
    newest = target.agg(F.max(col).alias("m")).first()["m"]
    return start if newest is None else newest


def newer_than(df: DataFrame, col: str, mark) -> DataFrame:
    return df.where(F.col(col) > F.lit(mark).cast(df.schema[col].dataType))


def incremental_replace(target: DataFrame, facts: DataFrame, delta: DataFrame, key: str, build) -> DataFrame:
    """Rebuild the groups the delta touches from their full history, keep the others.

    ``build`` maps facts to one row per ``key``; the outcome equals a full rebuild.
    """
    touched = delta.select(key).distinct()
    rebuilt = build(facts.join(touched, key, "left_semi"))
    return upsert(target, rebuilt, [key])


def incremental_replace_delta_only(target: DataFrame, delta: DataFrame, key: str, build) -> DataFrame:
    """Compatible form: a touched group keeps only what the delta says about it."""
    return upsert(target, build(delta), [key])


def record_hash(cols: Sequence[str]):
    """SHA-256 over the tracked columns; a NULL differs from empty text."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]), 256)


def surrogate_key(key: str, since: str):
    """128 bits of the business key and the start of validity: stable without a counter."""
    return F.md5(F.concat_ws("|", F.col(key), F.col(since).cast("string")))


OPEN = "valid_to"


def scd2_apply(dim: DataFrame | None, updates: DataFrame, key: str, tracked: Sequence[str], as_of: AsOf) -> DataFrame:
    """Close the current row of each changed key and open a new one.

    ``updates`` holds one row per key with ``key`` and the tracked columns.
    """
    hashed = updates.select(key, *tracked).withColumn("record_hash", record_hash(tracked))

    def opened(rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            "valid_from": at_ts(as_of),
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        })

    if dim is None:
        return opened(hashed)
    incoming = hashed.select(key, F.col("record_hash").alias("_new_hash"))
    current = F.col("is_current")
    joined = dim.join(incoming, key, "left")
    changed = current & F.col("_new_hash").isNotNull() & ~F.col("_new_hash").eqNullSafe(F.col("record_hash"))
    closed = joined.withColumns({
        "valid_to": F.when(changed, at_ts(as_of)).otherwise(F.col("valid_to")),
        "is_current": current & ~changed,
    }).drop("_new_hash")
    standing = dim.where(current).select(key, "record_hash")
    fresh = hashed.join(standing, [key, "record_hash"], "left_anti")
    return closed.unionByName(opened(fresh), allowMissingColumns=True).select(*dim.columns)
