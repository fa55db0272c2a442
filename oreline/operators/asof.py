"""As-of join: the version of a key that was valid at a fact's time, without pairing versions with facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

SLICE_SECONDS = 7 * 24 * 3600
#: Partitions over which facts without key or time are dealt.
UNKNOWN_PARTS = 4096


def asof_join(facts: DataFrame, versions: DataFrame, key: str, at: str, since: str, values: Sequence[str], until: str | None = None,
              slice_seconds: int = SLICE_SECONDS, times: DataFrame | None = None) -> DataFrame:
    """``facts`` with ``values`` of the last version of their key that began at or before ``at``; NULL where there is none, or where
    it ended (``until``) by then.

    Facts and versions are put in one line and the last version is carried along a window. Its partitions are (key, time slice), so a key
    with a third of all facts is spread over its slices. The version valid at the start of a slice comes from a window over the versions and one
    row per slice that has facts: both small beside the facts, which are shuffled once. A fact without key or time gets NULL. Of
    versions that begin at the same time the one with the greatest values is taken.

    The slices are found by a second look at the facts. If these are themselves the outcome of a join, ``times`` names a cheaper table with
    the same values of ``key`` and ``at``, so that the join is not made twice.
    """
    def time_slice(c: str):
        return F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (slice_seconds * 1_000_000)).cast("long")

    fields = [F.col(f"`{v}`").alias(f"_v{i}") for i, v in enumerate(values)]
    ended = F.col(until).cast("timestamp") if until else F.lit(None).cast("timestamp")
    held = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), time_slice(since).alias("_slice"), F.unix_micros(F.col(since).cast("timestamp")).alias("_at"),
        F.struct(F.lit(True).alias("known"), ended.alias("until"), *fields).alias("_version"))
    # facts without key or time go along apart from all versions, rather than by a second pass
    plain = [F.col(f"`{f.name}`") for f in facts.schema.fields if isinstance(f.dataType, T.AtomicType)]
    apart = F.when(F.col(key).isNull() | F.col(at).cast("timestamp").isNull(), F.pmod(F.xxhash64(*plain), F.lit(UNKNOWN_PARTS)) + 1).otherwise(F.lit(0).cast("long"))
    rows = facts.withColumn("_apart", apart).select(F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_row"), F.col(key).alias("_key"), time_slice(at).alias("_slice"),
                                                    F.unix_micros(F.col(at).cast("timestamp")).alias("_at"), "_apart")
    seen = (facts if times is None else times).where(F.col(key).isNotNull() & F.col(at).cast("timestamp").isNotNull()) \
        .select(F.col(key).alias("_key"), time_slice(at).alias("_slice")).distinct()
    # the version a slice begins with
    marks = seen.withColumns({"_at": F.col("_slice") * (slice_seconds * 1_000_000), "_version": F.lit(None).cast(held.schema["_version"].dataType),
                                                                   "_mark": F.lit(True)})
    line = held.withColumn("_mark", F.lit(False)).unionByName(marks)
    # versions that begin with the slice belong to it: the mark stands before them
    carried = Window.partitionBy("_key").orderBy("_at", F.desc("_mark"), "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = line.withColumn("_version", F.last("_version", True).over(carried)).where("_mark and _version is not null") \
        .select("_key", "_slice", "_at", "_version").withColumn("_kind", F.lit(0))
    inside = held.join(seen, ["_key", "_slice"], "left_semi").withColumn("_kind", F.lit(1))
    empty = F.lit(None).cast(held.schema["_version"].dataType)
    whole = rows.withColumns({"_version": empty, "_kind": F.lit(2)}) \
        .unionByName(begun.unionByName(inside).withColumns({"_row": F.lit(None).cast(rows.schema["_row"].dataType), "_apart": F.lit(0).cast("long")}))
    along = Window.partitionBy("_key", "_slice", "_apart").orderBy("_at", "_kind", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = whole.withColumn("_version", F.last("_version", True).over(along)).where("_kind = 2").select("_row", "_at", "_version")
    valid = F.col("_version.known") & (F.col("_version.until").isNull() | (F.unix_micros("_version.until") > F.col("_at")))
    return found.select("_row.*", *[F.when(valid, F.col(f"_version._v{i}")).alias(v) for i, v in enumerate(values)])
