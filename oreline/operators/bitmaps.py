"""Exact distinct counts that can be merged: bitmaps over dense numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import keep_table


def dense_numbers(ids: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number): distinct ids numbered from 0 without gaps; those of ``known`` keep their numbers, new ones follow.

    Ids are numbered within tasks and moved by the count of the tasks before, so no task sees them all. The numbers are stored before use,
    as they must not change when a task runs again.
    """
    new = ids.where(F.col(column).isNotNull()).select(column).distinct()
    start = 0
    if known is not None:
        new = new.join(known, column, "left_anti")
        start = (known.agg(F.max("number")).first()[0] or -1) + 1 if not known.isEmpty() else 0
    placed = keep_table(new.withColumn("_id", F.monotonically_increasing_id()), "placed").withColumns(
        {"_task": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("_task").agg(F.count("*").alias("_n"))  # a row per task
    before = sizes.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    fresh = keep_table(placed.join(before, "_task").select(column, (F.col("_at") + F.col("_before") + start).cast("long").alias("number")), "numbers")
    return fresh if known is None else known.select(column, "number").unionByName(fresh)


def distinct_bitmaps(rows: DataFrame, by: Sequence[str], number: str = "number") -> DataFrame:
    """(by, bucket, bitmap): the numbers met per group, 32,768 to a bitmap. A null number is none.

    Bitmaps are built before the shuffle, so a hot group sends a few kilobytes per task and bucket, not its rows.
    """
    return rows.where(F.col(number).isNotNull()).groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence) -> DataFrame:
    """Bitmaps of finer groups joined into those of coarser ones."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct numbers per group."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))
