"""Arrived files: what they are, which to process, and which were processed before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..catalog import DOMAIN_FOLDERS
from ..functions.calendar import AsOf, at_ts

MIN_BYTES = 100
TTL_DAYS = 7
GRAINS = {"day": ["execution_date", "domain"], "file": ["execution_date", "domain", "path"]}
LEDGER = "execution_date string, domain string, path string, status string, triggered_at timestamp, expires_at timestamp"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of all files below ``root``; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root) \
        .select("path", "length", "modificationTime")


def _domain(key: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, folder in DOMAIN_FOLDERS.items():
        found = F.when(F.startswith(key, F.lit(folder)), F.lit(name)).otherwise(found)
    return found


def file_manifest(files: DataFrame, root: str = "") -> DataFrame:
    """Date, hour, domain and file name from each path, and whether to process the file or why not."""
    relative = F.when(F.contains("path", F.lit(root)), F.substring_index("path", root, -1)) if root else F.col("path")
    raw = F.ltrim(relative, F.lit("/"))
    key = F.coalesce(F.try_url_decode(raw), raw)
    described = files.withColumn("key", key).withColumns({
        "execution_date": F.nullif(F.regexp_extract("key", r"date=(\d{4}-\d{2}-\d{2})", 1), F.lit("")),
        "hour": F.nullif(F.regexp_extract("key", r"hour=(\d{2})", 1), F.lit("")),
        "domain": _domain(F.col("key")),
        "file_name": F.substring_index("key", "/", -1),
    })
    reason = F.when(~F.endswith("path", F.lit(".parquet")), "not_parquet") \
        .when(F.col("length") < MIN_BYTES, "too_small") \
        .when(F.col("domain").isNull(), "unknown_domain") \
        .when(F.col("execution_date").isNull(), "no_date")
    return described.withColumn("reason", reason) \
        .withColumn("status", F.when(F.col("reason").isNull(), "ready").otherwise("skipped"))


def new_work(manifest: DataFrame, ledger: DataFrame | None, as_of: AsOf, grain: str = "day") -> DataFrame:
    """Mark ready files as processed, or as skipped when their work was started before.

    With the ``day`` grain the first file of a date and domain starts the work and later files of the
    same day are skipped; with ``file`` every file is work of its own.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    keys = GRAINS[grain]
    ready, rest = manifest.where("status = 'ready'"), manifest.where("status <> 'ready'")
    if ledger is not None:
        live = ledger.where((F.col("status") == "TRIGGERED") & (F.col("expires_at") > at_ts(as_of)))
        done = live.select(*keys).distinct().withColumn("_done", F.lit(True))
        ready = ready.join(done, keys, "left")
    else:
        ready = ready.withColumn("_done", F.lit(None).cast("boolean"))
    first = ready.where("_done is null").groupBy(*keys).agg(
        F.min(F.struct("modificationTime", "path"))["path"].alias("_first"))
    starts = F.coalesce(F.col("path") == F.col("_first"), F.lit(False))
    marked = ready.join(first, keys, "left").withColumns({
        "status": F.when(starts, "processed").otherwise("skipped"),
        "reason": F.when(~starts, F.lit("already_processed")),
    })
    return marked.select(*manifest.columns).unionByName(rest)


def ledger_entries(work: DataFrame, as_of: AsOf, ttl_days: int = TTL_DAYS) -> DataFrame:
    """Rows to append to the ledger for the files whose work was started."""
    return work.where("status = 'processed'").select(
        "execution_date", "domain", "path", F.lit("TRIGGERED").alias("status"), at_ts(as_of).alias("triggered_at"),
        (at_ts(as_of) + F.make_interval(days=F.lit(ttl_days))).alias("expires_at"))


def work_summary(work: DataFrame) -> DataFrame:
    return work.agg(F.count_if(F.col("status") == "processed").alias("processed"),
                    F.count_if(F.col("status") == "skipped").alias("skipped"))
