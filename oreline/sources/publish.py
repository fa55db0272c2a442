"""Publishing marts: unload, load once, sync, continuous load, snapshot."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.calendar import AsOf, at_ts
from . import snapshots
from .tables import has_files, load_by_name, replace_part, write_table

LOADED_AT = "_loaded_at"
MAX_FILE_MB = 256
LEDGER = "file string, loaded_at timestamp"


def unload(df: DataFrame, path: str, date: str, max_file_mb: int = MAX_FILE_MB, row_bytes: int | None = None) -> str:
    """Write a mart under ``date=``, replacing that day, with files capped by rows per file.

    ``row_bytes`` is the expected size of a stored row; by default a rough figure from the schema.
    """
    width = row_bytes or max(8, sum(f.dataType.jsonValue() == "string" and 24 or 8 for f in df.schema.fields))
    target = f"{path.rstrip('/')}/date={date}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .option("maxRecordsPerFile", max(1, max_file_mb * 1024 * 1024 // width)).parquet(target)
    return target


def copy_into(spark: SparkSession, src: str, target: str, schema: T.StructType, as_of: AsOf,
              on_error: str = "continue") -> int:
    """Append the files below ``src`` that were not loaded before; returns the rows loaded.

    Columns match by name without regard to case. A row with a value that does not convert is left out
    (``continue``) or stops the load (``abort``). Sources are kept. The rows and the list of files they came from become
    current together, so a load that stops midway has loaded nothing.
    """
    if on_error not in ("continue", "abort"):
        raise ValueError("on_error must be 'continue' or 'abort'")
    if not has_files(spark, src):
        return 0
    now = snapshots.latest(spark, target)
    rows = spark.read.option("recursiveFileLookup", True).parquet(src).withColumn("_file", F.col("_metadata.file_path"))
    if now:
        known = snapshots.read_notes(spark, target, now, "ledger", LEDGER)
        rows = rows.join(known.select(F.col("file").alias("_file")), "_file", "left_anti")
    typed = _convert(rows, schema) if on_error == "continue" else load_by_name(rows, schema)
    seen = Observation()
    final = typed.withColumn(LOADED_AT, at_ts(as_of)).observe(seen, F.count(F.lit(1)).alias("n"))
    write, names = snapshots.write_parts(final, target, ())
    files, _ = snapshots.write_parts(rows.select(F.col("_file").alias("file")).distinct().withColumn("loaded_at", at_ts(as_of)), target, ())
    parts = {"all": {"writes": [*(now.parts.get("all", {"writes": []})["writes"] if now else []), *([write] if names else [])], "values": {}}}
    notes = {"ledger": [*(now.notes.get("ledger", []) if now else []), files]}
    snapshots.commit(spark, target, snapshots.Snapshot(now.number + 1 if now else 1, now.schema if now else final.schema, parts, notes))
    return int(seen.get["n"])


def load_date(spark: SparkSession, src: str, target: str, schema: T.StructType, date: str, as_of: AsOf) -> int:
    """Make the files below ``src`` the target's rows of ``date``, in place of any it had for that date; returns how many."""
    seen = Observation()
    rows = _convert(spark.read.parquet(src), schema).withColumn(LOADED_AT, at_ts(as_of)).observe(seen, F.count(F.lit(1)).alias("n"))
    replace_part(spark, target, rows, date)
    return int(seen.get["n"])


def _convert(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows without those that hold a value of another type."""
    found = {c.lower(): c for c in rows.columns}
    lost = [F.col(f"`{found[f.name.lower()]}`").isNotNull()
            & F.col(f"`{found[f.name.lower()]}`").try_cast(f.dataType).isNull()
            for f in schema.fields if f.name.lower() in found]
    return load_by_name(rows.where(~reduce(or_, lost, F.lit(False))), schema, lenient=True)


def autoload(spark: SparkSession, src: str, src_schema: T.StructType, target: str, schema: T.StructType,
             checkpoint: str, as_of: AsOf | None = None):
    """Load files as they arrive; the checkpoint remembers them. Runs until all present files are in."""
    stream = spark.readStream.schema(src_schema).option("recursiveFileLookup", True).parquet(src)
    loaded = F.current_timestamp() if as_of is None else at_ts(as_of)
    return load_by_name(stream, schema, lenient=True).withColumn(LOADED_AT, loaded) \
        .writeStream.format("parquet").option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start(target)


RESULT = "table string, rows_loaded long, execution_date string, duration_sec double"


def sync_marts(spark: SparkSession, marts: dict[str, DataFrame], schemas: dict[str, T.StructType], export_root: str,
               target_root: str, date: str, as_of: AsOf, only: Sequence[str] | None = None) -> DataFrame:
    """Unload each mart and load it into the second store; one result row per mart.

    A date that is synced again replaces itself; ``tables.read_part`` reads the newest date, the current mart.
    """
    unknown = set(only or ()) - set(marts)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    results = []
    for name, df in marts.items():
        if only and name not in only:
            continue
        started = time.monotonic()
        exported = unload(df, f"{export_root.rstrip('/')}/{name}", date)
        n = load_date(spark, exported, f"{target_root.rstrip('/')}/{name}", schemas[name], date, as_of)
        results.append((name, n, date, round(time.monotonic() - started, 1)))
    return spark.createDataFrame(results, RESULT)


def snapshot(df: DataFrame, path: str, as_of: AsOf) -> None:
    write_table(df.withColumn("snapshot_ts", at_ts(as_of)), path)
