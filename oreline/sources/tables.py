"""Reading raw and silver tables; writing, upserting and clustering stored tables."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.calendar import AsOf
from ..functions.parse import CORRUPT, as_text, decode_events
from ..operators.merge import insert_new, upsert
from ..session import keep_table
from . import snapshots
from .snapshots import filesystem as _hadoop


class MissingData(Exception):
    """Required input has not arrived."""


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def has_files(spark: SparkSession, path: str) -> bool:
    """True as soon as one data file is found below ``path``; hidden folders do not count."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return False
    root = fs.makeQualified(target).toString().rstrip("/")
    listing = fs.listFiles(target, True)
    while listing.hasNext():
        below = listing.next().getPath().toString()[len(root):].split("/")
        if not any(part.startswith(("_", ".")) and "=" not in part for part in below):
            return True
    return False


def table_exists(spark: SparkSession, path: str) -> bool:
    return snapshots.latest(spark, path) is not None or has_files(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a stored table; a plain parquet folder is read as it is."""
    now = snapshots.latest(spark, path)
    return spark.read.parquet(path) if now is None else snapshots.read_parts(spark, path, now)


# ---- reading --------------------------------------------------------------------------------------

def read_bronze(spark: SparkSession, path: str, date: str, fields: Sequence[str]) -> DataFrame:
    """One day of a raw table, every column as text whatever type it landed with.

    Files of one table may differ in columns and types, so the schema comes from the files of the day
    and the partition filter keeps the scan to that day.
    """
    day = spark.read.option("mergeSchema", True).option("basePath", path).parquet(f"{path.rstrip('/')}/date={date}")
    return as_text(day, fields)


def read_prefix(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All parquet files below a path as one table; an empty one when there is nothing."""
    if not has_files(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def read_json_events(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, malformed) rows of JSON lines; malformed rows keep their text."""
    rows = decode_events(spark.read.text(path), schema)
    bad = F.col(CORRUPT).isNotNull()
    return rows.where(~bad).drop(CORRUPT), rows.where(bad).select(CORRUPT)


def read_event_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A file holding one JSON array of events; such a file cannot be split, so one task reads it."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def read_silver(spark: SparkSession, path: str, ts: str | None = None, since: AsOf | None = None,
                year: str | None = None, month: str | None = None) -> DataFrame:
    """Stored silver rows from ``since`` on; year and month columns, if named, prune folders."""
    now = snapshots.latest(spark, path)
    if ts is None or since is None:
        return read_table(spark, path)
    start = F.lit(str(since)).cast("timestamp")
    first = int(str(since)[:4]) * 12 + int(str(since)[5:7])
    if now is None:
        df = spark.read.parquet(path)
        if year and month:
            df = df.where(F.col(year) * 12 + F.col(month) >= first)
    else:
        def recent(_, values):
            return None in (values.get(year), values.get(month)) or int(values[year]) * 12 + int(values[month]) >= first

        df = snapshots.read_parts(spark, path, now, recent)
    return df.where(F.col(ts) >= start)


def load_by_name(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """The target's columns, found by name without regard to case, cast to its types; absent ones NULL."""
    found = {c.lower(): c for c in df.columns}

    def pick(field: T.StructField) -> Column:
        if field.name.lower() not in found:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(f"`{found[field.name.lower()]}`")
        return (source.try_cast(field.dataType) if lenient else source.cast(field.dataType)).alias(field.name)

    return df.select(*[pick(f) for f in schema.fields])


# ---- writing --------------------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write parquet; a partitioned table is overwritten as a whole, not folder by folder."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def write_quarantine(df: DataFrame, path: str, date: str) -> None:
    write_table(df, f"{path.rstrip('/')}/date={date}")


def _labels(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """Folders of the rows with their values as text: as many as the batch touches."""
    # distinct before the label, which takes longer to make than to compare the values it is made of
    held = df.select(*cols).distinct() if cols else df.limit(1)
    rows = held.select(snapshots.label(cols).alias("label"), *[F.col(c).cast("string").alias(c) for c in cols]).collect()
    return {r["label"]: {c: r[c] for c in cols} for r in rows}


def _checked_batch(source: DataFrame, keys: Sequence[str], kept: bool = False) -> DataFrame:
    """The batch, computed once, or as it is if it is ``kept`` already; it must hold each key once and no key may be NULL."""
    batch = source if kept else keep_table(source, "batch")
    wrong = batch.groupBy(*keys).count().where((F.col("count") > 1) | reduce(or_, [F.col(k).isNull() for k in keys]))
    if not wrong.isEmpty():
        raise ValueError(f"the batch holds a key twice or a NULL key: {wrong.first()}")
    return batch


def _adopted(spark: SparkSession, path: str, cols: Sequence[str]) -> snapshots.Snapshot | None:
    """The newest version; a plain parquet folder becomes version 1 first."""
    now = snapshots.latest(spark, path)
    if now is None and has_files(spark, path):
        plain = spark.read.parquet(path)
        now = _replaced(plain, path, None, cols, _labels(plain, cols))
    return now


def _replaced(rows: DataFrame, path: str, now: snapshots.Snapshot | None, cols: Sequence[str], touched: dict[str, dict]) -> snapshots.Snapshot:
    """Commit a version in which the touched folders hold ``rows`` and all others what they held."""
    write, names = snapshots.write_parts(rows, path, cols)
    kept = {} if now is None else {k: v for k, v in now.parts.items() if k not in touched}
    parts = kept | {name: {"writes": [write], "values": touched[name]} for name in names}
    done = snapshots.Snapshot(1 if now is None else now.number + 1, rows.schema if now is None else now.schema, parts, {} if now is None else now.notes)
    snapshots.commit(rows.sparkSession, path, done)
    return done


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 partition_by: Sequence[str] = (), keep: Sequence[str] = (), kept: bool = False) -> None:
    """Merge ``source`` into the stored table, writing anew only the folders it touches.

    Touched are the folders of the incoming rows and those that hold an older row of the same key, so
    a key may move between folders. The merged rows become the newest version when all of them are
    written; a run that stops before leaves the table as it was, and the same batch again gives the same
    table. A batch with two rows of one key, or with a NULL key, is refused. ``kept`` says that ``source`` reads stored rows, which
    are not stored again.
    """
    cols = list(partition_by)
    batch = _checked_batch(source, keys, kept)
    now = _adopted(spark, path, cols)
    if now is None:
        _replaced(batch, path, None, cols, _labels(batch, cols))
        return
    target = snapshots.read_parts(spark, path, now)
    # reads keys and folder columns of the target only
    holding = _labels(target.select(*dict.fromkeys([*keys, *cols])).join(batch.select(*keys), list(keys), "left_semi"), cols)
    touched = _labels(batch, cols) | holding
    old = snapshots.read_parts(spark, path, now, lambda name, _: name in touched)
    _replaced(upsert(old, batch, keys, keep).select(*target.columns), path, now, cols, touched)


def append_new(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
               partition_by: Sequence[str] = (), kept: bool = False) -> None:
    """Append the rows whose key is not stored yet, as one new version. ``kept`` as for ``upsert_table``."""
    cols = list(partition_by)
    batch = _checked_batch(source, keys, kept)
    now = _adopted(spark, path, cols)
    if now is None:
        _replaced(batch, path, None, cols, _labels(batch, cols))
        return
    fresh = insert_new(snapshots.read_parts(spark, path, now), batch, keys)
    fresh = now_columns(fresh, now.schema)
    values = _labels(batch, cols)
    write, names = snapshots.write_parts(fresh, path, cols)
    parts = dict(now.parts)
    for name in names:
        held = parts.get(name, {"writes": [], "values": values[name]})
        parts[name] = {**held, "writes": [*held["writes"], write]}
    snapshots.commit(spark, path, snapshots.Snapshot(now.number + 1, now.schema, parts, now.notes))


def now_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The stored columns of a batch; those it lacks are NULL."""
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_part(spark: SparkSession, path: str, rows: DataFrame, name: str) -> None:
    """Make ``rows`` the whole of the folder called ``name``, whatever it held before."""
    now = snapshots.latest(spark, path)
    write, names = snapshots.write_parts(rows, path, (), named=name)  # no folder is made for no rows
    parts = {**(now.parts if now else {}), name: {"writes": [write] if names else [], "values": {"name": name}}}
    snapshots.commit(spark, path, snapshots.Snapshot(now.number + 1 if now else 1, rows.schema, parts, now.notes if now else {}))


def read_part(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """One folder written by ``replace_part``; the one with the largest name by default."""
    now = snapshots.latest(spark, path)
    if now is None:
        raise MissingData(f"nothing is stored in {path}")
    chosen = name or max(now.parts)
    return snapshots.read_parts(spark, path, now, lambda part, _: part == chosen)


def merge_into(table: str, source: DataFrame, keys: Sequence[str], insert_only: bool = False) -> None:
    """The same upsert on a catalog whose tables support row-level MERGE."""
    on = reduce(and_, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys])
    merge = source.alias("source").mergeInto(table, on)
    if not insert_only:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()


# ---- clustering -----------------------------------------------------------------------------------

def _ordinal(df: DataFrame, name: str) -> Column:
    """A number that grows with the value: numbers and times themselves, of anything else the first seven bytes of its text."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    return F.conv(F.rpad(F.left(F.hex(c.cast("string").cast("binary")), F.lit(14)), 14, "0"), 16, 10).cast("double")


def z_value(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """Bits of each column's range bucket (2 ** bits of them, by approximate quantiles), interleaved: rows close in all columns
    get close values. NULL comes first."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_ordinal(df, name), shares, 4 << bits).alias(f"c{i}") for i, name in enumerate(columns)]).first()
    parts = []
    for offset, name in enumerate(columns):
        cuts = F.lit(sorted(set(found[f"c{offset}"] or [])) or [0.0])
        bucket = F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= _ordinal(df, name))), F.lit(0)).cast("long")
        parts += [F.shiftleft(F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + offset) for bit in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def clustered(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), files: int | None = None, zorder: bool = True) -> DataFrame:
    """The rows laid out so that those close in ``columns`` are written to the same files and scans skip the others.

    The number of files is that of the shuffle, which adaptive execution fits to the size, unless ``files`` is given; there are at least
    sixteen times as many cells as shuffle partitions. The last sort key is a hash of the row, so rows of one cell, such as those
    of a hot customer, can be spread over files too.
    """
    by = [F.col(c) for c in partition_by]
    wanted = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(2, -(-math.ceil(math.log2(16 * wanted)) // len(columns)))
    keyed = df.withColumn("_z", z_value(df, columns, bits)) if zorder else df
    order = by + ([F.col("_z")] if zorder else [F.col(f"`{c}`") for c in columns]) + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    placed = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return placed.sortWithinPartitions(*order).drop("_z")


def cluster_write(df: DataFrame, path: str, columns: Sequence[str], partition_by: Sequence[str] = (),
                  files: int | None = None, zorder: bool = True) -> None:
    """Write a plain table clustered by ``columns``."""
    write_table(clustered(df, columns, partition_by, files, zorder), path, partition_by)


def recluster(spark: SparkSession, path: str, columns: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Write a stored table anew, clustered, as its next version; readers keep the version they began with."""
    now = _adopted(spark, path, list(partition_by))
    if now is not None:
        rows = clustered(snapshots.read_parts(spark, path, now), columns, partition_by)
        _replaced(rows, path, now, list(partition_by), {name: part["values"] for name, part in now.parts.items()})


def analyze(spark: SparkSession, table: str) -> None:
    """Row count, size and column statistics of a catalog table, for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def require_partitions(spark: SparkSession, paths: Sequence[str], date: str) -> None:
    """Raise unless every path has files for the date."""
    missing = [p for p in paths if not has_files(spark, f"{p.rstrip('/')}/date={date}")]
    if missing:
        raise MissingData(f"no data for {date} in: {', '.join(missing)}")
