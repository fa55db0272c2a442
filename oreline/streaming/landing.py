"""Event streams to raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..catalog import DOMAIN_FOLDERS, UNKNOWN_FOLDER
from ..functions.parse import CORRUPT, decode_events  # noqa: F401  (decode_events is part of this module's surface)

# Flush policy of the landing job.
FLUSH_SECONDS = 60
# about 128 MB of raw events
FLUSH_RECORDS = 500_000

# Event type to domain.
EVENT_DOMAINS = {"order": "orders", "transaction": "transactions", "click": "clickstream"}


def read_event_stream(spark: SparkSession, path: str, max_files: int | None = None, latest_first: bool = False) -> DataFrame:
    """A folder of JSON lines as a stream of text with arrival time and file name."""
    reader = spark.readStream.format("text").option("latestFirst", latest_first)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        "value", F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_arrival_ts"))


def with_source_meta(df: DataFrame, partition_key: str = "customer_id") -> DataFrame:
    """Sequence (stable over replays), partition key and arrival time of each event."""
    body = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in df.columns if not c.startswith("_")]
    return df.withColumns({
        "_seq": F.md5(F.concat_ws("\x1f", F.col("_file"), *body)),
        "_partition_key": F.col(partition_key),
    }).drop("_file")


def route_domain(event_type: Column | str) -> Column:
    kind = F.col(event_type) if isinstance(event_type, str) else event_type
    routed = F.lit("unknown")
    for name, domain in EVENT_DOMAINS.items():
        routed = F.when(kind == name, F.lit(domain)).otherwise(routed)
    return routed


def folder_of(domain: str) -> str:
    return DOMAIN_FOLDERS.get(domain, UNKNOWN_FOLDER)


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, *[c for c in ("_file", "_arrival_ts") if c in decoded.columns])


def land_bronze(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                flush_seconds: int = FLUSH_SECONDS, flush_records: int = FLUSH_RECORDS, partitions: tuple[str, ...] = ()):
    """Append the stream to parquet below ``date=`` and ``hour=`` of the flush time (UTC).

    A flush happens every ``flush_seconds``; files hold at most ``flush_records`` rows. With
    ``available_now`` the query drains what has arrived and stops; the checkpoint keeps the position.
    """
    now = F.current_timestamp()
    placed = stream.withColumns({"date": F.date_format(now, "yyyy-MM-dd"), "hour": F.date_format(now, "HH")})
    writer = placed.writeStream.format("parquet").partitionBy(*partitions, "date", "hour") \
        .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", flush_records) \
        .option("compression", "snappy")
    timed = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{flush_seconds} seconds")
    return timed.start(path)
