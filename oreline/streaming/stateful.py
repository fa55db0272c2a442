"""Streaming forms of dedup, velocity and the silver upsert."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from ..sources.tables import upsert_table

#: Buckets of customers in which streaming velocity keeps its state.
BUCKETS = 64


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """First delivery of each key; state is kept for ``delay`` of event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def velocity_windows(df: DataFrame, delay: str = "10 minutes", width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Transactions per customer and sliding window."""
    return df.withWatermark("transaction_ts", delay) \
        .groupBy(F.window("transaction_ts", width, slide), "customer_id").agg(F.count("*").alias("n")) \
        .select("customer_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n")


def plain(value):
    """Rows read from state as tuples, as they are written."""
    return tuple(map(plain, value)) if isinstance(value, tuple) else [plain(v) for v in value] if isinstance(value, list) else value


class TrailingCounts(StatefulProcessor):
    """Rows of one bucket of customers and one slot that wait for the watermark, and the per-second counts they need.

    A slot is as wide as the trailing window. Every row counts in its own slot and in the next one, and waits in its own, so the state of
    a key covers two windows however long or busy a customer is. It is cleared when the watermark leaves the slot. A key holds many
    customers because a call to the state costs far more than a row does.
    """

    def __init__(self, rows: T.StructType, width: int):
        self.fields, self.width = rows, width
        self.customer = rows.names.index("customer_id")

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("second", T.LongType()), T.StructField("row", self.fields)]))
        self.counts = handle.getValueState("counts", T.StructType([
            T.StructField("customers", T.ArrayType(self.fields["customer_id"].dataType)), T.StructField("seconds", T.ArrayType(T.LongType())),
            T.StructField("n", T.ArrayType(T.LongType()))]))

    def handleInputRows(self, key, rows, timerValues):
        slot = key[1]
        mark = timerValues.getCurrentWatermarkInMs()
        passed = mark // 1000 if mark > 0 else -1 << 62  # 0: there is none yet
        added, waiting = Counter(), []
        for r in rows:
            row = tuple(r.row[name] for name in self.fields.names)
            if r.customer_id is None or slot is None:
                if r.own:
                    yield self.out(row, None, False)
            elif r.second <= passed:
                if r.own:
                    yield self.out(row, None, True)
            else:
                added[r.customer_id, r.second] += r.counts
                if r.own:
                    waiting.append((r.second, row))
        if added:
            counts = Counter(self.known())
            counts.update(added)
            self.store(counts)
            self.handle.registerTimer((slot + 1) * self.width * 1000)
        if waiting:
            self.waiting.appendList(waiting)
            self.handle.registerTimer(min(second for second, _ in waiting) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        seconds, sums = defaultdict(list), defaultdict(lambda: [0])
        for (customer, second), n in sorted(self.known().items()):
            seconds[customer].append(second)
            sums[customer].append(sums[customer][-1] + n)
        left = []
        for second, row in map(plain, self.waiting.get()):
            if second <= passed:
                at, upto = seconds[row[self.customer]], sums[row[self.customer]]
                yield self.out(row, upto[bisect_right(at, second)] - upto[bisect_left(at, second - self.width)], False)
            else:
                left.append((second, row))
        if (key[1] + 1) * self.width <= passed:
            self.waiting.clear()
            self.counts.clear()
        elif left:
            self.waiting.put(left)
            self.handle.registerTimer(min(second for second, _ in left) * 1000)
        else:
            self.waiting.clear()

    def out(self, row, count: int | None, late: bool) -> Row:
        return Row(**dict(zip(self.fields.names, row)), txn_velocity_1h=count, late=late)

    def known(self) -> dict[tuple, int]:
        held = self.counts.get()
        return {} if held is None else dict(zip(zip(held[0], held[1]), held[2]))

    def store(self, counts: dict[tuple, int]) -> None:
        self.counts.update(([customer for customer, _ in counts], [second for _, second in counts], list(counts.values())))

    def close(self) -> None:
        pass


def velocity_stream(stream: DataFrame, out: str, checkpoint: str, hours: int = 1, delay_seconds: int = 0, available_now: bool = True,
                    buckets: int = BUCKETS):
    """Exact trailing count for every transaction, by event time.

    A row waits in keyed state until the watermark (the newest time seen less ``delay_seconds``) has passed it, so rows may come in any
    order within the delay. Rows that come after the watermark has passed their second change no count; they go to ``late_rows``. A row without
    time or customer has no count and does not wait. Each batch writes its own folder below ``out``, and a batch that is replayed writes
    it anew. Read them with ``velocity_rows``; ``velocity_close`` gives out what still waits when a stream has ended.
    State is kept by bucket of customers and slot; a checkpoint keeps the number of ``buckets`` it began with.
    """
    width, names = hours * 3600, stream.columns
    # times pass through Python as microseconds, whatever its time zone
    timed = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.TimestampType)]
    held = T.StructType([T.StructField(f.name, T.LongType() if f.name in timed else f.dataType) for f in stream.schema.fields])
    row = F.struct(*[(F.unix_micros(f"`{c}`") if c in timed else F.col(f"`{c}`")).alias(c) for c in names]).alias("row")
    # the watermark column stays within the row: late rows reach the state and are told apart there
    second = F.col("transaction_ts").cast("timestamp").cast("long")
    slot = F.floor(F.col("second") / F.lit(width)).cast("long")
    keyed = stream.withWatermark("transaction_ts", f"{delay_seconds} seconds").select(
        row, "customer_id", second.alias("second"), F.col("transaction_id").isNotNull().cast("int").alias("counts"))
    placed = keyed.withColumn("slots", F.when(F.col("second").isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.array(slot, slot + 1))) \
        .select("row", "customer_id", "second", "counts", F.posexplode("slots").alias("at", "slot")).withColumns({"own": F.col("at") == 0, "bucket": F.pmod(F.xxhash64("customer_id"), F.lit(buckets))}).drop("at")
    schema = T.StructType([*held.fields, T.StructField("txn_velocity_1h", T.LongType()), T.StructField("late", T.BooleanType())])
    counted = placed.groupBy("bucket", "slot").transformWithState(TrailingCounts(held, width), schema, "append", "eventTime") \
        .withColumns({c: F.timestamp_micros(f"`{c}`") for c in timed})

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late").parquet(f"{out.rstrip('/')}/epoch={epoch}")

    writer = counted.writeStream.foreachBatch(store).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def velocity_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows ``velocity_stream`` has given out, with their counts."""
    return spark.read.parquet(out).where("late = 'false'").drop("epoch", "late")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows that came too late to be counted."""
    return spark.read.parquet(out).where("late = 'true'").drop("epoch", "late", "txn_velocity_1h")


def velocity_close(spark: SparkSession, out: str, checkpoint: str, hours: int = 1) -> None:
    """Give out the rows that wait for a watermark which no further row will move, read from the state store of the last batch. Running
    it again changes nothing."""
    def held(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint)

    counts = held("counts").select(F.col("key.slot").alias("slot"), F.explode(F.arrays_zip("value.customers", "value.seconds", "value.n")).alias("c")) \
        .select(F.col("c.customers").alias("customer_id"), "slot", F.col("c.seconds").alias("second"), F.col("c.n").alias("n"))
    width = hours * 3600
    trailing = Window.partitionBy("customer_id", "slot").orderBy("second").rangeBetween(-width, 0)
    done = counts.withColumn("txn_velocity_1h", F.sum("n").over(trailing)).where(F.floor(F.col("second") / F.lit(width)) == F.col("slot"))
    waiting = held("waiting").select(F.col("list_element.row.customer_id").alias("customer"), F.col("list_element.second").alias("at"), F.col("list_element.row").alias("row"))
    rows = waiting.join(done, (F.col("customer") == F.col("customer_id")) & (F.col("at") == F.col("second")), "left") \
        .select("row.*", "txn_velocity_1h", F.lit(False).alias("late"))
    given = spark.read.parquet(out).schema
    rows = rows.withColumns({f.name: F.timestamp_micros(f"`{f.name}`") for f in given.fields if isinstance(f.dataType, T.TimestampType)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late").parquet(f"{out.rstrip('/')}/epoch=closing")


def foreach_upsert(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str,
                   partition_by: Sequence[str] = (), prepare: Callable[[DataFrame], DataFrame] | None = None,
                   available_now: bool = True):
    """Upsert each micro-batch into a stored table; ``prepare`` is the batch cleaning step."""

    def handle(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        rows = prepare(batch) if prepare else batch
        upsert_table(batch.sparkSession, path, rows, keys, partition_by)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
