"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split hot key is worth one more shuffle behind the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # small files are dealt to tasks by their bytes, not by their number: unequal ones would leave most rows to a few tasks
    "spark.sql.files.openCostInBytes": "128k",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # keyed state on local disk with change logs in the checkpoint, not on the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

RUNTIME_DEFAULTS = (
    "spark.sql.session.timeZone",
    "spark.sql.ansi.enabled",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
    "spark.sql.files.openCostInBytes",
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
)


def build_session(app: str = "oreline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC, ANSI, adaptive joins) in a session somebody else built."""
    for key in RUNTIME_DEFAULTS:
        spark.conf.set(key, DEFAULTS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A local session without the setting gets a
    fresh temporary folder; a cluster without it is an error, since a machine-local folder would be
    lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="oreline-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/oreline/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and return it without its plan.

    Iterations would otherwise grow the plan each round and recompute every earlier one after an
    executor loss.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def keep_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read that: for input an iteration scans every round."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Delete the shuffle files of finished work: Spark does so when the driver collects what refers to them, which a large heap puts off."""
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores.

    A parquet file is read by row group, so a table of few groups, or of files of very unequal length, keeps few tasks busy in all that
    is computed before the next shuffle. For narrow rows in front of work that costs more than sending them.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, each: int = 500_000) -> Iterator[None]:
    """Shuffles of what runs inside have a partition for every ``each`` rows, so that a task's memory does not grow with the input."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-rows // each))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def is_blank(df: DataFrame) -> bool:
    """True when there is no row; stops at the first one found."""
    return df.isEmpty()
