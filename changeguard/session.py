"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.  AQE splits skewed join
# partitions and picks broadcast joins from measured sizes, so no operator in
# this library carries a broadcast hint.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator assumes (UTC, AQE)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  parallelism: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder
    if parallelism is not None:
        builder = builder.config("spark.default.parallelism", str(parallelism))
    spark = (
        builder.master(f"local[{cores}]")
        .appName("changeguard")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def size_shuffles(spark: SparkSession, *paths: str, partition_mb: int = 128) -> int:
    """Give a job as many shuffle partitions as its input needs.

    The default of 200 makes partitions of hundreds of gigabytes out of 100 TB.
    Too many is harmless: AQE joins small ones together.  Returns the setting.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        total += target.getFileSystem(conf).getContentSummary(target).getLength()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (partition_mb << 20)))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def _shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local master, where there is one machine, may do without the
    setting; on a cluster a private folder would lose rows.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="changeguard-")
    raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for this run, beside the cluster's shared checkpoints."""
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run in here hand Python rows of at most ``BATCH_BYTES``, and one row more, at a time.

    Batches are counted in rows otherwise: ten thousand long rows are held by
    the executor, outside its heap, and by Python, more than once by each.  A
    setting of the session's own is left as it is.
    """
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def limit_batches(spark: SparkSession) -> None:
    """``small_batches`` for the rest of the session: for tables whose job only starts once they are handed on."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


# A job of so many seconds has left shuffle files that are worth a collection.
COLLECT_AFTER = 1.0


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of finished jobs.

    They go once the driver's garbage collector finds that no plan holds them.
    A driver that makes little garbage would keep all of them to the end of a
    long run; here their jobs' rows are in a table.
    """
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage is cut there."""
    folder = shared_folder(df.sparkSession, name)
    began = time.monotonic()
    df.write.parquet(folder)
    if time.monotonic() - began > COLLECT_AFTER:
        release_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
