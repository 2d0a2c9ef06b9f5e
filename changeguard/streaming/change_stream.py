"""The change scan as a stream: every change once, governed or not.

The checkpoint holds the position, so nothing is skipped between runs.  Each
micro-batch reads the ledger anew, drops what was delivered before, and writes
its own folder, which a repeated batch replaces.

Window counts are kept the same way: a micro-batch writes what it adds to each
window, and the sums over all batches are the counts.  Nothing waits for a
watermark, so late rows and rows without a readable time are counted as in a
batch; late ones are listed besides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeguard.operators.changes import match_governed, read_changes, split_unreadable
from changeguard.operators.ledgers import governed_keys
from changeguard.sources import commits

LedgerReader = Callable[[SparkSession], tuple[DataFrame, DataFrame | None]]


def delivered_before(spark: SparkSession, sink: str, batch_id: int, lowest, highest) -> DataFrame | None:
    """Refs delivered by other batches, in the time range of this one.

    The range is pushed into the scan, so old deliveries are pruned by their
    file statistics.  Unreadable times have no range and are always compared.
    """
    if not commits.exists(spark, f"{sink}/batches"):
        return None
    rows = spark.read.parquet(f"{sink}/batches").where(F.col("batch_id") != batch_id)
    near = F.col("modified_at").isNull()
    if lowest is not None:
        near = near | F.col("modified_at").between(F.lit(lowest), F.lit(highest))
    return rows.where(near).select("change_ref", "occurrence")


def with_poll(stream: DataFrame) -> DataFrame:
    """A stream of files with ``poll``, the file that each row came in."""
    return stream.withColumn("poll", F.col("_metadata.file_path"))


def numbered(changes: DataFrame) -> DataFrame:
    """``changes`` with ``occurrence``.

    A readable change is the same as any other of its record and instant.
    Without a readable time nothing tells two changes of a record apart, but a
    poll does not return a change twice: the n-th equal row of one poll is the
    n-th such change, and so is the n-th of any other poll.  Polls are told
    apart by the column ``poll``; without it all rows are of one.
    """
    timed, unreadable = split_unreadable(changes)
    keys = [c for c in ("change_ref", "poll") if c in changes.columns]
    rest = F.struct(*[c for c in changes.columns if c not in keys])
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(rest))
    return timed.withColumn("occurrence", F.lit(1)).unionByName(
        unreadable.withColumn("occurrence", F.row_number().over(order)))


def dedupe_delivered(batch: DataFrame, delivered: DataFrame | None) -> DataFrame:
    """One row per change and occurrence, without those already delivered."""
    keys = ["change_ref", "occurrence"]
    batch = batch if "occurrence" in batch.columns else numbered(batch)
    cols = [c for c in batch.columns if c not in keys]
    once = batch.groupBy(*keys).agg(F.any_value(F.struct(*cols)).alias("r")).select(*keys, "r.*")
    return once if delivered is None else once.join(delivered, keys, "left_anti")


def write_batch(batch: DataFrame, batch_id: int, sink: str, read_ledger: LedgerReader,
                raw: str = "modified_raw") -> None:
    spark = batch.sparkSession
    changes = read_changes(batch, raw).persist()
    span = changes.agg(F.min("modified_at").alias("low"), F.max("modified_at").alias("high")).head()
    fresh = dedupe_delivered(changes, delivered_before(spark, sink, batch_id, span.low, span.high))
    ledger, records = read_ledger(spark)
    flagged = match_governed(fresh, governed_keys(ledger, records))
    flagged.write.mode("overwrite").parquet(f"{sink}/batches/batch_id={batch_id}")
    changes.unpersist()


def stream_changes(stream: DataFrame, read_ledger: LedgerReader, sink: str, checkpoint: str,
                   trigger: dict | None = None, raw: str = "modified_raw") -> StreamingQuery:
    """Start the stream.  Rows a run takes are bounded by the source
    (``maxFilesPerTrigger``), which never skips what it did not return."""
    return (stream.writeStream
            .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, sink, read_ledger, raw))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def delivered_changes(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/batches")


def settled_changes(spark: SparkSession, sink: str, read_ledger: LedgerReader) -> DataFrame:
    """Delivered changes with ungoverned ones tested once more: a ledger entry
    is written after its change, so the first look can be too early."""
    ledger, records = read_ledger(spark)
    rows = delivered_changes(spark, sink).withColumnRenamed("governed", "governed_at_first")
    again = match_governed(rows, governed_keys(ledger, records))
    return again.withColumn("governed", F.col("governed") | F.col("governed_at_first"))


def window_start(instant: str, width: str) -> Column:
    """The start of the window an instant is in, windows counted from 1970; null for a null instant."""
    micros = F.unix_micros(instant)
    size = F.expr(f"unix_micros(timestamp_seconds(0) + interval {width})")
    return F.timestamp_micros(micros - F.pmod(micros, size))


def window_counts(changes: DataFrame, width: str = "1 hour", lateness: str | None = None) -> DataFrame:
    """Governed and ungoverned changes per module and window of time.

    The same rows in a batch and on a stream (output mode ``complete`` or
    ``update``).  Changes whose time cannot be read have a null window; no row
    is dropped as late.  ``lateness`` on a stream only sets the watermark that
    its progress reports.  For a stream without end, ``stream_window_counts``
    keeps the counts in a table instead of in memory.
    """
    if lateness is not None and changes.isStreaming:
        changes = changes.withWatermark("modified_at", lateness)
    return (changes.groupBy("module", window_start("modified_at", width).alias("window_start"))
            .agg(F.count_if("governed").alias("governed"), F.count_if(~F.col("governed")).alias("ungoverned")))


def write_window_batch(batch: DataFrame, batch_id: int, sink: str, read_ledger: LedgerReader,
                       width: str = "1 hour", lateness: str = "1 hour", raw: str = "modified_raw") -> None:
    """What one micro-batch adds to each window, and its rows that came late.

    Late rows are those further behind the newest instant of all earlier
    batches than ``lateness``.  A repeated batch replaces what it wrote.
    """
    spark = batch.sparkSession
    ledger, records = read_ledger(spark)
    flagged = match_governed(read_changes(batch, raw), governed_keys(ledger, records)).persist()
    part = f"batch_id={batch_id}"
    newest = None
    if commits.exists(spark, f"{sink}/marks"):
        newest = spark.read.parquet(f"{sink}/marks").where(F.col("batch_id") < batch_id).agg(F.max("newest")).head()[0]
    late = F.lit(False) if newest is None else F.col("modified_at") < F.lit(newest) - F.expr(f"interval {lateness}")
    flagged.where(late).write.mode("overwrite").parquet(f"{sink}/late/{part}")
    window_counts(flagged, width).write.mode("overwrite").parquet(f"{sink}/counts/{part}")
    flagged.agg(F.max("modified_at").alias("newest")).write.mode("overwrite").parquet(f"{sink}/marks/{part}")
    flagged.unpersist()


def stream_window_counts(stream: DataFrame, read_ledger: LedgerReader, sink: str, checkpoint: str,
                         width: str = "1 hour", lateness: str = "1 hour", trigger: dict | None = None,
                         raw: str = "modified_raw") -> StreamingQuery:
    """Count a feed per module and window as it arrives; read with ``counted_windows`` and ``late_changes``."""
    return (stream.writeStream
            .foreachBatch(lambda batch, i: write_window_batch(batch, i, sink, read_ledger, width, lateness, raw))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def counted_windows(spark: SparkSession, sink: str) -> DataFrame:
    """The counts of all batches together, the rows that ``window_counts`` has in a batch."""
    return (spark.read.parquet(f"{sink}/counts").groupBy("module", "window_start")
            .agg(F.sum("governed").alias("governed"), F.sum("ungoverned").alias("ungoverned")))


def late_changes(spark: SparkSession, sink: str) -> DataFrame:
    """Rows that came late, with the batch that counted them: their windows were told before."""
    return spark.read.parquet(f"{sink}/late")
