"""Exact deduplication by salted digest groups that compare whole texts.

Equal means: identical after lower-casing A-Z.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.llm.text import lower_ascii
from changeguard.session import written

# A digest is hot when it holds more than one row in this many.  There are
# fewer hot digests than this, whatever the input, so they may be broadcast.
HOT_PARTS = 4096
SALTS = 64


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def _contents(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """One row per distinct (digest, text): ``keep_id``, ``group_size``.

    1. Spark's partial aggregation deduplicates inside each input partition.
    2. Groups are merged by (digest, salt, text).  Only hot digests are
       salted, by the partition they come from; for all others this is final.
    3. The salt winners of hot digests are merged by (digest, text); the rest
       pass under a row number of their own and carry no text.
    The whole text is part of the key in each step.
    """
    marked = rows.join(F.broadcast(hot), "digest", "left")
    merged = (
        marked.withColumn("salt", F.when(F.col("hot"), F.spark_partition_id() % SALTS + 1).otherwise(0))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    salted = F.col("salt") > 0
    return (
        merged.select(
            "digest",
            F.when(salted, F.col("norm")).alias("norm"),
            F.when(~salted, F.monotonically_increasing_id()).alias("single"),
            "keep_id",
            "group_size",
        )
        .groupBy("digest", "norm", "single")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def exact_copies(
    docs: DataFrame, text: str = "text", key: str = "doc_id", digest: Callable[[Column], Column] = sha256_hex
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest.

    Of equal texts the row with the largest ``key`` is kept; of repeated rows
    with that same key, one.  Null keys are smaller than all others: a group
    of null keys only has a null keep_id and keeps one row.  An empty table
    gives an empty result.  Other columns are not read.

    ``digest`` may be weak: texts that share one are told apart by content.
    """
    norm = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).alias("doc_id"), norm.alias("norm")).withColumn("digest", digest(F.col("norm")))
    narrow = written(rows.select("doc_id", "digest", F.monotonically_increasing_id().alias("row")), "digests")
    many = (F.col("count") > 1) & (F.col("count") * HOT_PARTS > narrow.count())
    hot = narrow.groupBy("digest").count().filter(many).select("digest", F.lit(True).alias("hot"))
    contents = written(
        _contents(rows, hot)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")),
        "contents",
    )
    alone = contents.filter("contents = 1").select("digest", "keep_id", "group_size")
    first = narrow.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("first"))
    plain = narrow.join(alone.join(first, "digest"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
    )
    shared = contents.filter("contents > 1").select("digest")
    if shared.isEmpty():
        return plain
    # Different texts with one digest: the same by content.  Salted once more, as one of them may be common.
    mixed = written(rows.join(shared, "digest").withColumn("row", F.monotonically_increasing_id()), "mixed")
    best = (
        mixed.groupBy("digest", "norm")
        .agg(F.max(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size"))
    )
    return plain.unionByName(
        mixed.join(best, ["digest", "norm"]).select(
            "doc_id",
            F.col("first.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("first.row")).alias("kept"),
            "digest",
        )
    )


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that :func:`exact_copies` does not keep; all columns stay as they are."""
    kept = (
        exact_copies(docs, text, key).filter("kept").select(F.col("doc_id").alias("__kept_id"), F.col("digest").alias("__kept"))
    )
    norm = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    marked = docs.withColumn("__digest", sha256_hex(norm))
    same = F.col("__digest").eqNullSafe(F.col("__kept")) & marked[key].eqNullSafe(F.col("__kept_id"))
    return marked.join(kept, same, "left_semi").dropDuplicates([key, "__digest"]).drop("__digest")
