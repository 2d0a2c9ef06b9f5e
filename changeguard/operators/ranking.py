"""Ordering helpers that stay spread out when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.session import checkpointed

# Up to this size Spark itself cuts each group before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold defaults to 1000).
GROUP_LIMIT = 1000
SALTS = 64


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group with their position.

    A group is cut to ``n`` rows inside every input partition before it is
    shuffled.  For large ``n`` the cut is first made in salted sub-groups.
    """
    if n > GROUP_LIMIT:
        hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(SALTS)))
        inner = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = salted.withColumn(rank, F.row_number().over(inner)).where(F.col(rank) <= n).drop("_salt", rank)
    outer = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(outer)).where(F.col(rank) <= n)


def dense_index(df: DataFrame, order: Sequence[str], name: str = "index", by: Sequence[str] = ()) -> DataFrame:
    """0, 1, 2, ... over the whole set (or within ``by``) in a total order.

    The rows are range-partitioned and sorted once, and written to the shared
    checkpoint folder so that a re-run task cannot number them differently.
    Each partition then needs only its own start, taken from the partition
    sizes; no window ever sees more than one row per partition.
    """
    keys = [*by, *order]
    placed = checkpointed(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    offset = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # one row per task of the range partitioning, so this ordered sum is small
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_start"))
    numbered = (placed.withColumn("_part", part).join(starts, "_part")
                .withColumn(name, F.col("_start") + offset).drop("_at", "_part", "_start"))
    if not by:
        return numbered
    first = numbered.groupBy(*by).agg(F.min(name).alias("_first"))
    matched = numbered.join(first.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_first"),
                            [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return (matched.withColumn(name, F.col(name) - F.col("_first"))
            .drop("_first", *[f"_by_{c}" for c in by]))
