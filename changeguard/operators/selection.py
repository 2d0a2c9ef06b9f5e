"""Exact cuts of a sorted order without sorting all of it.

Bounds from a small sample divide the first sort key into cells: one for each
bound itself, one for each gap between bounds.  Rows are counted per cell, so
the cells that hold a wanted position are known exactly; only their rows are
looked at further, with new bounds or, where all keys are equal, by the next
key.  The sample decides how fast a cell gets small, not which rows are found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeguard.session import written

BOUNDS = 64
SAMPLE = 4000  # rows, about
SMALL = 100_000  # so many rows may be sorted as one
ROUNDS = 12

Key = tuple[str, bool]  # column, descending; nulls are last, or first on request


def _bounds(df: DataFrame, name: str, rows: int) -> list:
    """Some values of the column, in order; at most ``BOUNDS``."""
    share = min(1.0, SAMPLE / max(rows, 1))
    found = df.where(F.col(name).isNotNull()).select(name).sample(share, seed=17).limit(4 * SAMPLE).collect()
    values = sorted({r[0] for r in found})
    step = max(1, len(values) // BOUNDS)
    return values[step // 2::step][:BOUNDS]


def _cell(df: DataFrame, name: str, bounds: list, desc: bool, nulls_first: bool) -> Column:
    """The cell of a row in sort order: odd ones hold one key, even ones the gap beside it, null has its own."""
    kind = df.schema[name].dataType
    value = F.col(name)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        mid = (low + high) // 2
        bound = F.lit(bounds[mid]).cast(kind)
        return F.when(value == bound, 2 * mid + 1).when(value < bound, search(low, mid)).otherwise(search(mid + 1, high))

    last = 2 * len(bounds)
    cell = F.lit(last) - search(0, len(bounds)) if desc else search(0, len(bounds))
    return F.when(value.isNull(), -1 if nulls_first else last + 1).otherwise(cell)


def _sort(keys: Sequence[Key], nulls_first: bool) -> list[Column]:
    names = {(False, False): "asc_nulls_last", (True, False): "desc_nulls_last",
             (False, True): "asc_nulls_first", (True, True): "desc_nulls_first"}
    return [getattr(F.col(name), names[desc, nulls_first])() for name, desc in keys]


def rows_between(df: DataFrame, keys: Sequence[Key], first: int, last: int, nulls_first: bool = False,
                 small: int = SMALL) -> DataFrame:
    """The rows at positions ``first`` to ``last`` - 1 of the order; as many are sorted as one at the end, and little more.

    Rows that are equal in all keys are taken in any order.
    """
    at, skipped, total = 0, 0, df.count()
    for _ in range(ROUNDS * len(keys)):
        if total <= max(small, 2 * (last - first)) or at == len(keys):
            break
        name, desc = keys[at]
        bounds = _bounds(df, name, total)
        placed = df.withColumn("_cell", _cell(df, name, bounds, desc, nulls_first))
        counts = sorted((r._cell, r["count"]) for r in placed.groupBy("_cell").count().collect())
        held, before = [], skipped
        for cell, n in counts:
            if before < last and before + n > first:
                held.append((cell, before, n))
            before += n
        if not held:
            return df.limit(0)
        low, high = held[0][0], held[-1][0]
        single = low == high and (low % 2 == 1 or low < 0 or low > 2 * len(bounds) or not bounds)
        at += single
        if len(held) == len(counts) and not single:
            break
        df = placed.where(F.col("_cell").between(low, high)).drop("_cell")
        skipped, total = held[0][1], sum(n for _, _, n in held)
    return df.orderBy(*_sort(keys, nulls_first)).offset(max(first - skipped, 0)).limit(last - max(first, skipped))


def first_per_group(df: DataFrame, by: Sequence[str], keys: Sequence[Key], n: int, nulls_first: bool = False,
                    small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows of each group, and (by, truncated) of each group.

    Cells are counted per group; whole cells are taken or left, and only the
    cell in which a group reaches ``n`` is gone into.  So a cap of any size
    costs a few passes over the rows, and no task gets a whole group.
    """
    totals = df.groupBy(*by).agg(F.count("*").alias("rows"))
    truncated = totals.select(*by, (F.col("rows") > n).alias("truncated"))
    taken, rest, at = None, df.withColumn("_room", F.lit(n).cast("long")).withColumn("_path", F.lit("")), 0
    for _ in range(ROUNDS * len(keys)):
        open_ = rest.groupBy(*by, "_path").agg(F.count("*").alias("n"))
        size = open_.agg(F.max("n").alias("most"), F.sum("n").alias("all")).head()
        if size.most is None or size.most <= small or at == len(keys):
            break
        name, desc = keys[at]
        bounds = _bounds(rest, name, size.all)
        if not bounds:  # nothing but nulls
            at += 1
            continue
        placed = rest.withColumn("_cell", _cell(rest, name, bounds, desc, nulls_first))
        group = [*by, "_path"]
        counts = placed.groupBy(*group, "_cell").agg(F.count("*").alias("_n"))
        running = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        counts = written(counts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))), "cells")
        same = [placed[c].eqNullSafe(counts[c]) for c in (*group, "_cell")]
        known = placed.join(counts, same).select(*[placed[c] for c in placed.columns], "_n", "_before")
        whole = known.where(F.col("_before") + F.col("_n") <= F.col("_room")).select(*df.columns)
        taken = whole if taken is None else taken.unionByName(whole)
        border = known.where((F.col("_before") < F.col("_room")) & (F.col("_before") + F.col("_n") > F.col("_room")))
        rest = written(border.withColumn("_room", F.col("_room") - F.col("_before"))
                       .withColumn("_path", F.concat("_path", F.lit("/"), F.col("_cell").cast("string")))
                       .drop("_cell", "_n", "_before"), "border")
        spans = rest.groupBy(*group).agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
        at += spans.where("_low <> _high").isEmpty()  # nothing but one key in each group: the next one decides
    order = Window.partitionBy(*by, "_path").orderBy(*_sort(keys, nulls_first))
    last = rest.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("_room")).select(*df.columns)
    return last if taken is None else taken.unionByName(last), truncated
