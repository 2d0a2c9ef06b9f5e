"""Which changes no approval explains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import change_ref, iso_utc
from changeguard.operators.ledgers import covers_from, governed_keys, unmatchable_count
from changeguard.operators.ranking import GROUP_LIMIT, top_per_group
from changeguard.operators.scans import changed_since, exclude_delivered
from changeguard.operators.selection import first_per_group


def read_changes(feed: DataFrame, raw: str = "modified_raw") -> DataFrame:
    """A raw feed (module, id, modified text) with instants and change refs."""
    timed = feed.where(F.coalesce("id", F.lit("")) != "").withColumn("modified_at", iso_utc(raw))
    return timed.withColumn("change_ref", change_ref("module", "id", "modified_at", raw))


def split_unreadable(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an instant, and rows whose time cannot be read (kept aside,
    never dropped: a watermark would lose them)."""
    known = F.col("modified_at").isNotNull()
    return changes.where(known), changes.where(~known)


def cap_per_module(changes: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """The oldest ``cap`` changes of each module, and whether more wait.

    A large cap is cut by counting ranges of time, so no task ranks a module.
    """
    if cap >= GROUP_LIMIT:
        keys = [("modified_at", False), ("id", False), ("change_ref", False)]
        return first_per_group(changes, ["module"], keys, cap, nulls_first=True, small=max(cap // 8, GROUP_LIMIT))
    order = [F.col("modified_at").asc_nulls_first(), F.col("id"), F.col("change_ref")]
    ranked = top_per_group(changes, ["module"], order, cap + 1)
    truncated = ranked.groupBy("module").agg((F.max("rank") > cap).alias("truncated"))
    return ranked.where(F.col("rank") <= cap).drop("rank"), truncated


def match_governed(changes: DataFrame, governed: DataFrame) -> DataFrame:
    """Flag each change: did a governed write report exactly this instant?

    ``governed`` has one row per key, so no change is multiplied; a record with
    very many changes sits on the left side, which AQE can split.
    """
    keys = governed.select("module", "id", "modified_at").distinct().withColumn("_hit", F.lit(True))
    return (changes.join(keys, ["module", "id", "modified_at"], "left")
            .withColumn("governed", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def scan_changes(feed: DataFrame, ledger: DataFrame, since: str | None = None, cap: int | None = None,
                 delivered: DataFrame | None = None, records: DataFrame | None = None,
                 raw: str = "modified_raw") -> tuple[DataFrame, DataFrame]:
    """Changes since a mark with ``governed``, and a one-row summary.

    The ledger must be read after the feed, so that a write whose approval is
    recorded a moment later is not reported.
    """
    found = changed_since(read_changes(feed, raw), since)
    truncated = None
    if cap is not None:
        found, more = cap_per_module(found, cap)
        truncated = more.agg(F.coalesce(F.bool_or("truncated"), F.lit(False)).alias("t")).scalar()
    scanned = found
    skipped = None
    if delivered is not None:
        found, dropped = exclude_delivered(found, delivered)
        skipped = dropped.scalar()
    changes = match_governed(found, governed_keys(ledger, records))
    summary = changes.agg(
        F.count("*").alias("changes"),
        F.count_if(~F.col("governed")).alias("ungoverned"),
        F.count_if(F.col("modified_at").isNull()).alias("unreadable"),
    ).select(
        "changes", "ungoverned", "unreadable",
        (scanned.agg(F.count("*").alias("n")).scalar() if delivered is not None else F.col("changes"))
        .alias("rows_scanned"),
        (skipped if skipped is not None else F.lit(0).cast("bigint")).alias("skipped_already_delivered"),
        (truncated if truncated is not None else F.lit(False)).alias("truncated"),
        covers_from(ledger).scalar().alias("ledger_covers_from"),
        unmatchable_count(ledger, records).scalar().alias("unmatchable_ledger_entries"))
    return summary, changes


def changes_by_day(changes: DataFrame) -> DataFrame:
    """Governed and ungoverned changes per module and day; unreadable times
    are their own (null) day."""
    return (changes.groupBy("module", F.to_date("modified_at").alias("day"))
            .agg(F.count_if("governed").alias("governed"),
                 F.count_if(~F.col("governed")).alias("ungoverned")))
