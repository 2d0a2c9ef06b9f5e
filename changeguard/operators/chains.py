"""Hash chains over ledger entries: building one, and finding where one breaks."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.session import checkpointed

OUTCOMES = ("applied", "refused", "unresolved", "reconciled")
SEGMENT_SIZE = 5000
GENESIS = "sha256:" + "0" * 64
BODY_FIELDS = ("segment", "seq", "entry_id", "outcome", "command", "module", "plan_key", "at", "detail")


def entry_body(df: DataFrame) -> Column:
    """The exact text of an entry that its hash covers."""
    parts = ["date_format(at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") as at" if name == "at"
             else f"cast({name} as string) as {name}" for name in sorted(BODY_FIELDS)]
    return F.expr(f"to_json(struct({', '.join(parts)}), map('ignoreNullFields', 'false'))")


def link_hash(prev: Column, body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("|", prev, body), 256))


def _folder(limit: int):
    """The function that chains one segment.

    Made here, not named at module level, so that it travels to the executors
    by value and they need no copy of this package.
    """
    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > limit:
            raise ValueError(f"segment {rows.segment.iloc[0]} holds {len(rows)} entries, over {limit}")
        rows = rows.sort_values("seq")
        prev, before, after = rows.start_hash.iloc[0], [], []
        for body in rows.body:
            before.append(prev)
            prev = "sha256:" + hashlib.sha256(f"{prev}|{body}".encode()).hexdigest()
            after.append(prev)
        return pd.DataFrame({"segment": rows.segment.values, "seq": rows.seq.values,
                             "prev": before, "entry_hash": after})

    return fold


def chain_entries(entries: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Add ``prev`` and ``entry_hash``.  Segments are chained independently.

    ``entries`` carry segment and seq (1, 2, ... within a segment, at most
    ``SEGMENT_SIZE``); ``starts`` gives the hash each segment begins with, by
    default one derived from the segment number.  Only a chain inside one
    bounded segment is sequential; different segments run in parallel.
    """
    if starts is None:
        seeded = entries.withColumn("start_hash", first_hash(F.lit(GENESIS), F.col("segment")))
    else:
        seeded = entries.join(starts.select("segment", "start_hash"), "segment")
    bodies = seeded.select("segment", "seq", "start_hash", entry_body(entries).alias("body"))
    links = bodies.groupBy("segment").applyInPandas(
        _folder(SEGMENT_SIZE), "segment bigint, seq bigint, prev string, entry_hash string")
    return entries.join(links, ["segment", "seq"])


def first_hash(head: Column, segment: Column) -> Column:
    """Where a new segment's chain begins: bound to the ledger head before it."""
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("|", head, segment.cast("string")), 256))


def segment_table(chained: DataFrame) -> DataFrame:
    """Per segment: where its chain starts, how many entries, its last hash."""
    return chained.groupBy("segment").agg(
        F.min_by("prev", "seq").alias("chain_start"), F.count("*").alias("n"),
        F.max_by("entry_hash", "seq").alias("last_hash"))


def verify_chain(ledger: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per entry: does its hash recompute, and does it follow its
    predecessor?

    The predecessor is found by grouping on (segment, seq), to which every
    entry sends its own link and its successor's expected one.  The keys are
    unique, so even one huge segment is spread evenly; no window is used.
    """
    sound = (F.col("entry_hash") == link_hash(F.col("prev"), entry_body(ledger)))
    sent = F.array(
        F.struct(F.col("seq").alias("seq"), F.col("prev").alias("prev"),
                 F.lit(None).cast("string").alias("before"), F.coalesce(sound, F.lit(False)).alias("sound")),
        F.struct((F.col("seq") + 1).alias("seq"), F.lit(None).cast("string").alias("prev"),
                 F.col("entry_hash").alias("before"), F.lit(None).cast("boolean").alias("sound")))
    opening = segments.select("segment", F.lit(1).cast("bigint").alias("seq"),
                              F.lit(None).cast("string").alias("prev"),
                              F.col("chain_start").alias("before"), F.lit(None).cast("boolean").alias("sound"))
    links = ledger.select("segment", F.inline(sent)).withColumn("seq", F.col("seq").cast("bigint"))
    met = (links.unionByName(opening).groupBy("segment", "seq")
           .agg(F.max("prev").alias("prev"), F.max("before").alias("before"),
                F.bool_and("sound").alias("sound"), F.count("sound").alias("entries"))
           .where(F.col("entries") > 0))
    why = (F.when(F.col("entries") > 1, "position used twice")
           .when(F.col("before").isNull(), "predecessor missing")
           .when(~F.col("prev").eqNullSafe(F.col("before")), "previous hash differs")
           .when(~F.col("sound"), "entry hash differs"))
    return met.select("segment", "seq", why.isNull().alias("ok"), why.alias("why"))


def verify_segments(checked: DataFrame, ledger: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per segment: is its chain whole, and does it end where the
    segment table says it ends?"""
    held = ledger.groupBy("segment").agg(
        F.count("*").alias("found"), F.max_by("entry_hash", "seq").alias("end"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
    broken = checked.where(~F.col("ok")).groupBy("segment").agg(F.min("seq").alias("first_broken"))
    why = (F.when(F.col("first_broken").isNotNull(), "chain broken")
           .when(F.col("n").isNull(), "segment not registered")
           .when(F.col("found").isNull(), "segment missing")
           .when(F.col("found") != F.col("n"), "entry count differs")
           .when(F.col("end") != F.col("last_hash"), "last hash differs"))
    return (segments.join(held, "segment", "full").join(broken, "segment", "left")
            .select("segment", why.isNull().alias("ok"), why.alias("why"), "first_broken",
                    *[F.coalesce(c, F.lit(0)).alias(c) for c in ("found", *OUTCOMES)]))


def first_broken(checked: DataFrame) -> DataFrame:
    """The first failing position, in (segment, seq) order, over all entries."""
    bad = F.when(~F.col("ok"), F.struct("segment", "seq"))
    return checked.agg(
        (F.count_if(~F.col("ok")) == 0).alias("intact"), F.count("*").alias("entries"),
        F.min(bad).alias("_b")).select("intact", "entries", F.col("_b.segment").alias("broken_segment"),
                                       F.col("_b.seq").alias("broken_seq"))


def first_broken_by_segment(checked: DataFrame) -> DataFrame:
    """Per segment: intact, entries that verify before the break, the break."""
    broken = F.min(F.when(~F.col("ok"), F.col("seq")))
    return checked.groupBy("segment").agg(F.count("*").alias("entries"), broken.alias("first_broken")).select(
        "segment", F.col("first_broken").isNull().alias("intact"),
        F.coalesce(F.col("first_broken") - 1, F.col("entries")).alias("verified"), "first_broken")


def verify_ledger(ledger: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: is the whole ledger intact, where it breaks, and what it holds.

    ``verified`` counts the entries before the first break; everything after a
    break cannot be trusted.  The segment verdicts, one row per segment, are
    checkpointed: counting up to the break needs them twice, and the entries
    should be hashed once.
    """
    ends = checkpointed(verify_segments(verify_chain(ledger, segments), ledger, segments))
    where_broken = ends.agg(F.min(F.when(~F.col("ok"), F.col("segment"))).alias("b")).scalar()
    good = (F.when(F.col("b").isNull() | (F.col("segment") < F.col("b")), F.col("found"))
            .when(F.col("segment") == F.col("b"), F.coalesce(F.col("first_broken") - 1, F.lit(0)))
            .otherwise(0))
    return ends.withColumn("b", where_broken).agg(
        (F.count_if(~F.col("ok")) == 0).alias("intact"),
        F.coalesce(F.sum(good), F.lit(0)).alias("verified"),
        F.min("b").alias("broken_segment"),
        F.min(F.when(F.col("segment") == F.col("b"), F.col("first_broken"))).alias("broken_seq"),
        *[F.coalesce(F.sum(o), F.lit(0)).alias(o) for o in OUTCOMES])
