"""Matching rows with existing records: upserts, merges and related lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import SYSTEM_FIELDS, flat, is_blank, is_ignorable
from changeguard.operators.ranking import dense_index, top_per_group

BATCH = 100


# --- upsert -----------------------------------------------------------------

def check_key_fields(incoming: DataFrame, check_fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that carry every check field, and those that do not."""
    absent = F.array_compact(F.array(*[F.when(is_blank(incoming, f), F.lit(f)) for f in check_fields]))
    tagged = incoming.withColumn("missing_keys", absent)
    ok = F.size("missing_keys") == 0
    return tagged.where(ok).drop("missing_keys"), tagged.where(~ok)


def _keyed(df: DataFrame, check_fields: Sequence[str], *carry: str) -> DataFrame:
    """(carry, ordinal, field, value) for every check field that holds a value."""
    cells = F.array(*[F.when(~is_blank(df, f), F.struct(F.lit(i).alias("ordinal"), F.lit(f).alias("field"),
                                                        flat(df, f).alias("value")))
                      for i, f in enumerate(check_fields)])
    return df.select(*carry, F.inline(F.array_compact(cells)))


def upsert_match(incoming: DataFrame, existing: DataFrame, check_fields: Sequence[str]) -> DataFrame:
    """Each input row (``row_id``) to the record it would update, or a create.

    Keys are (field, value) pairs, so a value found under one field never
    matches another.  Both sides are reduced to one row per pair before they
    meet; several existing records under one pair are reported in
    ``candidates`` and the smallest id is taken.  ``duplicate_in_batch`` marks
    rows that share a pair with another input row.
    """
    asked = _keyed(incoming, check_fields, "row_id")
    pairs = asked.groupBy("ordinal", "field", "value").agg(F.count("*").alias("asked"))
    known = (_keyed(existing, check_fields, "id", "modified_time").groupBy("field", "value")
             .agg(F.min_by(F.struct("id", "modified_time"), "id").alias("hit"), F.count("*").alias("candidates")))
    met = pairs.join(known, ["field", "value"], "left")
    rows = asked.join(met.select("field", "value", "asked", "hit", "candidates"), ["field", "value"])
    best = F.min_by(F.struct("field", "value", "hit", "candidates"),
                    F.when(F.col("hit").isNotNull(), F.col("ordinal")))
    found = rows.groupBy("row_id").agg(
        best.alias("m"), (F.max("asked") > 1).alias("duplicate_in_batch"))
    hit = F.col("m.hit.id").isNotNull()
    return (incoming.select("row_id").join(found, "row_id", "left")
            .select("row_id", F.when(hit, "update").otherwise("create").alias("action"),
                    F.col("m.hit.id").alias("id"), F.when(hit, F.col("m.field")).alias("matched_on"),
                    F.when(hit, F.col("m.value")).alias("matched_value"),
                    F.col("m.hit.modified_time").alias("modified_time"),
                    F.when(hit, F.col("m.candidates")).alias("candidates"),
                    F.coalesce("duplicate_in_batch", F.lit(False)).alias("duplicate_in_batch")))


def batch_index(df: DataFrame, order: Sequence[str], size: int = BATCH) -> DataFrame:
    """Number rows into batches of ``size`` in a total order."""
    return (dense_index(df, order, "_i").withColumn("batch", F.floor(F.col("_i") / F.lit(size)).cast("bigint"))
            .drop("_i"))


def calls_required(rows: Column, size: int = BATCH) -> Column:
    return F.ceil(rows / F.lit(size)).cast("bigint")


# --- merge ------------------------------------------------------------------

def check_merge_pairs(pairs: DataFrame, max_losers: int | None = 3) -> DataFrame:
    """Add ``reason``: why a (master_id, loser_id) pair cannot be merged, or null."""
    named = pairs.select(F.trim("master_id").alias("master_id"), F.trim("loser_id").alias("loser_id"))
    uses = named.groupBy("loser_id").agg(
        F.count("*").alias("_uses"), F.min("master_id").alias("_low"), F.max("master_id").alias("_high"))
    load = named.groupBy("master_id").agg(F.count("*").alias("_load"))
    masters = named.select(F.col("master_id").alias("loser_id")).distinct().withColumn("_is_master", F.lit(True))
    blank = (F.coalesce("master_id", F.lit("")) == "") | (F.coalesce("loser_id", F.lit("")) == "")
    over = F.col("_load") > max_losers if max_losers is not None else F.lit(False)
    reason = (F.when(blank, "blank id")
              .when(F.col("master_id") == F.col("loser_id"), "record merged into itself")
              .when(F.col("_low") != F.col("_high"), "loser of two masters")
              .when(F.col("_uses") > 1, "loser repeated")
              .when(F.coalesce("_is_master", F.lit(False)), "loser is itself a master")
              .when(over, "too many losers"))
    return (named.join(uses, "loser_id", "left").join(load, "master_id", "left")
            .join(masters, "loser_id", "left").select("master_id", "loser_id", reason.alias("reason")))


def merge_conflicts(pairs: DataFrame, records: DataFrame, fields: Sequence[str] | None = None,
                    system_fields: Sequence[str] = SYSTEM_FIELDS) -> DataFrame:
    """Per pair and field: what the master will overwrite or only the loser has.

    Both records are joined to the pair once and compared field by field inside
    the row; only differing fields become rows.
    """
    names = [n for n in (fields or records.columns) if n != "id"]
    sides = {}
    for side in ("master", "loser"):
        cells = F.struct(*[F.struct(flat(records, n).alias("text"), is_blank(records, n).alias("blank")).alias(n)
                           for n in names])
        sides[side] = records.select(F.col("id").alias(f"{side}_id"), cells.alias(side))
    both = (pairs.select("master_id", "loser_id").join(sides["loser"], "loser_id")
            .join(sides["master"], "master_id", "left"))
    found = []
    for name in sorted(names):
        mine, theirs = F.col("master").getField(name), F.col("loser").getField(name)
        absent = F.coalesce(mine["blank"], F.lit(True))
        differs = ~mine["text"].eqNullSafe(theirs["text"])
        if is_ignorable(name, system_fields):
            kind = F.when(~theirs["blank"] & differs, "system")
        else:
            kind = (F.when(theirs["blank"], F.lit(None)).when(absent, "only_on_loser")
                    .when(differs, "conflict"))
        found.append(F.struct(F.lit(name).alias("field"), kind.alias("kind"),
                              F.when(~absent, mine["text"]).alias("master"), theirs["text"].alias("loser")))
    rows = F.filter(F.array(*found), lambda x: x["kind"].isNotNull())
    return both.select("master_id", "loser_id", F.inline(rows))


def titles_sample(children: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` titles per (parent, list), cut before they are gathered."""
    first = top_per_group(children.where(F.col("title").isNotNull()), ["parent_id", "list"],
                          [F.col("title")], n)
    return (first.groupBy("parent_id", "list")
            .agg(F.array_sort(F.collect_list("title")).alias("titles")))


def related_counts(ids: DataFrame, children: Mapping[str, DataFrame | None], titles: int = 5) -> DataFrame:
    """Children of each record per list.  A list that could not be read has a
    null count; a list with nothing in it has zero.

    Each child table has (parent_id, title).
    """
    readable = {name: df for name, df in children.items() if df is not None}
    wanted = ids.select("id").distinct()
    grid = wanted.select("id", F.explode(F.array(*[F.lit(n) for n in children])).alias("list"))
    known = F.col("list").isin(*readable) if readable else F.lit(False)
    if not readable:
        return grid.select("id", "list", F.lit(None).cast("bigint").alias("count"),
                           F.lit(None).cast("array<string>").alias("titles"))
    tagged = None
    for name, df in readable.items():
        part = df.select("parent_id", F.col("title").cast("string").alias("title"), F.lit(name).alias("list"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("parent_id", "list").agg(F.count("*").alias("n"))
    sample = titles_sample(tagged, titles)
    return (grid.join(counts.withColumnRenamed("parent_id", "id"), ["id", "list"], "left")
            .join(sample.withColumnRenamed("parent_id", "id"), ["id", "list"], "left")
            .select("id", "list", F.when(known, F.coalesce("n", F.lit(0))).alias("count"), "titles"))


def merge_totals(conflicts: DataFrame, related: DataFrame) -> DataFrame:
    """Fields about to be lost, and children about to move; unknown counts as 0."""
    lost = conflicts.agg(F.count_if(F.col("kind") == "conflict").alias("conflicting_fields"),
                         F.count_if(F.col("kind") == "only_on_loser").alias("only_on_loser"),
                         F.count_if(F.col("kind") == "system").alias("system_fields_differing"))
    moving = related.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).scalar()
    return lost.withColumn("related_records_moving", moving)


# --- rollback ---------------------------------------------------------------

def rollback_join(before_rows: DataFrame, current: DataFrame, fields: Sequence[str],
                  written: Mapping[str, str | None]) -> DataFrame:
    """Prior values of one apply against the records as they are now.

    ``written`` is what the apply set; a record that no longer holds it was
    changed again by someone else.
    """
    state = current.select("id", F.lit(True).alias("_found"),
                           *[flat(current, f).alias(f"_now_{f}") for f in fields])
    touched = F.array_compact(F.array(*[
        F.when(~F.col(f"_now_{f}").eqNullSafe(F.lit(written[f])), F.lit(f)) for f in fields]))
    restore = F.map_filter("before", lambda k, _: k.isin(*fields))
    return (before_rows.select("id", "before").join(state, "id", "left")
            .withColumn("missing", F.col("_found").isNull())
            .select("id", restore.alias("restore_to"), "missing",
                    F.when(~F.col("missing"), touched).otherwise(F.array().cast("array<string>"))
                    .alias("changed_again")))
