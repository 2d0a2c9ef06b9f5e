"""New states of tables: create, update, upsert, delete, merge, convert, notes.

Every operator returns DataFrames that the caller writes.  What several of them
read is written to the shared folder on the way (``upsert_rows``, new ids).
``results`` tables have (id, code, message, field), one row per asked change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import clip, is_blank, iso_utc
from changeguard.operators.matching import upsert_match
from changeguard.operators.ranking import dense_index, top_per_group
from changeguard.session import written

OK = "SUCCESS"
BIN_DAYS = 60
UNMATCHED = "NOT_IN_MATCH"
DEAL_FIELDS = ("Deal_Name", "Closing_Date", "Stage")


def _aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns of ``like``, by name and type; what is absent is null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in like.schema])


def _verdict(rows: DataFrame, meta: DataFrame, module: str) -> tuple[Column, Column, Column]:
    """(code, message, field) of the first rule a new row breaks.

    Field metadata may have several rows per field: it is required if one row
    says so, and read-only if one says so; two different pick lists are refused.
    What is collected is one row per column of the table.
    """
    either = lambda name: F.coalesce(F.bool_or(name), F.lit(False)).alias(name)
    lists = F.collect_set(F.when(F.size("pick_list_values") > 0, F.array_sort("pick_list_values")))
    rules = (meta.where((F.col("module") == module) & F.col("field").isin(*rows.columns)).groupBy("field")
             .agg(either("system_mandatory"), either("required"), either("read_only"), F.size(lists).alias("lists"),
                  F.try_element_at(lists, F.lit(1)).alias("pick_list_values"))
             .orderBy("field").collect())
    torn = [rule.field for rule in rules if rule.lists > 1]
    if torn:
        raise ValueError(f"fields with more than one pick list: {torn}")
    code = message = field = None
    for rule in rules:
        tests = []
        if (rule.system_mandatory or rule.required) and not rule.read_only:
            tests.append((is_blank(rows, rule.field), "MANDATORY_NOT_FOUND", "required field is empty"))
        if rule.pick_list_values:
            listed = F.col(rule.field).isin(*rule.pick_list_values)
            tests.append((~is_blank(rows, rule.field) & ~listed, "INVALID_DATA", "not an allowed value"))
        for test, c, m in tests:
            code = F.when(test, c) if code is None else code.when(test, c)
            message = F.when(test, m) if message is None else message.when(test, m)
            field = F.when(test, rule.field) if field is None else field.when(test, rule.field)
    none = F.lit(None).cast("string")
    return (code if code is not None else none, message if message is not None else none,
            field if field is not None else none)


def create_rows(target: DataFrame, rows: DataFrame, meta: DataFrame, module: str,
                key: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(target with the new rows, results).  Ids follow the largest in use.

    ``key`` is unique per input row and fixes the numbering, so a task that is
    run again gives the same ids.
    """
    code, message, field = _verdict(rows, meta, module)
    judged = rows.withColumn("_code", F.coalesce(code, F.lit(OK))).withColumn(
        "_message", message).withColumn("_field", field)
    highest = target.agg(F.coalesce(F.max(F.col("id").try_cast("decimal(38,0)")), F.lit(0))
                         .cast("decimal(38,0)").alias("m")).scalar()
    good = dense_index(judged.where(F.col("_code") == OK), [key], "_i")
    new_id = (highest + F.col("_i") + F.lit(1)).cast("decimal(38,0)").cast("string")
    made = good.withColumn("id", new_id)
    results = (made.select(key, "id", F.lit(OK).alias("code"), F.lit(None).cast("string").alias("message"),
                           F.lit(None).cast("string").alias("field"))
               .unionByName(judged.where(F.col("_code") != OK).select(
                   key, F.lit(None).cast("string").alias("id"), F.col("_code").alias("code"),
                   F.col("_message").alias("message"), F.col("_field").alias("field"))))
    return target.unionByName(_aligned(made, target)), results


def update_rows(target: DataFrame, updates: DataFrame, set_fields: Sequence[str],
                present: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(new target, results).

    A given null overwrites.  ``present`` names an ARRAY<STRING> column listing
    which of ``set_fields`` a row really gives; without it every one is given.
    Rows without an id, for an unknown id, or for an id asked twice are
    rejected: two answers for one record have no order.
    """
    listed = [present] if present else []
    usable = updates.where(F.coalesce("id", F.lit("")) != "")
    grouped = usable.groupBy("id").agg(
        F.count("*").alias("_asked"),
        F.any_value(F.struct(*[F.col(f) for f in [*set_fields, *listed]])).alias("_new"))
    hit = F.col("_asked") == 1
    cells = {}
    for f in set_fields:
        given = hit & F.array_contains(F.col(f"_new.{present}"), f) if present else hit
        kind = target.schema[f].dataType
        cells[f] = F.when(given, F.col(f"_new.{f}").cast(kind)).otherwise(F.col(f))
    new = target.join(grouped, "id", "left").withColumns(cells).select(*target.columns)
    known = target.select("id").withColumn("_known", F.lit(True))
    code = (F.when(F.col("_asked") > 1, "DUPLICATE_DATA").when(F.col("_known").isNull(), "INVALID_DATA")
            .otherwise(OK))
    message = (F.when(F.col("_asked") > 1, "id asked more than once")
               .when(F.col("_known").isNull(), "no such record"))
    results = (grouped.select("id", "_asked").join(known, "id", "left")
               .select("id", code.alias("code"), message.alias("message"),
                       F.col("_asked").alias("rows")))
    no_id = (updates.where(F.coalesce("id", F.lit("")) == "").agg(F.count("*").alias("rows")).where("rows > 0")
             .select(F.lit(None).cast("string").alias("id"), F.lit("MANDATORY_NOT_FOUND").alias("code"),
                     F.lit("row has no id").alias("message"), "rows"))
    return new, results.unionByName(no_id)


def upsert_rows(target: DataFrame, incoming: DataFrame, check_fields: Sequence[str], set_fields: Sequence[str],
                match: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new target, results): update what the check fields find, create the rest.

    Several input rows for one existing record, or with the same new key, are
    one write: the smallest row_id gives the values and the others are reported
    as duplicates, so running the same set again changes nothing.  A row that
    ``match`` does not hold is reported and not written.

    The match and what is chosen from it are written once; the new rows and all
    parts of the results are read from there.
    """
    match = match if match is not None else written(upsert_match(incoming, target, check_fields), "match")
    joined = incoming.join(match.select("row_id", "action", F.col("id").alias("_hit")), "row_id", "left")
    strays, joined = joined.where(F.col("action").isNull()), joined.where(F.col("action").isNotNull())
    key = F.to_json(F.struct(*[F.col(f).cast("string").alias(f) for f in check_fields]), {"ignoreNullFields": "false"})
    writes = joined.withColumn("_write", F.coalesce(F.concat(F.lit("id:"), F.col("_hit")),
                                                    F.concat(F.lit("new:"), key)))
    first = writes.groupBy("_write").agg(F.min("row_id").alias("_first"), F.count("*").alias("_n"))
    wins = F.col("row_id") == F.col("_first")
    # only values that will be written take the type of their column
    cells = [F.when(wins, F.col(f).cast(target.schema[f].dataType)).alias(f) for f in set_fields]
    chosen = written(writes.join(first, "_write").select("row_id", "action", "_hit", wins.alias("_wins"), *cells)
                     .unionByName(strays.select("row_id", "action", "_hit"), allowMissingColumns=True), "chosen")
    strays, chosen = chosen.where(F.col("action").isNull()), chosen.where(F.col("action").isNotNull())
    updates = chosen.where(F.col("_wins") & (F.col("action") == "update")).select(
        F.col("_hit").alias("id"), *set_fields)
    new, _ = update_rows(target, updates, set_fields)
    highest = target.agg(F.coalesce(F.max(F.col("id").try_cast("decimal(38,0)")), F.lit(0))
                         .cast("decimal(38,0)").alias("m")).scalar()
    fresh = dense_index(chosen.where(F.col("_wins") & (F.col("action") == "create"))
                        .select("row_id", *set_fields), ["row_id"], "_i")
    fresh = fresh.withColumn("id", (highest + F.col("_i") + F.lit(1)).cast("decimal(38,0)").cast("string"))
    results = (chosen.where("_wins").where(F.col("action") == "update")
               .select("row_id", F.col("_hit").alias("id"), "action", F.lit(OK).alias("code"))
               .unionByName(fresh.select("row_id", "id", F.lit("create").alias("action"), F.lit(OK).alias("code")))
               .unionByName(chosen.where(~F.col("_wins")).select(
                   "row_id", F.col("_hit").alias("id"), "action", F.lit("DUPLICATE_DATA").alias("code")))
               .unionByName(strays.select("row_id", F.col("_hit").alias("id"), "action", F.lit(UNMATCHED).alias("code"))))
    return new.unionByName(_aligned(fresh, target)), results


def delete_rows(target: DataFrame, ids: DataFrame, now: str, keep_days: int = BIN_DAYS) -> tuple[DataFrame, DataFrame]:
    """(what stays, what goes to the bin with the day it expires)."""
    gone = ids.select("id")
    at = F.lit(now).cast("timestamp")
    binned = (target.join(gone, "id", "left_semi").withColumn("deleted_at", at)
              .withColumn("expires_at", at + F.make_dt_interval(days=F.lit(keep_days))))
    return target.join(gone, "id", "left_anti"), binned


def restore_rows(target: DataFrame, binned: DataFrame, ids: DataFrame, now: str) -> DataFrame:
    """Bring unexpired records back from the bin."""
    alive = binned.where(F.col("expires_at") > F.lit(now).cast("timestamp"))
    newest = top_per_group(alive.join(ids.select("id"), "id", "left_semi"), ["id"], [F.col("deleted_at").desc()], 1)
    absent = newest.join(target.select("id"), "id", "left_anti")
    return target.unionByName(_aligned(absent, target))


def merge_rows(records: DataFrame, children: DataFrame, pairs: DataFrame,
               fill_from_loser: bool = True, keep: Sequence[str] = ("id", "modified_time")
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, children, archive) after merging valid (master, loser) pairs.

    The master's values win; where it has none, the value of the smallest loser
    id that has one is taken.  Children move to the master, and the losers'
    full rows go to the archive.
    """
    links = pairs.select("master_id", "loser_id")
    losers = records.join(links.withColumnRenamed("loser_id", "id"), "id")
    archive = losers.select("master_id", *records.columns)
    rest = records.join(links.select(F.col("loser_id").alias("id")), "id", "left_anti")
    if fill_from_loser:
        fields = [c for c in records.columns if c not in keep]
        fills = losers.groupBy("master_id").agg(*[
            F.min_by(F.col(f), F.when(~is_blank(records, f), F.col("id"))).alias(f"_fill_{f}") for f in fields])
        merged = rest.join(fills.withColumnRenamed("master_id", "id"), "id", "left")
        rest = merged.withColumns({f: F.when(is_blank(records, f), F.coalesce(F.col(f"_fill_{f}"), F.col(f)))
                                  .otherwise(F.col(f)) for f in fields}).select(*records.columns)
    moved = (children.join(links.withColumnRenamed("loser_id", "parent_id"), "parent_id", "left")
             .withColumn("parent_id", F.coalesce("master_id", "parent_id")).select(*children.columns))
    return rest, moved, archive


def convert_leads(leads: DataFrame, requests: DataFrame, mapping: Mapping[str, Mapping[str, str]]
                  ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(contacts, accounts, deals, results) for asked leads.

    ``mapping`` gives, per new table, new column -> lead column.  A request may
    carry a ``deal`` struct, which then needs name, closing date and stage.
    New ids are the lead's id under a prefix, so a repeat makes the same rows.
    """
    asked = requests.select(F.col("lead_id").alias("id"), "assign_to", "deal", F.lit(True).alias("_asked"))
    taken = leads.join(asked, "id")
    deal_gaps = F.array_compact(F.array(*[
        F.when(F.coalesce(F.col(f"deal.{f}").cast("string"), F.lit("")) == "", F.lit(f)) for f in DEAL_FIELDS]))
    with_deal = F.col("deal").isNotNull()
    already = F.coalesce("converted", F.lit(False)) if "converted" in leads.columns else F.lit(False)
    judged = taken.withColumn("_gaps", F.when(with_deal, deal_gaps).otherwise(F.array().cast("array<string>")))
    good = judged.where((F.size("_gaps") == 0) & ~already)

    def built(name: str) -> DataFrame:
        owner = F.coalesce("assign_to", "owner_id") if "owner_id" in leads.columns else F.col("assign_to")
        return good.select(F.concat(F.lit(f"{name}-"), F.col("id")).alias("id"), F.col("id").alias("lead_id"),
                           owner.alias("owner_id"),
                           *[F.col(source).alias(new) for new, source in mapping[name].items()])

    deals = good.where(with_deal).select(
        F.concat(F.lit("deal-"), F.col("id")).alias("id"), F.col("id").alias("lead_id"),
        F.concat(F.lit("account-"), F.col("id")).alias("account_id"),
        *[F.col(f"deal.{f}").alias(f) for f in DEAL_FIELDS])
    missing = asked.join(leads.select("id"), "id", "left_anti").select(
        F.col("id").alias("lead_id"), F.lit("INVALID_DATA").alias("code"), F.lit("no such lead").alias("message"))
    code = (F.when(already, "DUPLICATE_DATA").when(F.size("_gaps") > 0, "MANDATORY_NOT_FOUND").otherwise(OK))
    message = (F.when(already, "already converted")
               .when(F.size("_gaps") > 0, F.concat(F.lit("deal needs "), F.array_join("_gaps", ", "))))
    results = judged.select(F.col("id").alias("lead_id"), code.alias("code"), message.alias("message"))
    return built("contact"), built("account"), deals, results.unionByName(missing)


def add_notes(notes: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append notes with a body, cut to the longest body the store takes."""
    body = F.regexp_replace("content", r"^\s+|\s+$", "")
    fresh = incoming.withColumn("content", body).where(F.coalesce("content", F.lit("")) != "")
    return notes.unionByName(_aligned(fresh.withColumn("content", clip("content")), notes))


# --- results of a write -----------------------------------------------------

def first_errors(results: DataFrame, n: int = 20, order: Sequence[str] = ("batch", "row_id")) -> DataFrame:
    """The first ``n`` failed rows in a stated order."""
    return results.where(~F.col("code").eqNullSafe(F.lit(OK))).orderBy(*order).limit(n)


def write_summary(results: DataFrame) -> DataFrame:
    """One row: succeeded, failed, how many can be matched later, all failed.

    A status of the whole call says nothing: rows are counted one by one.
    """
    ok = F.col("code").eqNullSafe(F.lit(OK))
    timed = ok & F.col("id").isNotNull() & F.col("modified_time").isNotNull()
    return results.agg(
        F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
        F.count_if(timed).alias("written"),
        (F.count_if(~ok) > 0).alias("_bad")).select(
            "succeeded", "failed", "written", (F.col("_bad") & (F.col("succeeded") == 0)).alias("refused"))


def written_of(results: DataFrame) -> DataFrame:
    """Rows a later scan can match: id and the instant the write reported."""
    return (results.where(F.col("code") == OK).select("id", iso_utc("modified_time").alias("written_time"))
            .where(F.col("id").isNotNull() & F.col("written_time").isNotNull()))
