"""Reading the ledger: filters, counts, and the join from entries to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions import details
from changeguard.functions.scalars import iso_text

OUTCOMES = ("applied", "refused", "unresolved", "reconciled")
KINDS = {"applied": "governed_change", "refused": "refusal", "unresolved": "unresolved_write"}


def ledger_filter(ledger: DataFrame, since: str | None = None, until: str | None = None,
                  module: str | None = None, outcome: str | None = None) -> DataFrame:
    """Entries in a window.  A bare date means its midnight."""
    if outcome is not None and outcome not in OUTCOMES:
        raise ValueError(f"unknown outcome {outcome!r}")
    kept = ledger
    if since:
        kept = kept.where(F.col("at") >= F.lit(since).cast("timestamp"))
    if until:
        kept = kept.where(F.col("at") <= F.lit(until).cast("timestamp"))
    if module:
        kept = kept.where(F.col("module") == module)
    return kept.where(F.col("outcome") == outcome) if outcome else kept


def _count_of(outcome: str) -> Column:
    return F.count_if(F.col("outcome") == outcome).alias(outcome)


def outcome_counts(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count("*").alias("entries"), *[_count_of(o) for o in OUTCOMES])


def _records_changed(d: Column) -> Column:
    # applied entries only: an unresolved one has targets but no known outcome
    counted = F.when(F.col("outcome") == "applied", F.coalesce(details.long_at(d, "$.records"), F.lit(0)))
    return F.coalesce(F.sum(counted), F.lit(0))


def records_changed(ledger: DataFrame) -> DataFrame:
    return details.parsed(ledger).agg(_records_changed(F.col("d")).alias("records_changed"))


def audit_counts(ledger: DataFrame) -> DataFrame:
    """The four outcome counts and the records changed, in one pass."""
    return details.parsed(ledger).agg(
        F.count("*").alias("entries"), *[_count_of(o) for o in OUTCOMES],
        _records_changed(F.col("d")).alias("records_changed"))


def _with_written(ledger: DataFrame, records: DataFrame | None) -> DataFrame:
    """Applied entries with how many rows they say were written."""
    applied = details.parsed(ledger.where(F.col("outcome") == "applied"))
    inline = applied.withColumn("_n", F.size(details.list_at(F.col("d"), "written")))
    if records is None:
        return inline
    stored = (records.where(F.col("written_time").isNotNull())
              .groupBy("entry_id").agg(F.count("*").alias("_stored")))
    return inline.join(stored, "entry_id", "left").withColumn("_n", F.col("_n") + F.coalesce("_stored", F.lit(0)))


def covers_from(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.min("at").alias("covers_from"))


def unmatchable_count(ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Applied entries that no current state can ever be matched to."""
    return _with_written(ledger, records).agg(F.count_if(F.col("_n") == 0).alias("unmatchable"))


def unattributed_refusals(ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Refusals that name no record."""
    refused = details.parsed(ledger.where(F.col("outcome") == "refused"))
    inline = refused.withColumn("_n", F.size(details.observed_ids(F.col("d"))))
    if records is not None:
        named = records.groupBy("entry_id").agg(F.count("*").alias("_stored"))
        inline = inline.join(named, "entry_id", "left").withColumn(
            "_n", F.col("_n") + F.coalesce("_stored", F.lit(0)))
    return inline.agg(F.count_if(F.col("_n") == 0).alias("unattributed_refusals"))


def governed_writes(ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row per (module, id, instant) a governed write reported."""
    applied = details.parsed(ledger.where(F.col("outcome") == "applied"))
    rows = (applied.select("module", F.inline(details.written_rows(F.col("d"))))
            .select("module", "id", F.col("modified_time").alias("modified_at")))
    if records is not None:
        headers = ledger.where(F.col("outcome") == "applied").select("entry_id", "module")
        stored = (records.where(F.col("written_time").isNotNull()).drop("module").join(headers, "entry_id")
                  .select("module", "id", F.date_trunc("second", "written_time").alias("modified_at")))
        rows = rows.unionByName(stored)
    return rows.where(F.col("modified_at").isNotNull())


def governed_keys(ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Distinct (module, id, instant) keys; an exact match, no tolerance window."""
    return governed_writes(ledger, records).distinct()


def ledger_by_record(ledger: DataFrame, records: DataFrame | None = None, ids: DataFrame | None = None,
                     every_write: bool = False) -> DataFrame:
    """One row per (entry, record id it names).  Reconciled entries name none.

    Ids inside ``detail`` are made distinct within their own row, so nothing is
    shuffled here and no list per record is ever built.  With ``ids`` only rows
    of those (module, id) are kept, before anything is grouped; of entries whose
    rows are in ``records`` only those that have one are parsed.
    With ``every_write`` an id that an entry has written twice has a row for
    each time, and ``newest`` tells the one that counts as the entry's.
    """
    others_than_verdicts = ledger.where(F.col("outcome") != "reconciled")
    named = details.parsed(others_than_verdicts)
    d = F.col("d")
    header = ["segment", "seq", "entry_id", "outcome", "command", "module", "plan_key", "at"]
    told = [details.names_at(d, "fields").alias("fields"), details.text_at(d, "$.reason").alias("reason")]
    others = F.concat(*[details.ids_from(d, source) for source in details.ID_SOURCES if source != "written"])
    held = named.select(*header, *told, details.written_rows(d).alias("_written"), others.alias("_others"))
    written = F.transform("_written", lambda x: x["id"])
    # an id written twice in one entry keeps its latest time; the sort that
    # takes is only done for entries that have one
    ordered = F.array_sort("_written")
    marked = F.transform(ordered, lambda x, i: F.struct(
        x["id"].alias("id"), x["modified_time"].alias("modified_time"),
        F.coalesce(F.get(ordered, i + 1)["id"] != x["id"], F.lit(True)).alias("newest")))
    one = F.transform("_written", lambda x: F.struct(
        x["id"].alias("id"), x["modified_time"].alias("modified_time"), F.lit(True).alias("newest")))
    again = marked if every_write else F.filter(marked, lambda x: x["newest"])
    timed = F.when(F.size(F.array_distinct(written)) == F.size("_written"), one).otherwise(again)
    rest = F.transform(F.array_except("_others", written), lambda x: F.struct(
        x.alias("id"), F.lit(None).cast("timestamp").alias("modified_time"), F.lit(True).alias("newest")))
    rows = held.select(*header, "fields", "reason", F.inline(F.concat(timed, rest))).withColumnRenamed(
        "modified_time", "written_time")
    if ids is not None:
        rows = rows.join(ids.select("module", "id").distinct(), ["module", "id"], "left_semi")
    if records is not None:
        stored = records.select("entry_id", "id", "written_time")
        if ids is None:
            stored = stored.join(held.drop("_written", "_others"), "entry_id")
        else:
            stored = stored.join(ids.select("id").distinct(), "id", "left_semi")
            stored = stored.join(others_than_verdicts.select(*header, "detail"), "entry_id").join(
                ids.select("module", "id").distinct(), ["module", "id"], "left_semi")
            stored = details.parsed(stored).select(*header, *told, "id", "written_time")
        rows = rows.unionByName(stored.withColumn("newest", F.lit(True)))
    return rows if every_write else rows.drop("newest")


def last_written(ledger_long: DataFrame) -> DataFrame:
    """Newest governed write time per record."""
    return (ledger_long.where((F.col("outcome") == "applied") & F.col("written_time").isNotNull())
            .groupBy("module", "id").agg(F.max("written_time").alias("last_written")))


def last_applied(ledger: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Newest applied entry per plan key."""
    applied = ledger.where(F.col("outcome") == "applied")
    if keys is not None:
        applied = applied.join(keys.select("plan_key"), "plan_key", "left_semi")
    newest = F.max_by(F.struct("segment", "seq", "entry_id", "command", "module", "at", "detail"),
                      F.struct("segment", "seq"))
    return applied.groupBy("plan_key").agg(newest.alias("e")).select("plan_key", "e.*")


# --- reconciled entries -----------------------------------------------------

def reconciled_heads(ledger: DataFrame) -> DataFrame:
    """Reconciled entries with what they point at.  An entry that names no
    segment points into its own."""
    d = F.col("d")
    return (details.parsed(ledger.where(F.col("outcome") == "reconciled"))
            .select("segment", "seq", "entry_id", "at", "d",
                    F.coalesce(details.long_at(d, "$.resolves_segment"), F.col("segment"))
                    .alias("resolves_segment"),
                    details.long_at(d, "$.resolves_seq").alias("resolves_seq"),
                    details.flag_at(d, "$.resolved").alias("resolved"),
                    details.text_at(d, "$.merge_state").alias("merge_state"))
            .where(F.col("resolves_seq").isNotNull()))


def verdict_by_id(ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Per reconciled entry: the verdict on each record id."""
    heads = reconciled_heads(ledger)
    item = F.filter(details.rows_at(F.col("d"), "verdicts", "id:string,verdict:string"), lambda x: x.isNotNull())
    keep = ["segment", "seq", "resolves_segment", "resolves_seq"]
    rows = heads.select(*keep, F.inline(item)).where(F.col("id").isNotNull())
    if records is not None:
        stored = records.where(F.col("verdict").isNotNull()).select("entry_id", "id", "verdict")
        rows = rows.unionByName(heads.select(*keep, "entry_id").join(stored, "entry_id").drop("entry_id"))
    return rows


def attach_reconciled(ledger_long: DataFrame, ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Unresolved rows with the newest verdict recorded about each.

    The newest reconciled entry that names a record decides about it: later
    runs judge only what was still open and do not undo earlier verdicts.
    ``merge_state``, and the entry shown for records no entry names, are those
    of the attempt's newest reconciled entry.
    """
    heads = (reconciled_heads(ledger).groupBy("resolves_segment", "resolves_seq")
             .agg(F.max_by(F.struct("segment", "seq", "merge_state"), F.struct("segment", "seq")).alias("r"))
             .select(F.col("resolves_segment").alias("segment"), F.col("resolves_seq").alias("seq"),
                     F.col("r.segment").alias("head_segment"), F.col("r.seq").alias("head_seq"),
                     F.col("r.merge_state").alias("merge_state")))
    newest = (verdict_by_id(ledger, records).groupBy("resolves_segment", "resolves_seq", "id")
              .agg(F.max(F.struct("segment", "seq", "verdict")).alias("v"))
              .select(F.col("resolves_segment").alias("segment"), F.col("resolves_seq").alias("seq"), "id",
                      F.col("v.segment").alias("named_segment"), F.col("v.seq").alias("named_seq"),
                      F.col("v.verdict").alias("verdict")))
    open_rows = ledger_long.where(F.col("outcome") == "unresolved")
    return (open_rows.join(heads, ["segment", "seq"], "left").join(newest, ["segment", "seq", "id"], "left")
            .withColumns({"verdict_segment": F.coalesce("named_segment", "head_segment"),
                          "verdict_seq": F.coalesce("named_seq", "head_seq")})
            .drop("named_segment", "named_seq", "head_segment", "head_seq"))


def open_unresolved(ledger: DataFrame, seq: int | None = None, segment: int | None = None) -> DataFrame:
    """Unresolved entries no reconciled entry has settled yet."""
    closed = (reconciled_heads(ledger).where("resolved")
              .select(F.col("resolves_segment").alias("segment"), F.col("resolves_seq").alias("seq")))
    pending = ledger.where(F.col("outcome") == "unresolved")
    if segment is not None:
        pending = pending.where(F.col("segment") == segment)
    if seq is not None:
        pending = pending.where(F.col("seq") == seq)
    return pending.join(closed, ["segment", "seq"], "left_anti")


# --- timeline ---------------------------------------------------------------

def union_events(ledger_long: DataFrame, ledger: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Governed changes, refusals and unresolved writes as one event list; a
    verdict sits on the attempt it judged and is not an event of its own."""
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    cols = ["module", "id", "at", "segment", "seq", "command", "plan_key", "fields", "reason", "written_time"]
    plain = (ledger_long.where(F.col("outcome").isin("applied", "refused"))
             .select(*cols, F.element_at(kind, F.col("outcome")).alias("kind"),
                     F.lit(None).cast("string").alias("verdict"),
                     F.lit(None).cast("bigint").alias("verdict_seq"),
                     F.lit(None).cast("string").alias("merge_state")))
    judged = attach_reconciled(ledger_long, ledger, records).select(
        *cols, F.lit(KINDS["unresolved"]).alias("kind"), "verdict",
        F.col("verdict_seq").cast("bigint").alias("verdict_seq"), "merge_state")
    return plain.unionByName(judged)


def timeline(events: DataFrame) -> DataFrame:
    """Events in record and time order.  Kept long: the sort is by range on the
    whole key, so a record with very many events is spread over tasks."""
    return events.orderBy("module", "id", "at", "segment", "seq")
