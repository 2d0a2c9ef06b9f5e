"""What probably happened to writes that never got an answer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions import details
from changeguard.functions.scalars import intent_of, iso_utc, moved, same, state_map
from changeguard.operators.ledgers import open_unresolved, reconciled_heads, verdict_by_id

COUNTED = ("landed", "not_landed", "unknown")
SETTLING = ("landed", "not_landed")
TARGET = "id:string,before:map<string,variant>,before_modified_time:string,intent:map<string,variant>,role:string"
EMPTY = "cast(map() as map<string,string>)"


def unresolved_targets(pending: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """One row per record an unresolved entry was about to write."""
    d = F.col("d")
    header = ["segment", "seq", "entry_id", "command", "module", "basis", "entry_intent"]
    held = details.parsed(pending).select(
        "segment", "seq", "entry_id", "command", "module", "d",
        details.text_at(d, "$.verdict_basis").alias("basis"),
        details.map_at(d, "$.intent").alias("entry_intent"))
    item = F.transform(details.rows_at(F.col("d"), "targets", TARGET), lambda x: F.struct(
        x["id"].alias("id"), details.flat_map(x["before"]).alias("before"),
        x["before_modified_time"].alias("before_raw"), details.flat_map(x["intent"]).alias("own_intent"),
        x["role"].alias("role")))
    rows = (held.select(*header, F.inline(item)).where(F.coalesce("id", F.lit("")) != "")
            .select(*header, "id", "before", iso_utc("before_raw").alias("before_time"),
                    (F.coalesce("before_raw", F.lit("")) == "").alias("no_baseline"), "own_intent", "role"))
    if records is not None:
        stored = records.where((F.col("source") == "targets") & F.col("verdict").isNull()).select(
            "entry_id", "id", "before", F.col("before_modified_time").alias("before_time"),
            F.col("before_modified_time").isNull().alias("no_baseline"),
            F.col("intent").alias("own_intent"), "role")
        rows = rows.unionByName(held.select(*header).join(stored, "entry_id").select(rows.columns))
    return (rows.withColumn("before", F.coalesce("before", F.expr(EMPTY)))
            .withColumn("intent", intent_of(F.col("entry_intent"), F.col("own_intent")))
            .drop("entry_intent", "own_intent"))


def settled_rows(pending: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """(segment, seq, id) an entry itself recorded as written before it failed."""
    rows = details.named_ids(details.rows_at(F.col("d"), "written_before_failure", "id:string"))
    inline = (details.parsed(pending).select("segment", "seq", F.explode(rows).alias("id")))
    if records is not None:
        stored = records.where(F.col("source") == "settled").select("entry_id", "id")
        inline = inline.unionByName(
            pending.select("segment", "seq", "entry_id").join(stored, "entry_id").drop("entry_id"))
    return inline.distinct()


def settled_targets(targets: DataFrame, settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(still pending, already committed) targets."""
    keys = ["segment", "seq", "id"]
    return targets.join(settled, keys, "left_anti"), targets.join(settled, keys, "left_semi")


def current_state(df: DataFrame, fields: Sequence[str], at: str = "modified_time") -> DataFrame:
    """Current records as (module, id, now_time, state map) for the join."""
    return df.select("module", "id", F.col(at).alias("now_time"), state_map(df, fields).alias("state"))


def reconcile_join(targets: DataFrame, current: DataFrame) -> DataFrame:
    """Targets with the state found now; a missing right side is not readable."""
    found = current.withColumn("present", F.lit(True))
    return (targets.join(found, ["module", "id"], "left")
            .withColumn("present", F.coalesce("present", F.lit(False)))
            .withColumn("state", F.coalesce("state", F.expr(EMPTY))))


def reconcile_verdict(failed_modules: Iterable[str] = ()) -> Column:
    """The decision table; the order of its rows matters.

    Needs columns basis, present, before_time, no_baseline, now_time, state,
    intent and before.  A failed read is never taken for a deleted record.
    """
    shift = moved("before_time", "now_time")
    fields = F.map_keys("intent")
    wanted = same(F.col("state"), F.col("intent"), fields)
    kept = same(F.col("state"), F.col("before"), fields)
    still, went = shift.eqNullSafe(F.lit(False)), shift.eqNullSafe(F.lit(True))
    failed = list(failed_modules)
    unread = F.col("module").isin(*failed) if failed else F.lit(False)
    existence, times = F.col("basis") == "existence", F.col("basis") == "modified_time"
    return (F.when(unread, "unknown")
            .when(F.col("no_baseline"), "unreconcilable")
            .when(existence & ~F.col("present"), "landed")
            .when((existence | times) & F.col("present") & still, "not_landed")
            .when(~(F.col("basis").eqNullSafe(F.lit("value"))), "unknown")
            .when(~F.col("present") | shift.isNull(), "unknown")
            .when(wanted & kept, "unknown")
            .when(wanted & went, "landed")
            .when(kept & still, "not_landed")
            .otherwise("unknown"))


def merge_state(joined: DataFrame, failed_modules: Iterable[str] = ()) -> DataFrame:
    """Per merge attempt: what existence alone can say."""
    failed = list(failed_modules)
    unread = F.col("module").isin(*failed) if failed else F.lit(False)
    loser, master = F.col("role") == "loser", (F.col("role") == "master") & ~unread
    return (joined.where(F.col("command") == "apply_merge").groupBy("segment", "seq").agg(
                F.coalesce(F.bool_or(master & F.col("present")), F.lit(False)).alias("_master"),
                F.count_if(loser).alias("_losers"), F.count_if(loser & F.col("present")).alias("_left"))
            .select("segment", "seq",
                    F.when(~F.col("_master"), "indeterminate")
                    .when((F.col("_losers") > 0) & (F.col("_left") == 0), "losers_absent")
                    .otherwise("masters_present").alias("merge_state")))


def reconcile_totals(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        *[F.count_if(F.col("verdict") == v).alias(v) for v in COUNTED],
        F.count_if(F.col("verdict") == "unreconcilable").alias("unreconcilable"),
        F.count_if(F.col("verdict") == "already_committed").alias("already_committed"))


def entry_resolved(verdicts: DataFrame) -> DataFrame:
    """An attempt is resolved once any of its records got a settling verdict."""
    return verdicts.groupBy("segment", "seq").agg(
        F.bool_or(F.col("verdict").isin(*SETTLING)).alias("resolved"),
        F.count_if(~F.col("verdict").isin(*SETTLING, "already_committed")).alias("still_open"))


def reconcile(ledger: DataFrame, current: DataFrame, records: DataFrame | None = None, seq: int | None = None,
              segment: int | None = None, failed_modules: Iterable[str] = (),
              close_per: str = "record") -> tuple[DataFrame, DataFrame]:
    """(one-row summary, one row per record in doubt).

    ``close_per="record"`` drops only records an earlier reconciliation
    settled, so the rest of an entry is looked at again; ``"entry"`` closes the
    whole entry with its first settled record.
    """
    if close_per == "entry":
        pending = open_unresolved(ledger, seq, segment)
    else:
        pending = ledger.where(F.col("outcome") == "unresolved")
        pending = pending.where(F.col("seq") == seq) if seq is not None else pending
        pending = pending.where(F.col("segment") == segment) if segment is not None else pending
    targets = unresolved_targets(pending, records)
    if close_per == "record":
        judged = (verdict_by_id(ledger, records).where(F.col("verdict").isin(*SETTLING))
                  .select(F.col("resolves_segment").alias("segment"), F.col("resolves_seq").alias("seq"), "id"))
        targets = targets.join(judged, ["segment", "seq", "id"], "left_anti")
    open_targets, committed = settled_targets(targets, settled_rows(pending, records))
    joined = reconcile_join(open_targets, current)
    raw = joined.withColumn("verdict", reconcile_verdict(failed_modules))
    # a merge can only be checked for existence, which is consistent with a
    # completed merge and proves none
    softened = F.when((F.col("command") == "apply_merge") & F.col("verdict").isin(*COUNTED), F.lit("unknown")
                      ).otherwise(F.col("verdict"))
    cols = ["segment", "seq", "entry_id", "command", "module", "id", "role", "basis"]
    judged = (raw.withColumn("verdict", softened).join(merge_state(joined, failed_modules), ["segment", "seq"], "left")
              .select(*cols, "before_time", "now_time", "verdict", "merge_state"))
    done = committed.select(*cols, "before_time", F.lit(None).cast("timestamp").alias("now_time"),
                            F.lit("already_committed").alias("verdict"),
                            F.lit(None).cast("string").alias("merge_state"))
    verdicts = judged.unionByName(done)
    return reconcile_totals(verdicts), verdicts
