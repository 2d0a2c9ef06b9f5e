"""Merge: losers disappear into masters, so what they held is archived first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.errors import DriftRefused, UnresolvedWrite
from changeguard.functions.scalars import canonical
from changeguard.operators.matching import check_merge_pairs, merge_conflicts, merge_totals, related_counts
from changeguard.operators.mutations import merge_rows
from changeguard.plans.common import (GUARD, ApplyResult, commit_or_log, guarded, hold_to_plan, log_entry, refuse,
                                      require_plan,                                      snapshot_rows)
from changeguard.sources.ledger_store import LedgerStore, records_of
from changeguard.sources.plan_store import Plan, plan_key
from changeguard.sources.snapshots import SnapshotTable


def involved(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every record of the pairs with its role."""
    roles = (pairs.select(F.col("master_id").alias("id"), F.lit("master").alias("role")).distinct()
             .unionByName(pairs.select(F.col("loser_id").alias("id"), F.lit("loser").alias("role"))))
    return records.join(roles, "id")


def _pairs_digest(pairs: DataFrame) -> str:
    keyed = pairs.select(F.concat_ws(">", "master_id", "loser_id").alias("id"))
    return guarded(keyed, "pairs", [], "the pairs")[1]


def _usable(pairs: DataFrame, max_losers: int | None) -> DataFrame:
    """The pairs; any that cannot be merged refuses all of them."""
    checked = check_merge_pairs(pairs, max_losers)
    bad = checked.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n")).collect()
    if bad:
        raise ValueError("pairs cannot be merged: " + ", ".join(f"{r.n} {r.reason}" for r in bad))
    return checked.select("master_id", "loser_id")


def merge_key(module: str, pairs: DataFrame) -> str:
    """Keyed on who is merged into whom, so that swapped roles are another plan."""
    return plan_key("merge", module, _pairs_digest(pairs), {})


def plan_merge(records: DataFrame, module: str, children: Mapping[str, DataFrame | None], pairs: DataFrame,
               context: Sequence[str] = (GUARD,), max_losers: int | None = 3) -> Plan:
    """What a set of merges would destroy and move.  Any unusable pair refuses
    the whole plan: it cannot be undone."""
    usable = _usable(pairs, max_losers)
    touched = involved(records, usable)
    count, digest = guarded(touched, module, sorted(context), "the plan")
    wanted = usable.select("master_id").distinct().count() + usable.count()
    if count != wanted:
        raise ValueError(f"{wanted - count} records of the pairs do not exist")
    conflicts = merge_conflicts(usable, records)
    related = related_counts(usable.select(F.col("loser_id").alias("id")), children)
    totals = merge_totals(conflicts, related).head().asDict()
    key = merge_key(module, usable)
    return Plan("merge", module, key, digest, count, totals, snapshot_rows(touched, []),
                {"conflicts": conflicts, "related": related})


def _move(child: SnapshotTable, changed: DataFrame, version: int, remap: DataFrame) -> None:
    """Commit the moved children on the version they were read from; if that
    was overtaken, take the newest state once more."""
    try:
        child.commit(child.stage(changed), version)
    except DriftRefused:
        on = child.version()
        newest = child.read(on)
        again = (newest.join(remap, "parent_id").withColumn("parent_id", F.col("master_id"))
                 .select(*newest.columns))
        child.commit(child.stage(again), on)


def apply_merge(plan: Plan | None, table: SnapshotTable, children: Mapping[str, SnapshotTable], pairs: DataFrame,
                ledger: LedgerStore, now: str, context: Sequence[str] = (GUARD,),
                fill_from_loser: bool = True) -> ApplyResult:
    """Archive, merge, move the children.  The archive entry is written before
    anything changes: if it cannot be written, nothing is merged."""
    plan = require_plan(plan)
    usable = _usable(pairs, None)
    plan = hold_to_plan(plan, merge_key(plan.module, usable), "apply_merge", ledger, now)
    version = table.version()
    records = table.read(version)
    touched = involved(records, usable)
    count, digest = guarded(touched, plan.module, sorted(context), "the apply")
    if digest != plan.fingerprint:
        refuse(ledger, "apply_merge", plan, now, digest, snapshot_rows(touched, []), list(context), count)
    losers = touched.where(F.col("role") == "loser")
    lost = losers.count()
    archive = records_of(losers, "", "archive", role=F.lit("loser"), archive=canonical(losers, records.columns))
    masters = records_of(touched.where(F.col("role") == "master"), "", "master_id", role=F.lit("master"))
    _, archive_id = log_entry(ledger, "applied", "apply_merge", plan, now,
                              {"fingerprint": digest, "irreversible": True, "losers": lost}, [archive, masters])
    versions = {name: t.version() for name, t in children.items()}
    links = {name: t.read(versions[name]) for name, t in children.items()}
    empty = records.sparkSession.createDataFrame([], "parent_id string")
    rest, _, _ = merge_rows(records, empty, usable, fill_from_loser)
    survivors = (rest.join(usable.select(F.col("master_id").alias("id")).distinct(), "id", "left_semi")
                 .withColumn(GUARD, F.lit(now).cast("timestamp")).select(*records.columns))
    made = commit_or_log(table, version, survivors, usable.select(F.col("loser_id").alias("id")), ledger,
                         "apply_merge", plan, now, touched, [GUARD], "existence",
                         progress={"archive_entry": archive_id})
    moved = {}
    for name, child in children.items():
        remap = usable.select(F.col("loser_id").alias("parent_id"), "master_id")
        changed = (links[name].join(remap, "parent_id").withColumn("parent_id", F.col("master_id"))
                   .select(*links[name].columns))
        moved[name] = changed.count()
        if moved[name]:
            try:
                _move(child, changed, versions[name], remap)
            except (DriftRefused, UnresolvedWrite) as error:
                # the losers are gone already, so this must not stay unsaid
                log_entry(ledger, "unresolved", "apply_merge", plan, now,
                          {"reason": str(error), "archive_entry": archive_id, "children": name,
                           "related_moved": moved, "attempted_at": now})
                raise
    commit, entry_id = log_entry(ledger, "applied", "apply_merge", plan, now,
                                 {"records": lost, "closes": archive_id, "related_moved": moved})
    return ApplyResult("apply_merge", {"merged": lost, "related_moved": moved, "archive_entry": archive_id,
                                       "entry_id": entry_id}, commit, made)
