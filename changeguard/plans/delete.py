"""Bulk delete: the one write where a stale review matters most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.operators.mutations import delete_rows
from changeguard.operators.scans import require_at_most
from changeguard.plans.common import (GUARD, ApplyResult, commit_or_log, guarded, hold_to_plan, log_entry, refuse,
                                      require_plan,                                      snapshot_rows, written_records)
from changeguard.sources.ledger_store import LedgerStore
from changeguard.sources.plan_store import Plan, plan_key
from changeguard.sources.snapshots import SnapshotTable


def delete_key(module: str, predicate: str) -> str:
    return plan_key("delete", module, predicate, {})


def plan_delete(target: DataFrame, module: str, predicate: str, max_records: int | None = None) -> Plan:
    rows = require_at_most(target.where(predicate), max_records, "the plan")
    count, digest = guarded(rows, module, [GUARD], "the plan")
    return Plan("delete", module, delete_key(module, predicate), digest, count, {"count": count},
                snapshot_rows(rows, []))


def apply_delete(plan: Plan | None, table: SnapshotTable, ledger: LedgerStore, predicate: str, now: str,
                 bin_path: str | None = None) -> ApplyResult:
    """Delete what was reviewed.  A delete reports no write time, so its entry
    can never be matched to a state; it still names every record."""
    plan = require_plan(plan)
    plan = hold_to_plan(plan, delete_key(plan.module, predicate), "apply_delete", ledger, now)
    version = table.version()
    rows = table.read(version).where(predicate)
    count, digest = guarded(rows, plan.module, [GUARD], "the apply")
    if digest != plan.fingerprint:
        refuse(ledger, "apply_delete", plan, now, digest, snapshot_rows(rows, []), [GUARD], count)
    if bin_path is not None:
        # kept before anything goes away; a delete that then fails leaves a copy, not a loss
        delete_rows(rows, rows, now)[1].write.mode("append").parquet(bin_path)
    made = commit_or_log(table, version, None, rows.select("id"), ledger, "apply_delete", plan, now, rows, [GUARD],
                         "existence")
    commit, entry_id = log_entry(
        ledger, "applied", "apply_delete", plan, now,
        {"records": count, "fields": [GUARD], "fingerprint": digest, "written": None},
        [written_records(rows, [GUARD], None)])
    return ApplyResult("apply_delete", {"records_deleted": count, "entry_id": entry_id}, commit, made)


def bin_rows(df: DataFrame, now: str) -> DataFrame:
    return df.where(F.col("expires_at") > F.lit(now).cast("timestamp"))
