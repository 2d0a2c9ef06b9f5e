"""Bulk update: plan, review, apply only what was reviewed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.operators.fingerprints import would_change
from changeguard.operators.scans import require_at_most
from changeguard.plans.common import (GUARD, ApplyResult, check_columns, commit_or_log, guarded, hold_to_plan,
                                      log_entry, refuse,
                                      require_plan, snapshot_rows, written_records)
from changeguard.sources.ledger_store import LedgerStore
from changeguard.sources.plan_store import Plan, plan_key
from changeguard.sources.snapshots import SnapshotTable


def update_key(module: str, predicate: str, changes: Mapping) -> str:
    return plan_key("update", module, predicate, dict(changes))


def plan_update(target: DataFrame, module: str, predicate: str, changes: Mapping[str, object],
                max_records: int | None = None) -> Plan:
    """What an update would touch.  The written fields and the modification
    time are guarded: an edit to any other column moves the latter."""
    if not changes:
        raise ValueError("changes must name at least one column")
    fields = sorted(changes)
    check_columns(target, [*fields, GUARD])
    rows = require_at_most(target.where(predicate), max_records, "the plan")
    guard = sorted({*fields, GUARD})
    count, digest = guarded(rows, module, guard, "the plan")
    differing = would_change(rows, changes).head().would_change
    return Plan("update", module, update_key(module, predicate, changes), digest, count,
                {"count": count, "would_change": differing, "fields": fields}, snapshot_rows(rows, fields))


def apply_update(plan: Plan | None, table: SnapshotTable, ledger: LedgerStore, predicate: str,
                 changes: Mapping[str, object], now: str) -> ApplyResult:
    """Select again, hash again, and write only if nothing moved.  Rows that
    newly match are drift too."""
    plan = require_plan(plan)
    plan = hold_to_plan(plan, update_key(plan.module, predicate, changes), "apply_update", ledger, now)
    version = table.version()
    target = table.read(version)
    fields, guard = sorted(changes), sorted({*changes, GUARD})
    rows = target.where(predicate)
    count, digest = guarded(rows, plan.module, guard, "the apply")
    if digest != plan.fingerprint:
        refuse(ledger, "apply_update", plan, now, digest, snapshot_rows(rows, fields), guard, count)
    new = {n: F.lit(v).cast(target.schema[n].dataType) for n, v in changes.items()}
    changed = rows.withColumns(new | {GUARD: F.lit(now).cast("timestamp")})
    made = commit_or_log(table, version, changed, None, ledger, "apply_update", plan, now, rows, fields, "value",
                         changes)
    commit, entry_id = log_entry(
        ledger, "applied", "apply_update", plan, now,
        {"records": count, "fields": fields, "fingerprint": digest, "changes": dict(changes)},
        [written_records(rows, fields, F.lit(now).cast("timestamp"))])
    return ApplyResult("apply_update", {"records_applied": count, "entry_id": entry_id}, commit, made)
