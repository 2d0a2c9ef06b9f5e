"""What every plan and apply shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.errors import DriftRefused, NothingMatched, PlanMismatch, PlanMissing, UnresolvedWrite
from changeguard.functions.scalars import state_map
from changeguard.operators.fingerprints import drift_rows, fingerprint_value
from changeguard.sources.ledger_store import LedgerStore, new_entry, records_digest, records_of
from changeguard.sources.plan_store import TTL_SECONDS, Plan
from changeguard.sources.snapshots import SnapshotTable

GUARD = "modified_time"
MOVED = "the selected rows are no longer those of the plan"


@dataclass
class ApplyResult:
    command: str
    summary: dict
    commit: dict | None = None
    version: int | None = None
    extra: dict = field(default_factory=dict)


def require_plan(plan: Plan | None) -> Plan:
    if plan is None:
        raise PlanMissing("no plan was given: an apply needs the plan that was reviewed")
    return plan


def _seconds(text: str) -> float:
    at = datetime.fromisoformat(text)
    return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).timestamp()


def hold_to_plan(plan: Plan | None, key: str, command: str, ledger: LedgerStore, now: str) -> Plan:
    """The plan, if ``key``, made anew from the apply's own inputs, is that of
    the plan and the plan has not outlived ``TTL``.  Otherwise the attempt is
    logged as refused and nothing is written."""
    plan = require_plan(plan)
    reason = None
    if plan.key != key:
        reason = "the inputs are not those that were planned"
    elif plan.made is not None and _seconds(now) - _seconds(plan.made) >= TTL_SECONDS:
        reason = "the plan is too old"
    if reason:
        log_entry(ledger, "refused", command, plan, now,
                  {"reason": reason, "expected": plan.key, "actual": key, "records": plan.count})
        raise PlanMismatch(f"{command}: {reason}")
    return plan


def guarded(rows: DataFrame, module: str, guard: Sequence[str], what: str) -> tuple[int, str]:
    """(count, fingerprint) of a selected set; refuses empty sets and rows
    without an id, which nothing could guard."""
    state = fingerprint_value(rows, module, guard)
    if state.records == 0:
        raise NothingMatched(f"{what} selected no rows")
    if state.null_ids:
        raise ValueError(f"{what} selected {state.null_ids} rows without an id")
    return state.records, state.digest


def check_columns(df: DataFrame, names: Sequence[str]) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")


def snapshot_rows(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """What a plan keeps of each selected row: its id, guard columns and prior values."""
    return rows.select("id", *dict.fromkeys([*fields, GUARD]))


def log_entry(ledger: LedgerStore, outcome: str, command: str, plan: Plan, now: str, detail: Mapping,
              records: Sequence[DataFrame] = (), module: str | None = None) -> tuple[dict, str]:
    """Append one entry with its record rows; the entry digests the rows."""
    entry = new_entry(outcome, command, module or plan.module, plan.key, now, {})
    owned = None
    for part in records:
        rows = part.withColumn("entry_id", F.lit(entry["entry_id"]))
        owned = rows if owned is None else owned.unionByName(rows)
    body = dict(detail)
    if owned is not None:
        body["records_digest"] = records_digest(owned)
    entry.update(new_entry(outcome, command, module or plan.module, plan.key, now, body)
                 | {"entry_id": entry["entry_id"]})
    return ledger.append([entry], records=owned), entry["entry_id"]


def refuse(ledger: LedgerStore, command: str, plan: Plan, now: str, actual: str, rows_now: DataFrame,
           guard: Sequence[str], count: int, reason: str = MOVED) -> None:
    """Log the refusal with the records it declined to touch, then raise."""
    targets = records_of(rows_now, "", "targets")
    log_entry(ledger, "refused", command, plan, now,
              {"reason": reason, "expected": plan.fingerprint, "actual": actual, "records": count}, [targets])
    drift = drift_rows(plan.rows, rows_now, [c for c in guard if c != "id"]) if plan.rows is not None else None
    raise DriftRefused(f"{command}: {reason}", drift, plan.fingerprint, actual)


def written_records(rows: DataFrame, fields: Sequence[str], written: Column | None) -> DataFrame:
    """Record rows of an applied entry: prior values, and when they were written."""
    columns = {"before": state_map(rows, fields)}
    if written is not None:
        columns["written_time"] = written
    return records_of(rows, "", "written" if written is not None else "before", **columns)


def log_unresolved(ledger: LedgerStore, command: str, plan: Plan, now: str, targets: DataFrame,
                   fields: Sequence[str], basis: str, intent: Mapping | None = None,
                   progress: Mapping | None = None, error: Exception | None = None,
                   module: str | None = None) -> UnresolvedWrite:
    """Record a write whose outcome is unknown, and hand back what to raise.

    ``basis`` says how the outcome can be found out later: "value" compares the
    fields, "existence" asks whether the record is still there, "modified_time"
    only whether it moved.  ``targets`` hold the state from just before.
    """
    extra = {}
    if "intent_map" in targets.columns:
        extra["intent"] = F.col("intent_map")
    if "role" in targets.columns:
        extra["role"] = F.col("role")
    rows = records_of(targets, "", "targets", before=state_map(targets, fields),
                      before_modified_time=F.col(GUARD), **extra)
    detail = {"verdict_basis": basis, "intent": dict(intent) if intent else None, "fields": list(fields),
              "reason": str(error), "attempted_at": now, **(progress or {})}
    _, entry_id = log_entry(ledger, "unresolved", command, plan, now, detail, [rows], module)
    return UnresolvedWrite(f"{error}; recorded as entry {entry_id} with the state before the attempt")


def commit_change(table: SnapshotTable, version: int, changed: DataFrame | None,
                  deleted: DataFrame | None = None) -> int:
    return table.commit(table.stage(changed, deleted), version)


def commit_or_log(table: SnapshotTable, version: int, changed: DataFrame | None, deleted: DataFrame | None,
                  ledger: LedgerStore, command: str, plan: Plan, now: str, targets: DataFrame,
                  fields: Sequence[str], basis: str, intent: Mapping | None = None,
                  progress: Mapping | None = None) -> int:
    """Commit staged rows.  Losing the race is a logged refusal; an unknown
    outcome is a logged attempt."""
    try:
        return commit_change(table, version, changed, deleted)
    except DriftRefused as error:
        log_entry(ledger, "refused", command, plan, now,
                  {"reason": str(error), "expected": plan.fingerprint, "records": plan.count},
                  [records_of(targets, "", "targets")], table.module)
        raise
    except UnresolvedWrite as error:
        raise log_unresolved(ledger, command, plan, now, targets, fields, basis, intent, progress, error,
                             table.module) from error
