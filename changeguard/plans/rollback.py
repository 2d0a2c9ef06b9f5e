"""Rollback: restore what the last apply of a change overwrote."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.errors import DriftRefused, NothingMatched
from changeguard.functions.scalars import flat_value
from changeguard.operators.fingerprints import fingerprint_value
from changeguard.operators.ledgers import last_applied
from changeguard.operators.matching import rollback_join
from changeguard.plans.common import (GUARD, ApplyResult, commit_or_log, log_entry, refuse, require_plan,
                                      snapshot_rows, written_records)
from changeguard.sources.ledger_store import LedgerStore
from changeguard.sources.plan_store import Plan, plan_key
from changeguard.sources.snapshots import SnapshotTable


def _written_text(target: DataFrame, changes: dict) -> dict[str, str | None]:
    """The values the apply set, in the text form states are compared in."""
    kinds = {f: target.schema[f].dataType for f in changes}
    row = target.sparkSession.range(1).select(
        *[flat_value(F.lit(v).cast(kinds[f]), kinds[f]).alias(f) for f, v in changes.items()]).head()
    return row.asDict()


def plan_rollback(entries: DataFrame, records: DataFrame, target: DataFrame, module: str, key: str) -> Plan:
    """What undoing the newest apply of plan ``key`` would restore, which of its
    records are gone, and which were changed again since."""
    asked = entries.sparkSession.createDataFrame([(key,)], "plan_key string")
    entry = last_applied(entries.where(F.col("plan_key") == key), asked).head()
    if entry is None:
        raise NothingMatched("no applied change with this key is on record")
    changes = json.loads(entry.detail).get("changes")
    if not changes:
        raise NothingMatched("that entry holds no changes to undo")
    fields = sorted(changes)
    before = records.where((F.col("entry_id") == entry.entry_id) & F.col("before").isNotNull())
    joined = rollback_join(before, target, fields, _written_text(target, changes))
    totals = joined.agg(F.count_if(~F.col("missing")).alias("count"), F.count_if("missing").alias("missing"),
                        F.count_if(F.size("changed_again") > 0).alias("changed_again")).head()
    current = target.join(before.select("id"), "id", "left_semi")
    state = fingerprint_value(current, module, sorted({*fields, GUARD}))
    return Plan("rollback", module, plan_key("rollback", module, key, {}), state.digest, totals["count"],
                {"count": totals["count"], "missing": totals.missing, "changed_again": totals.changed_again,
                 "fields": fields, "undoes": entry.entry_id, "applied_at": str(entry.at)}, joined)


def _typed(target: DataFrame, fields: Sequence[str]) -> dict:
    return {f: F.col("restore_to").getItem(f).cast(target.schema[f].dataType) for f in fields}


def apply_rollback(plan: Plan | None, table: SnapshotTable, ledger: LedgerStore, now: str,
                   on_changed_again: str = "refuse") -> ApplyResult:
    """Restore, under the same contract as any other write.

    Records changed again since the apply refuse the rollback, unless the
    caller says ``on_changed_again="restore"``.
    """
    if on_changed_again not in ("refuse", "restore"):
        raise ValueError("on_changed_again must be 'refuse' or 'restore'")
    plan = require_plan(plan)
    fields = plan.summary["fields"]
    guard = sorted({*fields, GUARD})
    version = table.version()
    target = table.read(version)
    restores = plan.rows.where(~F.col("missing")).select("id", "restore_to")
    current = target.join(restores.select("id"), "id", "left_semi")
    state = fingerprint_value(current, plan.module, guard)
    bare = Plan(plan.kind, plan.module, plan.key, plan.fingerprint, plan.count, plan.summary)
    if state.records == 0:
        raise NothingMatched("the rollback restores no records")
    if state.digest != plan.fingerprint:
        refuse(ledger, "apply_rollback", bare, now, state.digest, snapshot_rows(current, fields), guard, state.records)
    if plan.summary["changed_again"] and on_changed_again == "refuse":
        again = plan.rows.where(F.size("changed_again") > 0)
        try:
            refuse(ledger, "apply_rollback", bare, now, state.digest, again, guard, plan.summary["changed_again"],
                   "records were changed again since the apply")
        except DriftRefused as error:
            error.drift = again
            raise
    at = F.lit(now).cast("timestamp")
    restored = (target.join(restores, "id").withColumns(_typed(target, fields) | {GUARD: at})
                .select(*target.columns))
    targets = current.join(restores.withColumnRenamed("restore_to", "intent_map"), "id")
    made = commit_or_log(table, version, restored, None, ledger, "apply_rollback", plan, now, targets, fields, "value")
    commit, entry_id = log_entry(
        ledger, "applied", "apply_rollback", plan, now,
        {"records": state.records, "fields": fields, "fingerprint": state.digest, "undoes": plan.summary["undoes"]},
        [written_records(current, fields, at)])
    return ApplyResult("apply_rollback", {"records_restored": state.records, "entry_id": entry_id}, commit, made)
