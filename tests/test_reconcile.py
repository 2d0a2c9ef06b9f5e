import json

import pytest
from pyspark.sql import functions as F
from test_details import book

from changeguard.operators import reconcile

T0, T0_OFFSET, T1 = "2025-12-31T18:30:00Z", "2026-01-01T00:00:00+05:30", "2026-01-01T18:30:00Z"


def state(spark, data):
    """{id: (modified text, values)} as current records of Leads."""
    rows = [("Leads", i, t, v) for i, (t, v) in data.items()]
    df = spark.createDataFrame(rows, "module string, id string, t string, state map<string,string>")
    return df.select("module", "id", F.to_timestamp("t").alias("now_time"), "state")


def target(before, baseline=T0, **more):
    return {"id": "1", "before": before, "before_modified_time": baseline, **more}


CASES = [
    # basis, target, intent, current (None = gone), verdict
    ("value", target({"S": "old"}), {"S": "new"}, (T1, {"S": "new"}), "landed"),
    ("value", target({"S": "old"}), {"S": "new"}, (T0, {"S": "old"}), "not_landed"),
    ("value", target({"S": "old"}, T0_OFFSET), {"S": "new"}, (T0, {"S": "old"}), "not_landed"),
    ("value", target({"S": "old"}), {"S": "new"}, (T1, {"S": "old"}), "unknown"),
    ("value", target({"S": "old"}), {"S": "new"}, (T1, {"S": "other"}), "unknown"),
    ("value", target({"S": "old"}), {"S": "new"}, (T0, {"S": "new"}), "unknown"),
    ("value", target({"S": "new"}), {"S": "new"}, (T1, {"S": "new"}), "unknown"),
    ("value", target({"S": "old"}), {"S": "new"}, None, "unknown"),
    ("value", target({"S": "old"}), {"S": "new"}, (None, {"S": "new"}), "unknown"),
    ("value", target({"S": "old"}, None), {"S": "new"}, (T1, {"S": "new"}), "unreconcilable"),
    ("value", target({"S": "old"}, ""), {"S": "new"}, (T1, {"S": "new"}), "unreconcilable"),
    ("value", target({"S": "old"}, "soon"), {"S": "new"}, (T1, {"S": "new"}), "unknown"),
    ("value", target({"S": "old"}), {}, (T1, {"S": "old"}), "unknown"),
    ("value", target({"S": "old"}), None, (T0, {"S": "old"}), "unknown"),
    ("value", target({"S": None}), {"S": "new"}, (T0, {"S": None}), "not_landed"),
    ("value", target({"O": "9"}), {"O": {"id": "7"}}, (T1, {"O": "7"}), "landed"),
    ("value", target({"S": "was"}, intent={"S": "own"}), {"S": "new"}, (T1, {"S": "own"}), "landed"),
    ("value", target({"S": "was"}, intent={"S": "own"}), None, (T1, {"S": "own"}), "landed"),
    ("existence", target({}), None, None, "landed"),
    ("existence", target({}), None, (T0, {}), "not_landed"),
    ("existence", target({}), None, (T1, {}), "unknown"),
    ("existence", target({}), None, (None, {}), "unknown"),
    ("modified_time", target({}), None, None, "unknown"),
    ("modified_time", target({}), None, (T0, {}), "not_landed"),
    ("modified_time", target({}), None, (T1, {}), "unknown"),
    ("modified_time", target({}), None, (None, {}), "unknown"),
    ("guess", target({"S": "old"}), {"S": "new"}, (T1, {"S": "new"}), "unknown"),
    (None, target({"S": "old"}), {"S": "new"}, (T1, {"S": "new"}), "unknown"),
]


def test_verdict_table(spark):
    entries = [("unresolved", {"verdict_basis": basis, "intent": intent, "targets": [{**t, "id": str(i)}]})
               for i, (basis, t, intent, _, _) in enumerate(CASES)]
    current = state(spark, {str(i): now for i, (_, _, _, now, _) in enumerate(CASES) if now is not None})
    _, verdicts = reconcile.reconcile(book(spark, *entries), current)
    got = {int(r.id): r.verdict for r in verdicts.collect()}
    assert got == {i: case[-1] for i, case in enumerate(CASES)}


def test_a_failed_read_is_never_a_deleted_record(spark):
    ledger = book(spark, ("unresolved", {"verdict_basis": "existence", "targets": [target({})]}))
    _, verdicts = reconcile.reconcile(ledger, state(spark, {"9": (T0, {})}), failed_modules=["Leads"])
    assert verdicts.head().verdict == "unknown"


def test_settled_records_are_not_judged_again(spark):
    ledger = book(spark, ("unresolved", {"verdict_basis": "modified_time", "targets": [
        {"id": "1", "before_modified_time": T0}, {"id": "2", "before_modified_time": T0}],
        "written_before_failure": [{"id": "1", "modified_time": T1}]}))
    totals, verdicts = reconcile.reconcile(ledger, state(spark, {"1": (T1, {}), "2": (T0, {})}))
    assert {(r.id, r.verdict) for r in verdicts.collect()} == {("1", "already_committed"), ("2", "not_landed")}
    row = totals.head()
    assert (row.landed, row.not_landed, row.already_committed) == (0, 1, 1)


@pytest.mark.parametrize("gone,expected", [
    ({"2", "3"}, "losers_absent"), ({"2"}, "masters_present"), (set(), "masters_present"),
    ({"1", "2", "3"}, "indeterminate")])
def test_a_merge_proves_nothing(spark, gone, expected):
    targets = [{"id": i, "role": "master" if i == "1" else "loser", "before_modified_time": T0, "before": {}} for i in "123"]
    ledger = book(spark, ("unresolved", {"verdict_basis": "existence", "master_id": "1", "targets": targets}))
    ledger = ledger.withColumn("command", F.lit("apply_merge"))
    current = state(spark, {i: (T0, {}) for i in "1239" if i not in gone})
    _, verdicts = reconcile.reconcile(ledger, current)
    assert {(r.verdict, r.merge_state) for r in verdicts.collect()} == {("unknown", expected)}


def test_entries_close_per_record(spark):
    ledger = book(spark, ("unresolved", {"verdict_basis": "value", "intent": {"S": "new"}, "targets": [
        {"id": "1", "before": {"S": "old"}, "before_modified_time": T0},
        {"id": "2", "before": {"S": "old"}, "before_modified_time": T0}]}),
        ("reconciled", {"resolves_seq": 1, "resolved": True, "verdicts": [
            {"id": "1", "verdict": "landed"}, {"id": "2", "verdict": "unknown"}]}))
    current = state(spark, {"1": (T1, {"S": "new"}), "2": (T1, {"S": "new"})})
    _, again = reconcile.reconcile(ledger, current)
    assert [(r.id, r.verdict) for r in again.collect()] == [("2", "landed")]
    _, whole = reconcile.reconcile(ledger, current, close_per="entry")
    assert whole.count() == 0


def test_entry_resolved(rows):
    df = rows([(0, 1, "landed"), (0, 1, "unknown"), (0, 2, "unknown"), (0, 3, "unreconcilable")],
              "segment bigint, seq bigint, verdict string")
    assert {(r.seq, r.resolved, r.still_open) for r in reconcile.entry_resolved(df).collect()} == {
        (1, True, 1), (2, False, 1), (3, False, 1)}


def test_details_are_kept_as_text(spark):
    assert json.loads(book(spark, ("applied", {"a": [1]})).head().detail) == {"a": [1]}
