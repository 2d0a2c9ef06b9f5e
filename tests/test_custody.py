import pytest
from pyspark.sql import functions as F
from test_details import book

from changeguard.operators import changes, custody, scans

EARLY, WRITE, LATER = "2025-06-01T00:00:00Z", "2026-01-01T00:00:00Z", "2026-02-01T00:00:00Z"


def current(spark, data):
    rows = [("Leads", i, t, "Ann") for i, t in data.items()]
    df = spark.createDataFrame(rows, "module string, id string, t string, modified_by string")
    return df.select("module", "id", F.to_timestamp("t").alias("modified_at"), "modified_by")


def written(i, t):
    return ("applied", {"written": [{"id": i, "modified_time": t}]})


def ids(spark, *names):
    return spark.createDataFrame([("Leads", n) for n in names], "module string, id string")


CASES = [
    # entries for record 1, its current time (None = gone), verdict
    ([written("1", WRITE)], WRITE, "governed"),
    ([written("1", "2026-01-01T05:30:00+05:30")], WRITE, "governed"),
    ([written("1", EARLY), written("1", WRITE)], EARLY, "governed"),
    ([written("1", WRITE)], LATER, "diverged"),
    ([written("1", WRITE)], EARLY, "unproven"),
    ([written("1", WRITE)], None, "unproven"),
    ([written("1", WRITE)], "", "unproven"),
    ([("applied", {"targets": ["1"]})], LATER, "unproven"),
    ([("applied", {"archive": [{"id": "1"}]}), written("1", WRITE)], LATER, "diverged"),
    ([("refused", {"targets": ["1"]})], LATER, "diverged"),
    ([("unresolved", {"targets": [{"id": "1"}]})], LATER, "diverged"),
    ([written("2", WRITE)], LATER, "diverged"),
    ([written("2", WRITE)], EARLY, "unproven"),
]


def renamed(value, names):
    """The same entry about other records."""
    if isinstance(value, dict):
        return {k: names.get(v, v) if k == "id" else renamed(v, names) for k, v in value.items()}
    if isinstance(value, list):
        return [names.get(v, v) if isinstance(v, str) else renamed(v, names) for v in value]
    return value


def test_custody_table(spark):
    """Every case about its own record, all in one ledger."""
    entries, state = [], {"9": WRITE}
    for i, (given, now, _) in enumerate(CASES):
        names = {"1": f"1{i:02d}", "2": f"2{i:02d}"}
        entries += [(outcome, renamed(detail, names)) for outcome, detail in given]
        if now is not None:
            state[names["1"]] = now or None
    asked = ids(spark, *[f"1{i:02d}" for i in range(len(CASES))])
    _, verdicts, _ = custody.custody_report(asked, book(spark, *entries), current(spark, state))
    got = {int(r.id) - 100: (r.custody, r.ungoverned) for r in verdicts.collect()}
    assert got == {i: (case[-1], case[-1] == "diverged") for i, case in enumerate(CASES)}


def test_an_empty_ledger_claims_nothing(spark):
    _, verdicts, _ = custody.custody_report(ids(spark, "1"), book(spark, ("applied", {})).limit(0), current(spark, {"1": LATER}))
    assert verdicts.head().custody == "unproven"


def test_unread_state_is_unchecked_and_history_still_counts(spark):
    ledger = book(spark, written("1", WRITE), ("refused", {"targets": ["1"]}))
    totals, verdicts, events = custody.custody_report(ids(spark, "1", "2", "1"), ledger)
    assert {(r.id, r.custody, r.governed_changes, r.refusals) for r in verdicts.collect()} == {
        ("1", "unchecked", 1, 1), ("2", "unchecked", 0, 0)}
    row = totals.head()
    assert (row.records, row.unchecked, row.governed_changes_total, row.refusals_total) == (2, 2, 1, 1)
    assert [e.kind for e in events.collect()] == ["governed_change", "refusal"]


def test_a_record_written_twice_in_one_entry(spark):
    """Both times are governed states; the entry counts once, in the totals and in the timeline."""
    twice = ("applied", {"written": [{"id": "1", "modified_time": EARLY}, {"id": "1", "modified_time": WRITE},
                                     {"id": "2", "modified_time": WRITE}]})
    for now, verdict in ((EARLY, "governed"), (WRITE, "governed"), (LATER, "diverged")):
        _, verdicts, events = custody.custody_report(ids(spark, "1"), book(spark, twice), current(spark, {"1": now}))
        row = verdicts.head()
        assert (row.custody, row.governed_changes) == (verdict, 1)
        assert [(e.id, e.kind) for e in events.collect()] == [("1", "governed_change")]


def test_records_beside_the_ledger_count_like_inline_ones(spark):
    ledger = book(spark, ("applied", {"fields": ["stage"]}), ("refused", {"reason": "drift"}), written("2", WRITE))
    records = spark.createDataFrame([("e1", "1", WRITE), ("e1", "3", WRITE), ("e2", "1", None)], "entry_id string, id string, t string")
    records = records.select("entry_id", "id", F.to_timestamp("t").alias("written_time"), F.lit(None).cast("string").alias("verdict"))
    _, verdicts, events = custody.custody_report(ids(spark, "1", "2"), ledger, current(spark, {"1": WRITE, "2": LATER}), records)
    assert {(r.id, r.custody, r.governed_changes, r.refusals) for r in verdicts.collect()} == {
        ("1", "governed", 1, 1), ("2", "diverged", 1, 0)}
    assert [(e.id, e.kind, e.reason) for e in events.collect()] == [
        ("1", "governed_change", None), ("1", "refusal", "drift"), ("2", "governed_change", None)]


def test_custody_parses_details_once(spark):
    ledger = book(spark, written("1", WRITE))
    plan = custody.custody_report(ids(spark, "1"), ledger, current(spark, {"1": WRITE}))[1]._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_parse_json") == 1


def test_ids_are_checked(spark):
    good, bad = custody.check_ids(ids(spark, "1", "x"))
    assert ([r.id for r in good.collect()], [r.id for r in bad.collect()]) == (["1"], ["x"])


# --- change scan ------------------------------------------------------------

def feed(spark, *rows):
    return spark.createDataFrame(rows, "module string, id string, modified_raw string")


def test_a_change_matches_an_approval_exactly_or_not_at_all(spark):
    ledger = book(spark, written("1", WRITE), written("2", WRITE), ("applied", {"written": None}))
    summary, found = changes.scan_changes(
        feed(spark, ("Leads", "1", "2026-01-01T05:30:00+05:30"), ("Leads", "2", "2026-01-01T00:00:01Z"),
             ("Deals", "1", WRITE), ("Leads", "1", "unreadable"), ("Leads", None, WRITE), ("Leads", "", WRITE)), ledger)
    assert {(r.change_ref, r.governed) for r in found.collect()} == {
        ("Leads:1:2026-01-01T00:00:00Z", True), ("Leads:2:2026-01-01T00:00:01Z", False),
        ("Deals:1:2026-01-01T00:00:00Z", False), ("Leads:1:unreadable:unreadable", False)}
    row = summary.head()
    assert (row.changes, row.ungoverned, row.unreadable, row.unmatchable_ledger_entries, row.truncated) == (4, 3, 1, 1, False)


def test_two_edits_of_one_record_are_two_changes(spark):
    rows = feed(spark, ("Leads", "1", WRITE), ("Leads", "1", LATER))
    delivered = spark.createDataFrame([(f"Leads:1:{WRITE}",)], "change_ref string")
    summary, found = changes.scan_changes(rows, book(spark, ("refused", {})), delivered=delivered)
    assert [r.change_ref for r in found.collect()] == [f"Leads:1:{LATER}"]
    assert summary.head().skipped_already_delivered == 1 and summary.head().rows_scanned == 2


def test_since_is_strict_and_unreadable_rows_are_not_lost(spark):
    rows = feed(spark, ("Leads", "1", WRITE), ("Leads", "2", LATER), ("Leads", "3", "soon"))
    _, found = changes.scan_changes(rows, book(spark, ("refused", {})), since="2026-01-01T05:30:00+05:30")
    assert sorted(r.id for r in found.collect()) == ["2", "3"]
    with pytest.raises(ValueError):
        changes.scan_changes(rows, book(spark, ("refused", {})), since="last tuesday")


@pytest.mark.parametrize("cap,truncated", [(1, True), (2, False), (3, False)])
def test_the_cap_keeps_the_oldest_and_is_honest_about_the_rest(spark, cap, truncated):
    rows = feed(spark, ("Leads", "2", LATER), ("Leads", "1", WRITE), ("Deals", "5", WRITE))
    summary, found = changes.scan_changes(rows, book(spark, ("refused", {})), cap=cap)
    assert summary.head().truncated is truncated
    assert ("Leads", "1") in {(r.module, r.id) for r in found.collect()}


def test_governed_and_ungoverned_make_the_whole(spark):
    ledger = book(spark, written("1", WRITE))
    rows = feed(spark, *[("Leads", str(i % 3), WRITE) for i in range(30)])
    _, found = changes.scan_changes(rows, ledger)
    assert found.count() == 30 and found.where("governed").count() == 10
    readable, unreadable = changes.split_unreadable(found)
    assert (readable.count(), unreadable.count()) == (30, 0)
    assert [r.modified_at for r in scans.order_changes(found).collect()] == sorted(r.modified_at for r in found.collect())
