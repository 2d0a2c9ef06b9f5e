import json

import pytest
from pyspark.sql import functions as F

from changeguard.errors import DriftRefused, NothingMatched, PlanMismatch, PlanMissing, SetTooLarge, UnresolvedWrite
from changeguard.operators import chains, changes, custody, ledgers, reconcile
from changeguard.plans import audit, delete, handover, merge, rollback, update, upsert
from changeguard.sources import commits
from changeguard.sources.ledger_store import LedgerStore
from changeguard.sources.snapshots import SnapshotTable

NOW, LATER = "2026-03-02 04:30:00", "2026-03-02 05:00:00"
SCHEMA = "id string, owner_id string, stage string, email string, t string"


class World:
    def __init__(self, spark, path, data, module="Deals"):
        self.spark, self.module = spark, module
        df = spark.createDataFrame(data, SCHEMA).withColumn("modified_time", F.to_timestamp("t")).drop("t")
        self.table = SnapshotTable.create(df, f"{path}/{module}", module)
        self.ledger = LedgerStore(spark, f"{path}/ledger")

    def state(self, *cols):
        return {r.id: tuple(r[c] for c in cols) for r in self.table.read().collect()}

    def edit(self, record, **values):
        row = self.table.read().where(F.col("id") == record).withColumns({k: F.lit(v) for k, v in values.items()})
        row = row.withColumn("modified_time", F.lit("2026-03-02 04:31:00").cast("timestamp"))
        self.table.commit(self.table.stage(row), self.table.version())

    def outcomes(self):
        return [(r.outcome, r.command, r.module) for r in self.ledger.read().orderBy("segment", "seq").collect()]

    def named(self):
        long = ledgers.ledger_by_record(self.ledger.read(), self.ledger.records())
        return {(r.outcome, r.id) for r in long.collect()}


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, str(tmp_path), [
        ("1", "100", "old", "a@x", "2026-01-01"), ("2", "100", "old", None, "2026-01-02"), ("3", "200", "new", "c@x", "2026-01-03")])


WHERE, CHANGE = "stage = 'old'", {"stage": "new"}


def test_update_applies_what_was_planned(world, spark):
    plan = update.plan_update(world.table.read(), "Deals", "stage in ('old', 'new')", CHANGE)
    assert plan.summary == {"count": 3, "would_change": 2, "fields": ["stage"]}
    result = update.apply_update(plan, world.table, world.ledger, "stage in ('old', 'new')", CHANGE, NOW)
    assert result.summary["records_applied"] == 3
    assert world.state("stage") == {"1": ("new",), "2": ("new",), "3": ("new",)}
    assert world.outcomes() == [("applied", "apply_update", "Deals")]
    before = {r.id: r.before for r in world.ledger.records().collect()}
    assert before == {"1": {"stage": "old"}, "2": {"stage": "old"}, "3": {"stage": "new"}}
    feed = world.table.read().select(F.lit("Deals").alias("module"), "id", F.date_format(
        "modified_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modified_raw"))
    summary, _ = changes.scan_changes(feed, world.ledger.read(), records=world.ledger.records())
    assert (summary.head().changes, summary.head().ungoverned, summary.head().unmatchable_ledger_entries) == (3, 0, 0)


@pytest.mark.parametrize("edit", [{"stage": "odd"}, {"email": "z@x"}])
def test_any_edit_between_plan_and_apply_refuses(world, edit):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    world.edit("1", **edit)
    with pytest.raises(DriftRefused) as error:
        update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    assert {r.id for r in error.value.drift.collect()} == {"1"}
    assert world.state("stage")["2"] == ("old",)
    assert world.outcomes() == [("refused", "apply_update", "Deals")]
    assert ("refused", "2") in world.named()


def test_a_new_match_is_drift_too(world):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    world.edit("3", stage="old")
    with pytest.raises(DriftRefused) as error:
        update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    assert [(r.id, r.drift) for r in error.value.drift.collect()] == [("3", "added")]


def test_update_refusals(world):
    table = world.table.read()
    with pytest.raises(NothingMatched):
        update.plan_update(table, "Deals", "stage = 'none'", CHANGE)
    with pytest.raises(SetTooLarge):
        update.plan_update(table, "Deals", WHERE, CHANGE, max_records=1)
    with pytest.raises(ValueError):
        update.plan_update(table, "Deals", WHERE, {"nope": 1})
    with pytest.raises(PlanMissing):
        update.apply_update(None, world.table, world.ledger, WHERE, CHANGE, NOW)


def unanswered(monkeypatch, table):
    """Commits of this table reach nobody knows where."""
    real = commits.write_once

    def write_once(spark, path, content):
        if path.startswith(table.path + "/"):
            raise UnresolvedWrite("no answer")
        return real(spark, path, content)

    monkeypatch.setattr(commits, "write_once", write_once)


@pytest.mark.parametrize("landed", [False, True])
def test_an_unanswered_update_is_logged_and_reconciled(world, spark, monkeypatch, landed):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    unanswered(monkeypatch, world.table)
    with pytest.raises(UnresolvedWrite):
        update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    monkeypatch.undo()
    if landed:
        for record in ("1", "2"):
            world.edit(record, stage="new")
    assert world.outcomes() == [("unresolved", "apply_update", "Deals")]
    current = reconcile.current_state(world.table.read().withColumn("module", F.lit("Deals")), ["stage"])
    totals, verdicts = reconcile.reconcile(world.ledger.read(), current, world.ledger.records())
    assert {(r.id, r.verdict) for r in verdicts.collect()} == {(i, "landed" if landed else "not_landed") for i in "12"}
    audit.record_reconciliation(world.ledger, verdicts, LATER)
    assert [o for o, *_ in world.outcomes()] == ["unresolved", "reconciled"]
    ledger, records = world.ledger.read(), world.ledger.records()
    assert ledgers.open_unresolved(ledger).count() == 0
    assert reconcile.reconcile(ledger, current, records)[1].count() == 0
    attached = ledgers.attach_reconciled(ledgers.ledger_by_record(ledger, records), ledger, records)
    assert {r.verdict for r in attached.collect()} == {"landed" if landed else "not_landed"}
    assert chains.verify_ledger(ledger, world.ledger.segments()).head().intact
    assert world.ledger.verify_records().count() == 0


def test_delete(world, spark, tmp_path, monkeypatch):
    plan = delete.plan_delete(world.table.read(), "Deals", WHERE)
    world.edit("1", email="q@x")
    with pytest.raises(DriftRefused):
        delete.apply_delete(plan, world.table, world.ledger, WHERE, NOW)
    plan = delete.plan_delete(world.table.read(), "Deals", WHERE)
    delete.apply_delete(plan, world.table, world.ledger, WHERE, NOW, str(tmp_path / "bin"))
    assert set(world.state("stage")) == {"3"}
    assert {r.id for r in delete.bin_rows(spark.read.parquet(str(tmp_path / "bin")), LATER).collect()} == {"1", "2"}
    ledger, records = world.ledger.read(), world.ledger.records()
    assert ledgers.unmatchable_count(ledger, records).head().unmatchable == 1
    assert {("refused", "1"), ("applied", "1"), ("applied", "2")} <= world.named()
    plan = delete.plan_delete(world.table.read(), "Deals", "id = '3'")
    unanswered(monkeypatch, world.table)
    with pytest.raises(UnresolvedWrite):
        delete.apply_delete(plan, world.table, world.ledger, "id = '3'", LATER)
    monkeypatch.undo()
    current = reconcile.current_state(world.table.read().withColumn("module", F.lit("Deals")), [])
    _, verdicts = reconcile.reconcile(world.ledger.read(), current, world.ledger.records())
    assert [(r.id, r.basis, r.verdict) for r in verdicts.collect()] == [("3", "existence", "not_landed")]


USERS = [("100", "Ann Leaver", "ann@x"), ("200", "Bob Taker", "bob@x")]


def test_handover(spark, tmp_path):
    deals = World(spark, str(tmp_path), [("1", "100", "Open", None, "2026-01-01"), ("2", "100", "Closed Won", None, "2026-01-01"),
                                         ("3", "200", "Open", None, "2026-01-01")])
    leads = World(spark, str(tmp_path), [("7", "100", "x", None, "2026-01-01")], "Leads")
    users = spark.createDataFrame(USERS, "id string, full_name string, email string")
    tables = {"Deals": deals.table, "Leads": leads.table}
    read = lambda: {m: t.read() for m, t in tables.items()}
    plan = handover.plan_handover(read(), users, "ann", "200")
    assert (plan.count, plan.summary["counts"], plan.summary["closed_excluded"]) == (2, {"Deals": 1, "Leads": 1}, 1)
    assert handover.plan_handover(read(), users, "ann", "200", closed="include").count == 3
    deals.edit("3", owner_id="100")
    with pytest.raises(DriftRefused):
        handover.apply_handover(plan, tables, deals.ledger, NOW)
    assert [x[2] for x in deals.outcomes()] == ["Deals", "Leads"]
    plan = handover.plan_handover(read(), users, "ann", "200")
    result = handover.apply_handover(plan, tables, deals.ledger, NOW)
    assert result.summary == {"moved": 3, "per_module": {"Deals": 2, "Leads": 1}}
    assert deals.state("owner_id") == {"1": ("200",), "2": ("100",), "3": ("200",)} and leads.state("owner_id") == {"7": ("200",)}
    ids = spark.createDataFrame([("Deals", "1"), ("Deals", "2"), ("Leads", "7")], "module string, id string")
    current = deals.table.read().withColumn("module", F.lit("Deals")).unionByName(leads.table.read().withColumn("module", F.lit("Leads")))
    current = current.select("module", "id", F.col("modified_time").alias("modified_at"), F.col("owner_id").alias("modified_by"))
    _, verdicts, _ = custody.custody_report(ids, deals.ledger.read(), current, deals.ledger.records())
    assert {(r.module, r.id): r.custody for r in verdicts.collect()} == {
        ("Deals", "1"): "governed", ("Deals", "2"): "unproven", ("Leads", "7"): "governed"}
    with pytest.raises(NothingMatched):
        handover.plan_handover({"Leads": leads.table.read()}, users, "100", "200")
    with pytest.raises(ValueError):
        handover.plan_handover(read(), users, "ann", "ann")


def test_a_handover_that_loses_contact_says_how_far_it_got(spark, tmp_path, monkeypatch):
    deals = World(spark, str(tmp_path), [("1", "100", "Open", None, "2026-01-01")])
    leads = World(spark, str(tmp_path), [("7", "100", "x", None, "2026-01-01")], "Leads")
    users = spark.createDataFrame(USERS, "id string, full_name string, email string")
    tables = {"Deals": deals.table, "Leads": leads.table}
    plan = handover.plan_handover({m: t.read() for m, t in tables.items()}, users, "100", "200")
    unanswered(monkeypatch, leads.table)
    with pytest.raises(UnresolvedWrite):
        handover.apply_handover(plan, tables, deals.ledger, NOW)
    assert [(o, m) for o, _, m in deals.outcomes()] == [("applied", "Deals"), ("unresolved", "Leads")]
    detail = json.loads(deals.ledger.read().where("outcome = 'unresolved'").head().detail)
    assert detail["modules_completed"] == {"Deals": 1} and detail["intent"] == {"owner_id": "200"}


def test_merge(world, spark, tmp_path):
    kids = spark.createDataFrame([("n1", "2", "a"), ("n2", "3", "b")], "id string, parent_id string, title string")
    notes = SnapshotTable.create(kids, str(tmp_path / "notes"), "Notes")
    pairs = spark.createDataFrame([("2", "1")], "master_id string, loser_id string")
    plan = merge.plan_merge(world.table.read(), "Deals", {"Notes": notes.read(), "Calls": None}, pairs)
    assert (plan.count, plan.summary["only_on_loser"], plan.summary["related_records_moving"]) == (2, 1, 0)
    world.edit("2", stage="x")
    with pytest.raises(DriftRefused):
        merge.apply_merge(plan, world.table, {"Notes": notes}, pairs, world.ledger, NOW)
    back = spark.createDataFrame([("2", "1"), ("2", "3")], "master_id string, loser_id string")
    plan = merge.plan_merge(world.table.read(), "Deals", {"Notes": notes.read()}, back)
    result = merge.apply_merge(plan, world.table, {"Notes": notes}, back, world.ledger, NOW)
    assert (result.summary["merged"], result.summary["related_moved"]) == (2, {"Notes": 1})
    assert world.state("stage", "email") == {"2": ("x", "a@x")}
    assert {r.id: r.parent_id for r in notes.read().collect()} == {"n1": "2", "n2": "2"}
    archive = {r.id: json.loads(r.archive) for r in world.ledger.records().where("source = 'archive'").collect()}
    assert set(archive) == {"1", "3"} and archive["3"]["email"] == "c@x"
    assert [o for o, *_ in world.outcomes()] == ["refused", "applied", "applied"]
    with pytest.raises(ValueError, match="do not exist"):
        merge.plan_merge(world.table.read(), "Deals", {}, spark.createDataFrame([("2", "77")], pairs.schema))
    with pytest.raises(ValueError, match="merged into itself"):
        merge.plan_merge(world.table.read(), "Deals", {}, spark.createDataFrame([("2", "2")], pairs.schema))


def test_upsert(world, spark):
    incoming = spark.createDataFrame([(1, "a@x", "up"), (2, "new@x", "made")], "row_id long, email string, stage string")
    plan = upsert.plan_upsert(world.table.read(), "Deals", incoming, ["email"])
    assert (plan.summary["will_update"], plan.summary["will_create"]) == (1, 1)
    corrected = incoming.withColumn("stage", F.lit("fixed"))
    assert upsert.upsert_key("Deals", corrected, ["email"]) == plan.key
    world.edit("1", stage="moved")
    with pytest.raises(DriftRefused):
        upsert.apply_upsert(plan, world.table, world.ledger, corrected, ["email"], ["email", "stage"], NOW)
    plan = upsert.plan_upsert(world.table.read(), "Deals", incoming, ["email"])
    world.edit("3", stage="unrelated")
    result = upsert.apply_upsert(plan, world.table, world.ledger, corrected, ["email"], ["email", "stage"], NOW)
    assert result.summary["SUCCESS"] == 2
    assert world.state("email", "stage") == {"1": ("a@x", "fixed"), "2": (None, "old"), "3": ("c@x", "unrelated"), "4": ("new@x", "fixed")}
    assert {("refused", "1"), ("applied", "1"), ("applied", "4")} == world.named()


def test_rollback(world):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    undo = lambda: rollback.plan_rollback(world.ledger.read(), world.ledger.records(), world.table.read(), "Deals", plan.key)
    back = undo()
    assert (back.count, back.summary["missing"], back.summary["changed_again"]) == (2, 0, 0)
    world.edit("1", stage="again")
    with pytest.raises(DriftRefused):
        rollback.apply_rollback(back, world.table, world.ledger, LATER)
    back = undo()
    assert back.summary["changed_again"] == 1
    with pytest.raises(DriftRefused):
        rollback.apply_rollback(back, world.table, world.ledger, LATER)
    rollback.apply_rollback(back, world.table, world.ledger, LATER, on_changed_again="restore")
    assert world.state("stage") == {"1": ("old",), "2": ("old",), "3": ("new",)}
    assert [o for o, *_ in world.outcomes()] == ["applied", "refused", "refused", "applied"]
    prior = world.ledger.records().where("source = 'written' and id = '1'").orderBy("written_time").collect()
    assert [r.before for r in prior] == [{"stage": "old"}, {"stage": "again"}]
    with pytest.raises(NothingMatched):
        rollback.plan_rollback(world.ledger.read(), world.ledger.records(), world.table.read(), "Deals", "no such key")


def test_audit_pack_checks_the_whole_chain(world):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    summary, rows = audit.audit_pack(world.ledger.read(), world.ledger.segments(), outcome="refused")
    row = summary.head()
    assert (row.entries, row.chain_intact, row.chain_verified, rows.count()) == (0, True, 1, 0)
    assert audit.audit_pack(world.ledger.read(), world.ledger.segments())[0].head().records_changed == 2


def test_other_inputs_than_the_planned_ones_are_refused(world, spark):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    for where, change in ((WHERE, {"stage": "UNREVIEWED"}), ("stage in ('old')", CHANGE)):
        with pytest.raises(PlanMismatch):
            update.apply_update(plan, world.table, world.ledger, where, change, NOW)
    gone = delete.plan_delete(world.table.read(), "Deals", "id = '1'")
    with pytest.raises(PlanMismatch):
        delete.apply_delete(gone, world.table, world.ledger, "id = '2'", NOW)
    assert len(world.state("stage")) == 3 and ("new",) not in [world.state("stage")[i] for i in "12"]
    assert [o for o, *_ in world.outcomes()] == ["refused"] * 3


def test_swapped_and_unusable_pairs_are_refused(world, spark):
    pairs = spark.createDataFrame([("2", "1")], "master_id string, loser_id string")
    plan = merge.plan_merge(world.table.read(), "Deals", {}, pairs)
    swapped = spark.createDataFrame([("1", "2")], pairs.schema)
    with pytest.raises(PlanMismatch):
        merge.apply_merge(plan, world.table, {}, swapped, world.ledger, NOW)
    with pytest.raises(ValueError, match="merged into itself"):
        merge.apply_merge(plan, world.table, {}, pairs.union(spark.createDataFrame([("3", "3")], pairs.schema)), world.ledger, NOW)
    assert len(world.state("stage")) == 3 and world.outcomes() == [("refused", "apply_merge", "Deals")]


def test_upsert_refuses_extra_rows_and_keys_that_appeared(world, spark):
    schema = "row_id long, email string, stage string"
    incoming = spark.createDataFrame([(1, "a@x", "up"), (2, "new@x", "made")], schema)
    plan = upsert.plan_upsert(world.table.read(), "Deals", incoming, ["email"])
    extra = incoming.union(spark.createDataFrame([(3, "more@x", "made")], schema))
    with pytest.raises(PlanMismatch):
        upsert.apply_upsert(plan, world.table, world.ledger, extra, ["email"], ["email", "stage"], NOW)
    world.edit("2", email="new@x")
    with pytest.raises(DriftRefused, match="other records"):
        upsert.apply_upsert(plan, world.table, world.ledger, incoming, ["email"], ["email", "stage"], NOW)
    assert len(world.state("email")) == 3 and [o for o, *_ in world.outcomes()] == ["refused", "refused"]


def test_upsert_derives_its_match_once_per_step(world, spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    incoming = spark.createDataFrame([(1, "a@x", "up"), (2, "new@x", "made")], "row_id long, email string, stage string")
    incoming = incoming.withColumn("email", F.udf(counted)("email"))
    plan = upsert.plan_upsert(world.table.read(), "Deals", incoming, ["email"])
    for read in (lambda: plan.rows.collect(), lambda: plan.rows.count()):
        before = seen.value
        read()
        assert seen.value == before  # the plan's rows are stored
    before = seen.value
    result = upsert.apply_upsert(plan, world.table, world.ledger, incoming, ["email"], ["email", "stage"], NOW)
    assert (seen.value - before) / 2 <= 8
    before = seen.value
    assert {(r.row_id, r.id, r.action, r.code) for r in result.extra["results"].collect()} == {
        (1, "1", "update", "SUCCESS"), (2, "4", "create", "SUCCESS")}
    assert seen.value == before


def test_a_plan_grows_too_old(world):
    plan = update.plan_update(world.table.read(), "Deals", WHERE, CHANGE)
    plan.made = "2026-03-02 03:30:00"
    with pytest.raises(PlanMismatch, match="too old"):
        update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    plan.made = "2026-03-02 03:30:01"
    update.apply_update(plan, world.table, world.ledger, WHERE, CHANGE, NOW)
    assert [o for o, *_ in world.outcomes()] == ["refused", "applied"]
