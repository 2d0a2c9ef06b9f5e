import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.errors import DriftRefused
from changeguard.operators import chains
from changeguard.session import size_shuffles
from changeguard.sources import commits, files, plan_store
from changeguard.sources.ledger_store import LedgerStore, import_book, new_entry, records_digest, records_of
from changeguard.sources.scrub import scrub
from changeguard.sources.snapshots import SnapshotTable

NOW = "2026-03-02 04:30:00"


def entries(n, start=0):
    return [new_entry("applied", "apply_update", "Leads", f"k{i}", f"2026-01-01 00:{(start + i) // 60:02d}:{(start + i) % 60:02d}", {"records": i})
            for i in range(n)]


def test_ledger_rotates_and_stays_one_chain(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"), segment_size=3)
    for n, start in ((2, 0), (5, 10), (1, 20), (4, 30)):
        store.append(entries(n, start))
    ledger, segments = store.read(), store.segments()
    assert sorted((r.segment, r.seq) for r in ledger.collect()) == [(i // 3, i % 3 + 1) for i in range(12)]
    assert [r.at.second for r in ledger.orderBy("segment", "seq").collect()][:3] == [0, 1, 10]
    row = chains.verify_ledger(ledger, segments).head()
    assert (row.intact, row.verified, row.applied) == (True, 12, 12)
    assert all(r.ok for r in store.verify_commits().collect())
    assert {r.segment for r in store.read("live").collect()} == {3}
    assert {r.segment for r in store.read((1, 2)).collect()} == {1, 2}
    # the whole newest segment is missing: no link inside the rest can show it
    short = ledger.where("segment < 3")
    assert not chains.verify_ledger(short, segments).head().intact


def test_uncommitted_entries_are_invisible(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.append(entries(2))
    monkeypatch.setattr(commits, "write_once", lambda *a: False)
    with pytest.raises(DriftRefused):
        store.append(entries(3, 10))
    monkeypatch.undo()
    assert store.read().count() == 2
    store.append(entries(1, 20))
    assert chains.verify_ledger(store.read(), store.segments()).head().verified == 3


def test_a_changed_commit_is_found(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    store.append(entries(2))
    store.append(entries(2, 10))
    file = tmp_path / "ledger" / "commits" / "000000000001.json"
    body = json.loads(file.read_text())
    file.write_text(json.dumps({**body, "segments_digest": "sha256:0"}))
    (tmp_path / "ledger" / "commits" / ".000000000001.json.crc").unlink(missing_ok=True)
    assert {r.number: r.ok for r in store.verify_commits().collect()} == {1: False, 2: True}


def test_records_of_an_entry_are_kept_long(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    [entry] = entries(1)
    rows = spark.range(50).select(F.col("id").cast("string").alias("id"))
    store.append([entry], records=records_of(rows, entry["entry_id"], "written", written_time=F.lit(NOW).cast("timestamp")))
    assert store.records().where(F.col("entry_id") == entry["entry_id"]).count() == 50


def test_record_rows_are_covered_by_their_entry(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    rows = spark.range(5).select(F.col("id").cast("string").alias("id"))
    told, silent, lying = (new_entry("applied", "apply_update", "Leads", "k", NOW, {}) for _ in range(3))
    owned = records_of(rows, told["entry_id"], "written")
    told["detail"] = json.dumps({"records_digest": records_digest(owned)})
    lying["detail"] = told["detail"]
    parts = owned.unionByName(records_of(rows, silent["entry_id"], "written")).unionByName(
        records_of(rows.where("id <> '3'"), lying["entry_id"], "written"))
    store.append([told, silent, lying], records=parts)
    assert {r.entry_id: r.why for r in store.verify_records().collect()} == {
        silent["entry_id"]: "records without a digest", lying["entry_id"]: "records were changed"}


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    (tmp_path / "f").write_bytes(b"x" * (5 << 20))
    try:
        assert size_shuffles(spark, str(tmp_path), partition_mb=1) == 5
        assert size_shuffles(spark, str(tmp_path), partition_mb=1024) == 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_import_book(spark, tmp_path):
    for i, name in enumerate(("a.json", "b.json")):
        (tmp_path / name).write_text(json.dumps({"chain_start": f"s{i}", "entries": [
            {"outcome": "applied", "module": "Leads", "seq": 1, "at": "2026-01-01T00:00:00Z", "detail": {"written": [{"id": "1"}]}, "prev": "p", "entry_hash": "h"},
            {"outcome": "refused", "module": "Leads", "seq": 2, "at": "2026-01-01T00:00:01Z", "detail": 5, "entry_hash": "h2"}]}))
    got, segments = import_book(spark, str(tmp_path))
    assert sorted((r.segment, r.seq, r.outcome, r.detail) for r in got.collect()) == [
        (s, n, o, d) for s in (0, 1) for n, o, d in ((1, "applied", '{"written":[{"id":"1"}]}'), (2, "refused", "5"))]
    assert {(r.segment, r.chain_start, r.n, r.last_hash) for r in segments.collect()} == {(0, "s0", 2, "h2"), (1, "s1", 2, "h2")}


def test_snapshot_table(spark, tmp_path):
    base = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, name string")
    table = SnapshotTable.create(base, str(tmp_path / "t"), "Leads")
    first = table.commit(table.stage(spark.createDataFrame([("1", "A"), ("4", "d")], base.schema)), 0)
    table.commit(table.stage(spark.createDataFrame([("1", "AA")], base.schema), spark.createDataFrame([("2",)], "id string")), first)
    state = lambda df: sorted(tuple(r) for r in df.collect())
    assert state(table.read()) == [("1", "AA"), ("3", "c"), ("4", "d")]
    assert state(table.read(1)) == [("1", "A"), ("2", "b"), ("3", "c"), ("4", "d")] and state(table.read(0)) == state(base)
    staged = table.stage(base)
    assert state(table.read()) == [("1", "AA"), ("3", "c"), ("4", "d")]
    with pytest.raises(DriftRefused):
        table.commit(staged, 1)
    before = state(table.read())
    assert table.compact() == 3 and state(table.read()) == before
    with pytest.raises(DriftRefused):
        SnapshotTable.create(base, str(tmp_path / "t"), "Leads")


def test_plans_expire(spark, tmp_path):
    path, key = str(tmp_path / "plans"), plan_store.plan_key("update", "Leads", "a = 'X'", {"s": 1})
    assert plan_store.load_plan(spark, path, key, NOW) is None
    rows = spark.createDataFrame([("1",)], "id string")
    for count, at in ((1, "2026-03-02 04:00:00"), (2, "2026-03-02 04:10:00")):
        plan_store.save_plan(plan_store.Plan("update", "Leads", key, "f", count, {"n": count}, rows), path, at)
    plan = plan_store.load_plan(spark, path, key, NOW)
    assert (plan.count, plan.summary, plan.rows.count()) == (2, {"n": 2}, 1)
    assert plan_store.load_plan(spark, path, key, "2026-03-02 05:10:00") is None
    assert plan_store.load_plan(spark, path, "other", NOW) is None


def test_expired_days_go_and_extra_tables_stay(spark, tmp_path):
    path, rows = str(tmp_path / "plans"), spark.range(3)
    plan = lambda key, **extra: plan_store.Plan("update", "Leads", key, "f", 3, {}, rows, extra)
    plan_store.save_plan(plan("old"), path, "2026-02-27 23:59:00")
    plan_store.save_plan(plan("a", kept=spark.range(5), none=spark.range(0)), path, "2026-03-01 23:30:00")
    assert commits.children(spark, f"{path}/headers") == ["_SUCCESS", "day=2026-03-01"]
    plan_store.save_plan(plan("b"), path, "2026-03-02 00:10:00")
    assert plan_store.load_plan(spark, path, "old", "2026-02-28 00:10:00") is None
    found = plan_store.load_plan(spark, path, "a", "2026-03-02 00:20:00")
    assert {name: t.count() for name, t in found.extra.items()} == {"kept": 5, "none": 0} and found.rows.count() == 3
    assert plan_store.load_plan(spark, path, "a", "2026-03-02 00:31:00") is None
    assert plan_store.expire_plans(spark, path, "2026-03-02 01:30:00") == ["2026-03-01"]
    assert commits.children(spark, f"{path}/rows") == ["day=2026-03-02"]


def test_plan_keys_tell_literals_apart():
    key = lambda text, **c: plan_store.plan_key("update", "Leads", text, c)
    assert key("a = 'X'", s=1) == key("  a =  'X' ", s=1)
    assert len({key("a = 'X'", s=1), key("a = 'x'", s=1), key("a = 'X'", s=2), key("a = 'X'", t=1)}) == 4


def test_envelopes_and_reports(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"status": 200, "body": {"data": [{"id": "1", "Owner": {"id": "9", "name": "x"}}, {"id": "2"}], "info": {"count": 2}}}))
    (folder / "b.json").write_text(json.dumps({"status": 204, "body": {}}))
    record = T.StructType([T.StructField("id", T.StringType()),
                           T.StructField("Owner", T.StructType([T.StructField("id", T.StringType())]))])
    for schema in (None, record):
        got = files.read_envelopes(spark, str(folder), schema=schema)
        assert sorted((r.id, r.Owner and r.Owner.id) for r in got.collect()) == [("1", "9"), ("2", None)]
    detail = spark.createDataFrame([("1",), ("2",)], "id string")
    for _ in range(2):
        where = files.write_report("scan", detail.groupBy().count(), detail, str(tmp_path), "20260302T043000Z")
    summary, rows = files.read_report(spark, where)
    assert (summary.head()["count"], rows.count()) == (2, 2)


def test_scrub(spark):
    df = spark.createDataFrame([
        ("20", "Ann", "ann@x", ("30", "Boss", "b@x"), [("20", "p"), ("40", "q"), ("x", "r"), ("50", "s")], "tok", 5),
        ("30", None, None, None, None, None, 6)],
        "id string, full_name string, Email string, Owner struct<id:string,name:string,email:string>, "
        "related array<struct<id:string,note:string>>, next_page_token string, n int")
    got = {r.n: r for r in scrub(df).collect()}
    one, two = got[5], got[6]
    assert (one.id, one.Owner.id, two.id) == ("id_1", "id_2", "id_2")
    assert (one.full_name, one.Email, one.Owner.name, one.Owner.email, one.next_page_token) == (
        "REDACTED", "redacted@example.com", "REDACTED", "redacted@example.com", "token_1")
    assert [(x.id, x.note) for x in one.related] == [("id_1", "p"), ("id_3", "q"), ("x", "r")]
    assert (two.full_name, two.Owner, two.related) == (None, None, None)


def test_a_table_may_lie_under_any_folder_name(spark, tmp_path):
    start = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    table = SnapshotTable.create(start, f"{tmp_path}/delta/cafe/table", "Deals")
    table.commit(table.stage(spark.createDataFrame([("1", "new")], start.schema)), table.version())
    assert {r.id: r.v for r in table.read().collect()} == {"1": "new", "2": "b"}
