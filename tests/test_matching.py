import pytest
from pyspark.sql import functions as F

from changeguard.operators import matching, quality, ranking, scans
from changeguard.plans.handover import handover_counts

EXISTING = [("1", "a@x", "100", "t1"), ("2", "b@x", "200", "t2"), ("3", "b@x", "300", "t3"), ("4", None, "a@x", "t4")]


def match(rows, incoming, fields):
    have = rows(EXISTING, "id string, email string, phone string, modified_time string")
    return {r.row_id: r for r in matching.upsert_match(rows(incoming, "row_id long, email string, phone string"), have, fields).collect()}


def test_first_check_field_that_hits_wins(rows):
    got = match(rows, [(1, "a@x", "200"), (2, "none", "200"), (3, None, None), (4, "zz", "a@x")], ["email", "phone"])
    assert (got[1].id, got[1].matched_on) == ("1", "email")
    assert (got[2].id, got[2].matched_on, got[2].matched_value) == ("2", "phone", "200")
    assert (got[3].action, got[3].id) == ("create", None)
    assert got[4].matched_on == "phone"
    assert match(rows, [(1, "a@x", "200")], ["phone", "email"])[1].id == "2"


def test_a_value_never_matches_under_another_field(rows):
    assert match(rows, [(1, "100", "zz")], ["email", "phone"])[1].action == "create"


def test_ambiguous_and_repeated_keys_are_reported(rows):
    got = match(rows, [(1, "b@x", None), (2, "new", "9"), (3, "new", "8")], ["email", "phone"])
    assert (got[1].id, got[1].candidates, got[1].duplicate_in_batch) == ("2", 2, False)
    assert got[2].duplicate_in_batch and got[3].duplicate_in_batch and got[2].action == "create"


def test_quotes_in_values_still_match(rows):
    have = rows([("1", "O'Neil", "t")], "id string, name string, modified_time string")
    got = matching.upsert_match(rows([(1, "O'Neil")], "row_id long, name string"), have, ["name"]).head()
    assert got.action == "update"


def test_check_key_fields(rows):
    ok, bad = matching.check_key_fields(rows([("a", "1"), (None, "2"), ("", None)], "email string, phone string"), ["email", "phone"])
    assert ok.count() == 1
    assert sorted(tuple(r.missing_keys) for r in bad.collect()) == [("email",), ("email", "phone")]


def test_merge_conflicts(rows):
    people = rows([("1", "555", None, "Ann", ["a"], "t1", "x"), ("2", "777", "z@x", "Ann", [], "t2", "y"), ("3", None, "", "Bob", None, None, None)],
                  "id string, Phone string, Email string, Name string, Tags array<string>, Modified_Time string, `$editable` string")
    pairs = rows([("1", "2"), ("2", "3")], "master_id string, loser_id string")
    got = {(r.loser_id, r.field, r.kind, r.master, r.loser) for r in matching.merge_conflicts(pairs, people).collect()}
    assert got == {("2", "Phone", "conflict", "555", "777"), ("2", "Email", "only_on_loser", None, "z@x"),
                   ("2", "Modified_Time", "system", "t1", "t2"), ("2", "$editable", "system", "x", "y"),
                   ("3", "Name", "conflict", "Ann", "Bob")}


def test_pairs_that_cannot_be_merged(rows):
    pairs = rows([("1", "2"), ("3", "3"), ("4", "5"), ("6", "5"), ("7", "1"), ("8", "9"), ("8", "9"), ("a", " "), (None, "b")]
                 + [("m", f"l{i}") for i in range(4)], "master_id string, loser_id string")
    got = {(r.master_id, r.loser_id): r.reason for r in matching.check_merge_pairs(pairs).collect()}
    assert got[("1", "2")] is None and got[("3", "3")] == "record merged into itself"
    assert got[("4", "5")] == got[("6", "5")] == "loser of two masters"
    assert got[("7", "1")] == "loser is itself a master" and got[("8", "9")] == "loser repeated"
    assert got[("a", "")] == "blank id" and got[("m", "l0")] == "too many losers"
    assert matching.check_merge_pairs(pairs, None).where("master_id = 'm' and reason is not null").count() == 0


def test_unreadable_lists_are_unknown_not_empty(rows):
    notes = rows([("1", f"t{i}") for i in range(9, 0, -1)], "parent_id string, title string")
    got = {(r.id, r.list): (r["count"], r.titles) for r in matching.related_counts(
        rows([("1",), ("2",)], "id string"), {"Notes": notes, "Calls": None}).collect()}
    assert got == {("1", "Notes"): (9, ["t1", "t2", "t3", "t4", "t5"]), ("2", "Notes"): (0, None),
                   ("1", "Calls"): (None, None), ("2", "Calls"): (None, None)}
    none = matching.related_counts(rows([("1",)], "id string"), {"Calls": None}).head()
    assert none["count"] is None


def test_merge_totals_take_unknown_as_nothing(rows):
    conflicts = rows([("conflict",), ("conflict",), ("system",)], "kind string")
    related = rows([("1", 3), ("2", None)], "id string, count long")
    row = matching.merge_totals(conflicts, related).head()
    assert (row.conflicting_fields, row.system_fields_differing, row.related_records_moving) == (2, 1, 3)


# --- users, scans -----------------------------------------------------------

def test_resolve_user(rows):
    users = rows([("100", "Ann Leaver", "ann@x"), ("200", "Bob Taker", "bob@x"), ("300", "Bobby", None)],
                 "id string, full_name string, email string")
    asked = rows([("100",), ("ANN@X",), ("bob",), ("nobody",), ("y",), ("x bob",), (" Bobby ",)], "who string")
    got = {r.who: (r.user_id, r.n_matches) for r in scans.resolve_user(users, asked).collect()}
    assert got == {"100": ("100", 1), "ANN@X": ("100", 1), "bob": (None, 2), "nobody": (None, 0), "y": ("300", 1),
                   "x bob": ("200", 1), "Bobby": ("300", 1)}


def test_substrings_of_many_requests(rows):
    names = [f"{a}{b}{c}" for a in "abÉ" for b in "abc" for c in "ab"] + ["", None]
    users = rows([(str(i), n, f"{n}@X" if i % 2 else None) for i, n in enumerate(names)], "id string, full_name string, email string")
    asked = sorted({n[i:j] for n in names[:-2] for i in range(3) for j in range(i + 1, 4)} | {"@x", "zz", "3", " aa"})
    texts = [(str(i), f"{f'{n}@X' if i % 2 else ''} {n or ''}".lower()) for i, n in enumerate(names)]
    want = {}
    for who in asked:
        held = [i for i, t in texts if who.strip().lower() in t]
        want[who.strip()] = ("3", 1) if who == "3" else (held[0] if len(held) == 1 else None, len(held))
    for block_bytes in (1 << 20, 100):
        found = scans.resolve_user(users, rows([(w,) for w in asked], "who string"), block_bytes).collect()
        assert {r.who: (r.user_id, r.n_matches) for r in found} == want


def test_a_scan_that_ends_on_the_cap_is_complete(rows):
    df = rows([(i % 2, i) for i in range(10)], "g int, v int")
    for cap, more in ((10, False), (9, True), (11, False)):
        got, truncated = scans.scan_capped(df, [F.col("v")], cap)
        assert got.count() == min(cap, 10) and truncated.head().truncated is more
    got, truncated = scans.scan_capped(df, [F.col("v")], 4, ["g"])
    assert got.count() == 8 and all(r.truncated for r in truncated.collect())
    with pytest.raises(scans.SetTooLarge):
        scans.scan_complete(df, 9)
    assert scans.scan_complete(df, 10).count() == 10


def test_large_caps_are_cut_in_salted_groups(spark):
    df = spark.range(5000).selectExpr("0 as g", "id as v")
    got = ranking.top_per_group(df, ["g"], [F.col("v")], 2500)
    assert got.count() == 2500 and got.agg(F.max("v")).head()[0] == 2499 and got.agg(F.max("rank")).head()[0] == 2500


def test_dense_index_counts_without_gaps(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as g", "cast(999 - id as string) as k").repartition(7)
    got = ranking.dense_index(df, ["id"], "n").collect()
    assert all(r.n == r.id for r in got)
    by = ranking.dense_index(df, ["id"], "n", by=["g"]).collect()
    assert all(r.n == r.id // 3 for r in by)
    assert {r.batch for r in matching.batch_index(df.select("id"), ["id"], 100).collect()} == set(range(10))


def test_search_only_reads(rows):
    df = rows([("1", "open"), ("2", None), ("3", "won")], "id string, stage string")
    assert [r.id for r in scans.search({"deals": df}, "select id from {deals} where stage not in ('won')").collect()] == ["1"]
    with pytest.raises(ValueError):
        scans.search({"deals": df}, "delete from {deals}")


def test_pages(rows):
    df = rows([(str(i), i) for i in range(1, 8)], "id string, n int")
    first = scans.list_records(df, ["id"], "n", True, 1, 3).collect()
    last = scans.list_records(df, ["id"], "n", True, 3, 3).collect()
    assert ([r.id for r in first], first[0].more_records) == (["7", "6", "5"], True)
    assert ([r.id for r in last], last[0].more_records) == (["1"], False)
    with pytest.raises(ValueError):
        scans.list_records(df, ["id"], "n", per_page=0)


def test_default_projection(rows):
    df = rows([("1", "a")], "id string, name string")
    meta = rows([("Things", 2, "name"), ("Things", 1, "id")], "module string, position int, field string")
    assert scans.default_projection(df, "Things", meta=meta).columns == ["id", "name"]
    assert scans.default_projection(df, "Things", ["name"]).columns == ["name"]
    with pytest.raises(ValueError):
        scans.default_projection(df, "Things")


def test_null_stage_is_neither_open_nor_closed(rows):
    df = rows([("1", "7", "open"), ("2", "7", "Closed Won"), ("3", "7", None), ("4", "8", "open")], "id string, owner_id string, stage string")
    assert [r.id for r in scans.owned_by(df, "7", scans.HANDOVER_CLOSED).collect()] == ["1"]
    assert scans.owned_by(df, "7").count() == 3
    row = handover_counts({"Deals": df}, "7").head()
    assert (row.owned, row.closed_excluded, row.calls_required) == (1, 2, 1)


# --- quality ----------------------------------------------------------------

NOW = "2026-03-02 04:30:00"


def tables(spark, rows):
    leads = rows([("1", "9", "2025-01-01", None), ("2", "8", "2026-03-01", "a@x")], "id string, owner_id string, t string, email string")
    deals = rows([("5", "9", "2026-03-01", "Open", "2026-01-01"), ("6", "8", "2025-01-01", "Closed Won", "2026-01-01"),
                  ("7", "8", "2025-01-01", None, "2026-01-01")], "id string, owner_id string, t string, stage string, c string")
    stamp = lambda df: df.withColumn("modified_time", F.to_timestamp("t"))
    return {"Leads": stamp(leads), "Deals": stamp(deals).withColumn("closing_date", F.to_date("c")),
            "Contacts": rows([("8",)], "id string")}


def users(rows):
    return rows([("9", "Gone", "Inactive"), ("8", "Here", "ACTIVE"), ("7", "Unknown", None)], "id string, full_name string, status string")


def test_hygiene_finds_and_admits(spark, rows):
    counts, findings, _, unavailable = quality.hygiene_scan(tables(spark, rows), users(rows), NOW)
    assert {(r.check, r.id) for r in findings.collect()} == {
        ("stale_leads", "1"), ("leads_no_email", "1"), ("overdue_deals", "5"), ("orphaned_leads", "1"), ("orphaned_deals", "5")}
    assert {u[0] for u in unavailable} == {"contacts_no_email", "orphaned_contacts"}
    assert {(r.check, r["count"], r.fix_with) for r in counts.collect()} >= {("orphaned_leads", 1, "plan_handover"), ("stale_leads", 1, "plan_update")}


def test_hygiene_options(spark, rows):
    counts, _, sample, unavailable = quality.hygiene_scan(tables(spark, rows), None, NOW, include=["stale_leads", "orphaned_leads"], sample=0)
    assert [r.check for r in counts.collect()] == ["stale_leads"] and sample.count() == 0
    assert [u[0] for u in unavailable] == ["orphaned_leads"]
    extra = quality.Check("odd", "Leads", ("owner_id",), F.col("owner_id") == "9")
    counts, *_ = quality.hygiene_scan(tables(spark, rows), users(rows), NOW, extra_checks=[extra])
    assert "odd" in {r.check for r in counts.collect()}
    with pytest.raises(ValueError):
        quality.hygiene_scan(tables(spark, rows), None, NOW, stale_days=0)


def test_readiness(rows):
    meta = rows([("Deals", "Name", True, False, False), ("Deals", "Stage", False, True, False), ("Deals", "Sum", True, False, True),
                 ("Deals", "Gone", True, False, False), ("Leads", "Email", True, False, False)],
                "module string, field string, system_mandatory boolean, required boolean, read_only boolean")
    df = rows([("1", "a", "x", None), ("2", "", "x", "n")], "id string, Name string, Stage string, Note string")
    got = {r.id: r for r in quality.readiness(df, meta, "Deals", ["Note", "Nope"]).collect()}
    assert got["1"].missing_required == ["Gone"] and got["1"].missing_requested == ["Note: empty", "Nope: not a field"]
    assert got["2"].missing_required == ["Gone", "Name"] and not got["2"].ready
    ready = quality.readiness(df, meta.where("field <> 'Gone'"), "Deals").collect()
    assert {(r.id, r.ready) for r in ready} == {("1", True), ("2", False)}


def test_profile_fields(rows):
    meta = rows([("name",), ("gone",)], "field string")
    df = rows([("1", "b"), ("2", "a"), ("3", "b"), ("4", ""), ("5", None)], "id string, name string")
    got = {r.field: r for r in quality.profile_fields(df, meta, 2).collect()}
    assert (got["name"].rows, got["name"].nulls, got["name"].blanks, got["name"].distinct_values) == (5, 1, 2, 3)
    assert got["name"].top_values == ["b", ""] and got["gone"].rows is None
