from pyspark.sql import functions as F

from changeguard.operators import mutations as M

META = "module string, field string, system_mandatory boolean, required boolean, read_only boolean, pick_list_values array<string>"


def as_map(df, *cols):
    return {r.id: tuple(r[c] for c in cols) for r in df.collect()}


def test_create_validates_and_numbers(rows):
    meta = rows([("Deals", "name", True, False, False, None), ("Deals", "stage", False, False, False, ["open", "won"])], META)
    target = rows([("9", "old", "open"), ("x", "odd", None)], "id string, name string, stage string")
    new, results = M.create_rows(target, rows([(1, "a", "open"), (2, "", "open"), (3, "b", "lost"), (4, "c", None)],
                                              "row_id long, name string, stage string"), meta, "Deals")
    assert as_map(new, "name", "stage") == {"9": ("old", "open"), "x": ("odd", None), "10": ("a", "open"), "11": ("c", None)}
    assert {(r.row_id, r.id, r.code, r.field) for r in results.collect()} == {
        (1, "10", "SUCCESS", None), (2, None, "MANDATORY_NOT_FOUND", "name"), (3, None, "INVALID_DATA", "stage"), (4, "11", "SUCCESS", None)}


def test_a_given_null_overwrites_and_an_absent_one_does_not(rows):
    target = rows([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "z")], "id string, name string, stage string")
    updates = rows([("1", None, "n", ["name"]), ("2", "B", None, ["name", "stage"]), ("2x", "?", "?", ["name"]), (None, "?", "?", [])],
                   "id string, name string, stage string, given array<string>")
    new, results = M.update_rows(target, updates, ["name", "stage"], "given")
    assert as_map(new, "name", "stage") == {"1": (None, "x"), "2": ("B", None), "3": ("c", "z")}
    assert {(r.id, r.code) for r in results.collect()} == {
        ("1", "SUCCESS"), ("2", "SUCCESS"), ("2x", "INVALID_DATA"), (None, "MANDATORY_NOT_FOUND")}


def test_an_id_asked_twice_is_rejected_not_doubled(rows):
    target = rows([("1", "a"), ("2", "b")], "id string, name string")
    new, results = M.update_rows(target, rows([("1", "x"), ("1", "y"), ("2", "z")], "id string, name string"), ["name"])
    assert as_map(new, "name") == {"1": ("a",), "2": ("z",)} and new.count() == 2
    assert {(r.id, r.code, r.rows) for r in results.collect()} == {("1", "DUPLICATE_DATA", 2), ("2", "SUCCESS", 1)}


def test_upsert_is_safe_to_run_again(rows):
    target = rows([("1", "a@x", "old", None)], "id string, email string, stage string, modified_time string")
    incoming = rows([(1, "a@x", "new"), (2, "b@x", "new"), (3, "b@x", "other"), (4, "a@x", "third")], "row_id long, email string, stage string")
    once, results = M.upsert_rows(target, incoming, ["email"], ["email", "stage"])
    assert as_map(once, "email", "stage") == {"1": ("a@x", "new"), "2": ("b@x", "new")}
    assert {(r.row_id, r.code) for r in results.collect()} == {(1, "SUCCESS"), (2, "SUCCESS"), (3, "DUPLICATE_DATA"), (4, "DUPLICATE_DATA")}
    twice, _ = M.upsert_rows(once, incoming, ["email"], ["email", "stage"])
    assert sorted(twice.collect()) == sorted(once.collect())


def test_deleted_rows_wait_in_the_bin(rows):
    target = rows([("1", "a"), ("2", "b")], "id string, name string")
    rest, binned = M.delete_rows(target, rows([("2",), ("9",)], "id string"), "2026-01-01 00:00:00")
    assert as_map(rest, "name") == {"1": ("a",)}
    assert [(r.id, str(r.expires_at)) for r in binned.collect()] == [("2", "2026-03-02 00:00:00")]
    back = M.restore_rows(rest, binned, rows([("2",)], "id string"), "2026-02-01 00:00:00")
    assert as_map(back, "name") == {"1": ("a",), "2": ("b",)}
    assert M.restore_rows(rest, binned, rows([("2",)], "id string"), "2026-04-01 00:00:00").count() == 1


def test_merge_moves_children_and_keeps_what_only_losers_had(rows):
    people = rows([("1", "Ann", None), ("2", "Anna", "z@x"), ("3", None, "y@x"), ("4", "Bob", None)], "id string, name string, email string")
    kids = rows([("2", "n1"), ("3", "n2"), ("4", "n3")], "parent_id string, title string")
    pairs = rows([("1", "2"), ("1", "3")], "master_id string, loser_id string")
    new, moved, archive = M.merge_rows(people, kids, pairs)
    assert as_map(new, "name", "email") == {"1": ("Ann", "z@x"), "4": ("Bob", None)}
    assert {(r.parent_id, r.title) for r in moved.collect()} == {("1", "n1"), ("1", "n2"), ("4", "n3")}
    assert as_map(archive, "master_id", "name") == {"2": ("1", "Anna"), "3": ("1", None)}
    plain, *_ = M.merge_rows(people, kids, pairs, fill_from_loser=False)
    assert as_map(plain, "email")["1"] == (None,)


def test_convert_leads(rows):
    leads = rows([("1", "Ann", "7", False), ("2", "Bob", "7", False), ("3", "Cy", "7", True)], "id string, name string, owner_id string, converted boolean")
    asked = rows([("1", None, ("D", "2026-01-01", "Open")), ("2", "8", ("D", None, "Open")), ("3", None, None), ("4", None, None)],
                 "lead_id string, assign_to string, deal struct<Deal_Name:string,Closing_Date:string,Stage:string>")
    contacts, accounts, deals, results = M.convert_leads(leads, asked, {"contact": {"Last_Name": "name"}, "account": {"Account_Name": "name"}})
    assert as_map(contacts, "lead_id", "Last_Name", "owner_id") == {"contact-1": ("1", "Ann", "7")}
    assert accounts.count() == 1 and as_map(deals, "Deal_Name", "account_id") == {"deal-1": ("D", "account-1")}
    assert {r.lead_id: (r.code, r.message) for r in results.collect()} == {
        "1": ("SUCCESS", None), "2": ("MANDATORY_NOT_FOUND", "deal needs Closing_Date"),
        "3": ("DUPLICATE_DATA", "already converted"), "4": ("INVALID_DATA", "no such lead")}


def test_notes_are_trimmed_and_cut(rows):
    notes = rows([("1", "old")], "parent_id string, content string")
    out = M.add_notes(notes, rows([("1", "  hi \n"), ("1", " \n "), ("2", "a" * 40000), ("3", None)], "parent_id string, content string"))
    assert sorted((r.parent_id, len(r.content)) for r in out.collect()) == [("1", 2), ("1", 3), ("2", 32000)]


def test_write_summary_counts_rows_not_calls(rows):
    schema = "batch int, row_id int, code string, id string, modified_time string"
    mixed = rows([(1, 1, "SUCCESS", "1", "2026-01-01T00:00:00Z"), (1, 2, "SUCCESS", "2", None), (1, 3, "INVALID_DATA", None, None), (2, 4, None, None, None)], schema)
    row = M.write_summary(mixed).head()
    assert (row.succeeded, row.failed, row.written, row.refused) == (2, 2, 1, False)
    assert [r.row_id for r in M.first_errors(mixed, 1).collect()] == [3]
    assert [r.id for r in M.written_of(mixed).collect()] == ["1"]
    assert M.write_summary(mixed.where("code is null")).head().refused
    assert not M.write_summary(mixed.where(F.lit(False))).head().refused
