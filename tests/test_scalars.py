from pyspark.sql import functions as F

from changeguard.functions import scalars


INSTANTS = [
    ("2026-08-08T16:44:05+05:30", "2026-08-08T11:14:05Z"),
    ("2026-08-08T16:44:05-05:30", "2026-08-08T22:14:05Z"),
    ("2026-08-08T16:44:05Z", "2026-08-08T16:44:05Z"),
    ("2026-08-08T16:44:05z", "2026-08-08T16:44:05Z"),
    (" 2026-08-08T16:44:05\n", "2026-08-08T16:44:05Z"),
    ("2026-01-01T00:00:00+05:30", "2025-12-31T18:30:00Z"),
    ("2026-08-08 16:44:05", None), ("2026-08-08", None), ("2026-02-30T00:00:00Z", None),
    ("2026-08-08T16:44:05+0530", None), ("unreadable", None), ("", None), (None, None),
]


def test_iso_utc(rows):
    df = rows(INSTANTS, "t string, expected string")
    got = df.select("t", scalars.iso_text(scalars.iso_utc("t")).alias("x")).collect()
    assert [(r.t, r.x) for r in got] == INSTANTS


def test_iso_utc_does_not_follow_the_session_zone(spark, rows):
    df = rows([("2026-08-08T16:44:05",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        seconds = df.select(F.unix_seconds(scalars.iso_utc("t")).alias("x")).head().x
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seconds == 1786207445


def test_flat_compares_a_reference_by_its_id(rows):
    df = rows([(("7", "Ann"), ("x", "y"), 1.5, None, [1, 2])],
              "a struct<id:string,name:string>, b struct<q:string,p:string>, c double, d string, e array<int>")
    row = df.select(*[scalars.flat(df, c).alias(c) for c in df.columns]).head()
    assert (row.a, row.b, row.c, row.d, row.e) == ("7", '{"p":"y","q":"x"}', "1.500000", None, "[1,2]")


def test_blank_is_null_empty_text_list_or_map(rows):
    df = rows([(None, [], {}, 0), ("", [1], {"a": "b"}, None), (" ", None, None, 5)],
              "s string, l array<int>, m map<string,string>, n int")
    got = [tuple(r) for r in df.select(*[scalars.is_blank(df, c) for c in df.columns]).collect()]
    assert got == [(True, True, True, False), (True, False, False, True), (False, True, True, False)]


def test_canonical_tells_a_null_from_a_missing_value(rows):
    df = rows([(None, "x"), ("x", None)], "a string, b string")
    texts = [r.c for r in df.select(scalars.canonical(df, ["b", "a"]).alias("c")).collect()]
    assert texts == ['{"a":null,"b":"x"}', '{"a":"x","b":null}']


def test_same_needs_columns_and_treats_nulls_as_equal(rows):
    df = rows([({"a": "1", "b": None}, {"a": "1", "b": None}, ["a", "b"]), ({"a": "1"}, {"a": "2"}, ["a"]),
               ({"a": "1"}, {"a": "1"}, []), (None, {"a": "1"}, ["a"]), ({}, {"a": None}, ["a"])],
              "cur map<string,string>, val map<string,string>, cols array<string>")
    got = [r.x for r in df.select(scalars.same(F.col("cur"), F.col("val"), F.col("cols")).alias("x")).collect()]
    assert got == [True, False, False, False, True]


def test_moved_is_null_when_it_cannot_be_told(rows):
    df = rows([("2026-01-01T00:00:00+05:30", "2025-12-31T18:30:00Z"), ("2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z"),
               (None, "2026-01-01T00:00:00Z"), ("2026-01-01T00:00:00Z", "soon")], "a string, b string")
    got = [r.x for r in df.select(scalars.moved(scalars.iso_utc("a"), scalars.iso_utc("b")).alias("x")).collect()]
    assert got == [False, True, None, None]


def test_change_ref_names_the_change(rows):
    df = rows([("Leads", "1", "2026-01-01T05:30:00+05:30"), ("Leads", "1", "soon")], "m string, i string, t string")
    got = [r.x for r in df.select(scalars.change_ref("m", "i", scalars.iso_utc("t")).alias("x")).collect()]
    assert got == ["Leads:1:2026-01-01T00:00:00Z", "Leads:1:unreadable"]


FIELDS = [
    ("id", True), ("Tag", True), ("$anything", True), ("Modified_Time", True), ("Change_Log_Time__s", True),
    ("Created_By", True), ("Record_Image", True), ("Locked__s", True), ("Phone", False), ("Timeline", False),
    ("Time_Zone", False), ("Owner", False)]


def test_ignorable_fields(rows):
    df = rows(FIELDS, "f string, expected boolean")
    assert [(r.f, r.x) for r in df.select("f", scalars.ignorable_field("f").alias("x")).collect()] == FIELDS
    assert [(name, scalars.is_ignorable(name)) for name, _ in FIELDS] == FIELDS


def test_usable_written(rows):
    df = rows([([("1", "t"), ("2", None), (None, "t"), ("", "t")],), ([("2", None)],), ([],), (None,)],
              "w array<struct<id:string,modified_time:string>>")
    got = [r.x for r in df.select(scalars.usable_written(F.col("w")).alias("x")).collect()]
    assert [g and [tuple(x) for x in g] for g in got] == [[("1", "t")], None, None, None]


def test_valid_id_and_clip(rows):
    df = rows([("12",), (" 7 ",), ("x1",), ("",), (None,)], "id string")
    assert [r.x for r in df.select(scalars.valid_id("id").alias("x")).collect()] == [True, True, False, False, False]
    assert rows([("a" * 40000,)], "t string").select(F.length(scalars.clip("t")).alias("n")).head().n == 32000


def test_days_ago_is_utc_whatever_the_zone(rows):
    df = rows([(1,)], "x int").select(scalars.iso_text(scalars.days_ago("2026-03-02 04:30:00", 90)).alias("t"))
    assert df.head().t == "2025-12-02T04:30:00Z"
