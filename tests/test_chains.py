import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_details import book

from changeguard.operators import chains, fingerprints

N = 12


@pytest.fixture(scope="module")
def chained(spark):
    entries = book(spark, *[("applied", {"records": i}) for i in range(N)])
    entries = entries.withColumn("segment", F.floor((F.col("seq") - 1) / 5).cast("bigint")).withColumn(
        "seq", (F.col("seq") - 1) % 5 + 1)
    return chains.chain_entries(entries).cache()


def why(df, segments):
    return {(r.segment, r.seq): r.why for r in chains.verify_chain(df, segments).where("not ok").collect()}


def test_an_untouched_chain_holds(chained):
    segments = chains.segment_table(chained)
    assert why(chained, segments) == {}
    row = chains.verify_ledger(chained, segments).head()
    assert (row.intact, row.verified, row.broken_segment, row.applied) == (True, N, None, N)


@pytest.mark.parametrize("k", [0, 4, 7, N - 1])
def test_an_edit_is_found_where_it_was_made(chained, k):
    segments = chains.segment_table(chained)
    at = (F.col("segment") == k // 5) & (F.col("seq") == k % 5 + 1)
    forged = chained.withColumn("detail", F.when(at, F.lit('{"records":99}')).otherwise(F.col("detail")))
    assert why(forged, segments) == {(k // 5, k % 5 + 1): "entry hash differs"}
    row = chains.verify_ledger(forged, segments).head()
    assert (row.intact, row.verified, row.broken_segment, row.broken_seq) == (False, k, k // 5, k % 5 + 1)


def test_a_rehashed_edit_breaks_the_next_link(chained):
    segments = chains.segment_table(chained)
    at = (F.col("segment") == 0) & (F.col("seq") == 2)
    edited = chained.withColumn("detail", F.when(at, F.lit("{}")).otherwise(F.col("detail")))
    forged = edited.withColumn("entry_hash", F.when(at, chains.link_hash(F.col("prev"), chains.entry_body(edited)))
                               .otherwise(F.col("entry_hash")))
    assert why(forged, segments) == {(0, 3): "previous hash differs"}


def test_a_removed_entry_leaves_a_gap_and_a_copied_one_a_clash(chained):
    segments = chains.segment_table(chained)
    assert why(chained.where("not (segment = 1 and seq = 3)"), segments) == {(1, 4): "predecessor missing"}
    assert why(chained.unionByName(chained.where("segment = 1 and seq = 3")), segments)[(1, 3)] == "position used twice"


def test_a_cut_tail_is_found_by_the_segment_table(chained):
    segments = chains.segment_table(chained)
    short = chained.where("not (segment = 1 and seq = 5)")
    assert why(short, segments) == {}
    ends = {r.segment: r.why for r in chains.verify_segments(chains.verify_chain(short, segments), short, segments).collect()}
    assert ends == {0: None, 1: "entry count differs", 2: None}
    whole = chained.where("segment <> 2")
    ends = {r.segment: r.why for r in chains.verify_segments(chains.verify_chain(whole, segments), whole, segments).collect()}
    assert ends[2] == "segment missing"


def test_a_wrong_start_is_a_broken_first_entry(chained):
    segments = chains.segment_table(chained).withColumn("chain_start", F.lit("sha256:other"))
    assert why(chained, segments) == {(s, 1): "previous hash differs" for s in range(3)}


def test_segments_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(chains, "SEGMENT_SIZE", 3)
    with pytest.raises(Exception, match="over 3"):
        chains.chain_entries(book(spark, *[("applied", {})] * 4)).count()


# --- fingerprints -----------------------------------------------------------

STATE = "id string, stage string, amount double, modified_time string"
BASE = [(str(i), f"s{i % 3}", i * 1.5, f"t{i}") for i in range(20)]


def digest(spark, data, module="Deals", guard=("stage", "amount", "modified_time")):
    return fingerprints.fingerprint_value(spark.createDataFrame(data, STATE), module, guard).digest


def test_a_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.createDataFrame(BASE, STATE)
    one = digest(spark, BASE)
    assert one.startswith("sha256:") and digest(spark, list(reversed(BASE))) == one
    assert fingerprints.fingerprint_value(df.repartition(7, "stage"), "Deals", ["amount", "modified_time", "stage"]).digest == one
    assert digest(spark, BASE, module="Leads") != one


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 19), st.integers(0, 3), st.sampled_from(["x", None]))
def test_any_edited_cell_moves_the_fingerprint(spark, row, cell, value):
    data = [list(r) for r in BASE]
    data[row][cell] = (-1.0 if value else None) if cell == 2 else (value or "y") if cell == 0 else value
    assert digest(spark, [tuple(r) for r in data]) != digest(spark, BASE)


def test_fingerprints_see_added_removed_and_repeated_rows(spark):
    one = digest(spark, BASE)
    assert digest(spark, BASE[1:]) != one and digest(spark, BASE + BASE[:1]) != one
    assert digest(spark, [("1", None, None, "a")]) != digest(spark, [("1", "", None, "a")])


def test_rows_without_an_id_are_counted(spark):
    row = fingerprints.fingerprint_value(spark.createDataFrame([(None, "a", 1.0, "t")], STATE), "Deals", ["stage"])
    assert (row.records, row.null_ids) == (1, 1)


def test_drift_names_the_rows(spark):
    now = [r for r in BASE if r[0] != "3"] + [("99", "s", 0.0, "t")]
    now = [(i, "won" if i == "5" else s, a, t) for i, s, a, t in now]
    drift = fingerprints.drift_rows(spark.createDataFrame(BASE, STATE), spark.createDataFrame(now, STATE), ["stage", "modified_time"])
    assert {(r.id, r.drift) for r in drift.collect()} == {("3", "removed"), ("99", "added"), ("5", "changed")}


def test_would_change_compares_references_by_id(spark):
    df = spark.createDataFrame([("1", ("7", "Ann")), ("2", ("8", "Bob")), ("3", None)], "id string, owner struct<id:string,name:string>")
    assert fingerprints.would_change(df, {"owner": {"id": "7"}}).head().would_change == 2
