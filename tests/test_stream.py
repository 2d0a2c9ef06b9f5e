from pyspark.sql import functions as F
from test_details import book

from changeguard.operators.changes import match_governed, read_changes
from changeguard.operators.ledgers import governed_keys
from changeguard.streaming import change_stream as S

FEED = "module string, id string, modified_raw string"
DATA = [("Leads", str(i % 5), f"2026-01-0{i % 4 + 1}T00:00:00Z" if i % 7 else "unreadable") for i in range(60)]


def ledger(spark):
    return book(spark, ("applied", {"written": [{"id": "1", "modified_time": "2026-01-02T00:00:00Z"}]}))


def run(spark, source, sink, position, books, per_trigger=1):
    stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", per_trigger).parquet(str(source))
    S.stream_changes(stream, lambda s: (books(s), None), str(sink), str(position)).awaitTermination()


def test_stream_equals_batch_and_delivers_once(spark, tmp_path):
    source, sink, position = tmp_path / "in", tmp_path / "out", tmp_path / "position"
    for part in range(3):
        spark.createDataFrame(DATA[part * 20:part * 20 + 20], FEED).coalesce(1).write.mode("append").parquet(str(source))
    run(spark, source, sink, position, ledger)
    got = {(r.change_ref, r.governed) for r in S.delivered_changes(spark, str(sink)).collect()}
    batch = match_governed(read_changes(spark.createDataFrame(DATA, FEED)), governed_keys(ledger(spark)))
    assert got == {(r.change_ref, r.governed) for r in batch.collect()}
    assert S.delivered_changes(spark, str(sink)).count() == len(got)
    assert any(ref.endswith("unreadable") for ref, _ in got) and ("Leads:1:2026-01-02T00:00:00Z", True) in got
    # late, repeated and new rows in a later run
    spark.createDataFrame(DATA[:10] + [("Leads", "9", "2025-01-01T00:00:00Z")], FEED).coalesce(1).write.mode("append").parquet(str(source))
    run(spark, source, sink, position, ledger)
    again = {r.change_ref for r in S.delivered_changes(spark, str(sink)).collect()}
    assert again - {ref for ref, _ in got} == {"Leads:9:2025-01-01T00:00:00Z"}
    assert S.delivered_changes(spark, str(sink)).count() == len(again)


def test_a_repeated_batch_replaces_its_own_rows(spark, tmp_path):
    batch = spark.createDataFrame(DATA, FEED)
    for _ in range(2):
        S.write_batch(batch, 0, str(tmp_path), lambda s: (ledger(s), None))
    rows = read_changes(batch).collect()
    # readable changes once each, and every unreadable one
    wanted = len({r.change_ref for r in rows if r.modified_at}) + sum(r.modified_at is None for r in rows)
    assert S.delivered_changes(spark, str(tmp_path)).count() == wanted


def test_equal_unreadable_changes_come_out_each_and_once(spark, tmp_path):
    source, sink, position = tmp_path / "in", tmp_path / "out", tmp_path / "position"

    def poll(*rows):
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(str(source))
        stream = S.with_poll(spark.readStream.schema(FEED).parquet(str(source)))
        S.stream_changes(stream, lambda s: (ledger(s), None), str(sink), str(position)).awaitTermination()
        return sorted((r.id, r.occurrence) for r in S.delivered_changes(spark, str(sink)).collect())

    two = [("Leads", "1", "soon"), ("Leads", "1", "soon"), ("Leads", "2", "2026-01-02T00:00:00Z")]
    assert poll(*two) == [("1", 1), ("1", 2), ("2", 1)]
    assert poll(*two) == [("1", 1), ("1", 2), ("2", 1)]  # the same poll again
    assert poll(*two[:2], two[0], ("Leads", "1", "later")) == [("1", 1), ("1", 1), ("1", 2), ("1", 3), ("2", 1)]


def test_windows_of_a_stream_equal_a_batch_and_tell_late_rows(spark, tmp_path):
    source, sink, position = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "position")
    parts = [[("Leads", "1", "2026-01-02T00:00:00Z"), ("Leads", "1", "2026-01-02T05:59:59Z"), ("Deals", "7", "no time")],
             [("Leads", "2", "2026-01-02T04:30:00Z"), ("Leads", "3", "2026-01-01T00:00:00Z"), ("Deals", "7", "no time")],
             [("Leads", "9", "1969-12-31T23:30:00Z")]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, FEED).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(FEED).parquet(str(source))
        S.stream_window_counts(stream, lambda s: (ledger(s), None), sink, position, "1 hour", "2 hours").awaitTermination()
        seen = spark.createDataFrame([r for p in parts[:n + 1] for r in p], FEED)
        batch = S.window_counts(match_governed(read_changes(seen), governed_keys(ledger(spark))), "1 hour")
        key = lambda r: str(tuple(r))
        assert sorted(S.counted_windows(spark, sink).collect(), key=key) == sorted(batch.collect(), key=key)
    assert sorted(r.id for r in S.late_changes(spark, sink).collect()) == ["3", "9"]
    # a repeated batch replaces its own part
    before = sorted(map(str, S.counted_windows(spark, sink).collect()))
    S.write_window_batch(spark.createDataFrame(parts[2], FEED), 2, sink, lambda s: (ledger(s), None), "1 hour", "2 hours")
    assert sorted(map(str, S.counted_windows(spark, sink).collect())) == before


def test_an_approval_that_came_late_settles_the_change(spark, tmp_path):
    batch = spark.createDataFrame(DATA, FEED)
    S.write_batch(batch, 0, str(tmp_path), lambda s: (ledger(s).limit(0), None))
    assert S.delivered_changes(spark, str(tmp_path)).where("governed").count() == 0
    settled = S.settled_changes(spark, str(tmp_path), lambda s: (ledger(s), None))
    assert [r.change_ref for r in settled.where("governed").collect()] == ["Leads:1:2026-01-02T00:00:00Z"]


def test_window_counts_on_a_stream(spark, tmp_path):
    spark.createDataFrame(DATA, FEED).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = read_changes(spark.readStream.schema(FEED).parquet(str(tmp_path / "in"))).withColumn("governed", F.col("id") == "1")
    query = (S.window_counts(stream, "1 day", "1 hour").writeStream.outputMode("complete").format("memory")
             .queryName("windows").trigger(availableNow=True).start())
    query.awaitTermination()
    batch = S.window_counts(read_changes(spark.createDataFrame(DATA, FEED)).withColumn("governed", F.col("id") == "1"), "1 day")
    assert sorted(map(str, spark.table("windows").collect())) == sorted(map(str, batch.collect()))
