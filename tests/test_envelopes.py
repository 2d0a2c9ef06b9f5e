import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from changeguard.sources import envelopes as E
from changeguard.sources.files import read_envelopes, write_report

SCHEMA = "id string, n long, at timestamp, day date, amount decimal(12,2), tags array<string>, owner struct<id:string,name:string>, ratio double, ok boolean"


def data(n):
    return [(str(i) if i % 5 else None, i, datetime.datetime(2026, 1, 1, 0, i % 60, 1, 5), datetime.date(2026, 2, 1 + i % 28),
             decimal.Decimal(i) / 4, ["é", None] if i % 2 else None, (str(i), None) if i % 3 else None, i / 7, i % 2 == 0) for i in range(n)]


def test_round_trip_by_pages(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    E.write_envelopes(rows(data(95), SCHEMA), path, page_rows=10)
    pages = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("*.json")]
    assert max(len(p["body"]["data"]) for p in pages) == 10 and {p["status"] for p in pages} == {200}
    back = E.load_envelopes(spark, path, SCHEMA)
    assert sorted(back.collect(), key=lambda r: r.n) == sorted(rows(data(95), SCHEMA).collect(), key=lambda r: r.n)
    E.write_envelopes(rows(data(3), SCHEMA), path)
    assert E.load_envelopes(spark, path, SCHEMA).count() == 98
    E.write_envelopes(rows(data(4), SCHEMA), path, mode="overwrite")
    assert E.load_envelopes(spark, path, "n long, status long").agg(F.sum("n"), F.max("status")).head()[:] == (6, 200)
    assert read_envelopes(spark, path + "/page-*.json").count() == 102  # files of earlier runs stay


def test_a_failed_write_leaves_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    E.write_envelopes(rows(data(5), SCHEMA), path)
    bad = rows(data(60), SCHEMA).repartition(4).withColumn("n", F.when(F.col("n") == 59, F.raise_error(F.lit("broken"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        E.write_envelopes(bad, path)
    assert E.load_envelopes(spark, path, SCHEMA).count() == 5
    (tmp_path / "out" / "page-of-a-lost-task.json").write_text('{"status":200,"body":{"data":[{"n":1}]}}')
    assert E.load_envelopes(spark, path, SCHEMA).count() == 5


def test_collected_responses_and_empty_tables(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('{"status":200,"body":{"items":[{"id":"1","x":{"y":1}},{"id":2}],"info":{}}}')
    (tmp_path / "b.json").write_text('{"status":204,"body":{"items":null}}')
    (tmp_path / "c.json").write_text('{"status":500}')
    got = E.load_envelopes(spark, str(tmp_path), "id string, x string, status int", "items").collect()
    assert sorted(map(tuple, got)) == [("1", '{"y": 1}', 200), ("2", None, 200)]
    E.write_envelopes(rows([], SCHEMA), str(tmp_path / "none"))
    assert E.load_envelopes(spark, str(tmp_path / "none"), SCHEMA).collect() == []


def test_reports_as_envelopes(spark, rows, tmp_path):
    detail = rows(data(7), SCHEMA).select("id", "n")
    for _ in range(2):
        folder = write_report("scan", detail.groupBy().count(), detail, str(tmp_path), "2026-01-01", E.register(spark))
    assert E.load_envelopes(spark, f"{folder}/detail", "id string, n long").count() == 7
    assert E.load_envelopes(spark, f"{folder}/summary", "count long").head()[0] == 7
