from pyspark.sql import functions as F

from changeguard.llm import exactdup

SCHEMA = "doc_id long, text string, digest string, norm string"


def docs(rows, texts):
    return rows([(i, t, "clash", None) for i, t in texts], SCHEMA)


def found(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_case_folds_only_ascii_and_null_is_empty(rows):
    table = docs(rows, [(1, "Abc Ä"), (2, "aBC Ä"), (3, "abc ä"), (4, None), (5, "")])
    assert found(exactdup.exact_copies(table)) == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True),
    ]


def test_repeated_rows_and_null_keys_keep_one(rows):
    out = exactdup.exact_copies(docs(rows, [(7, "x"), (7, "x"), (None, "y"), (None, "y")])).collect()
    assert sorted(r.group_size for r in out) == [2, 2, 2, 2]
    assert sum(r.kept for r in out if r.doc_id == 7) == 1
    assert sum(r.kept for r in out if r.doc_id is None) == 1
    assert all(r.keep_id is None for r in out if r.doc_id is None)


def test_empty_table(rows):
    assert exactdup.exact_copies(docs(rows, [])).count() == 0
    assert exactdup.drop_copies(docs(rows, [])).count() == 0


def test_texts_with_one_digest_are_told_apart(rows):
    weak = lambda text: F.substring(text, 1, 1)
    table = docs(rows, [(1, "apple"), (2, "Apple"), (3, "acorn"), (4, "bee"), (5, "avocado"), (6, "acorn")])
    assert found(exactdup.exact_copies(table, digest=weak)) == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 6, 2, False), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 2, True),
    ]


def test_hot_group_over_many_partitions(spark):
    table = spark.range(0, 3000, numPartitions=9).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "HOT text").otherwise(F.col("id").cast("string")).alias("text")
    )
    out = exactdup.exact_copies(table)
    assert out.filter("group_size = 1000").agg(F.count(F.lit(1)), F.max("keep_id"), F.count_if(F.col("kept"))).first()[:] == (1000, 2997, 1)
    assert out.filter("group_size = 1").count() == 2000


def test_drop_copies_keeps_columns_and_rows(rows):
    table = docs(rows, [(1, "x"), (2, "X"), (2, "X"), (3, None)])
    out = exactdup.drop_copies(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(2, "X"), (3, None)]
