"""Readers of a ledger entry's ``detail``, whose shape differs by writer.

``detail`` is JSON text (the exact bytes the hash chain covers).  It is parsed
once into a VARIANT; every reader returns null or an empty list for a shape it
does not understand, and never fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import iso_utc

ID_SOURCES = ("written", "before", "targets", "archive", "master_id", "losers")
_NO_TEXT = "cast(array() as array<string>)"
_NO_VARIANT = "cast(array() as array<variant>)"


def parsed(ledger: DataFrame, name: str = "d") -> DataFrame:
    """Add the parsed detail as a VARIANT column."""
    return ledger.withColumn(name, F.try_parse_json("detail"))


def text_at(d: Column, path: str) -> Column:
    return F.try_variant_get(d, path, "string")


def long_at(d: Column, path: str) -> Column:
    return F.try_variant_get(d, path, "bigint")


def flag_at(d: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(d, path, "boolean"), F.lit(False))


def list_at(d: Column, key: str) -> Column:
    """A list field as ARRAY<VARIANT>; empty when it is anything else."""
    return F.coalesce(F.try_variant_get(d, f"$.{key}", "array<variant>"), F.expr(_NO_VARIANT))


def names_at(d: Column, key: str) -> Column:
    return F.try_variant_get(d, f"$.{key}", "array<string>")


def rows_at(d: Column, key: str, fields: str) -> Column:
    """A list of objects as ARRAY<STRUCT<fields>>.  The cast is per element:
    whatever is not an object becomes null and does not harm its neighbours."""
    kind = f"array<struct<{fields}>>"
    return F.coalesce(F.try_variant_get(d, f"$.{key}", kind), F.expr(f"cast(array() as {kind})"))


def _bare_id(item: Column) -> Column:
    return F.when(F.schema_of_variant(item).isin("STRING", "BIGINT"), F.try_variant_get(item, "$", "string"))


def named_ids(rows: Column) -> Column:
    """Ids of the rows that carry one."""
    return F.transform(F.filter(rows, lambda x: F.coalesce(x["id"], F.lit("")) != ""), lambda x: x["id"])


def ids_from(d: Column, source: str) -> Column:
    """Record ids one detail field names, as ARRAY<STRING> without nulls."""
    if source == "master_id":
        one = text_at(d, "$.master_id")
        return F.when(F.coalesce(one, F.lit("")) != "", F.array(one)).otherwise(F.expr(_NO_TEXT))
    if source == "losers":
        found = F.transform(list_at(d, source), _bare_id)
    elif source == "targets":
        # objects by their id, everything else only if it is an id itself
        rows = rows_at(d, source, "id:string")
        mixed = F.zip_with(rows, list_at(d, source), lambda row, item: F.coalesce(
            F.when(row["id"] != "", row["id"]), F.when(row.isNull(), _bare_id(item))))
        found = F.when(F.exists(rows, lambda row: row.isNull()), mixed).otherwise(named_ids(rows))
    else:
        return named_ids(rows_at(d, source, "id:string"))
    return F.filter(found, lambda x: x.isNotNull())


def observed_ids(d: Column) -> Column:
    """Every record id an entry names, once each, in first-seen order."""
    return F.array_distinct(F.concat(*[ids_from(d, source) for source in ID_SOURCES]))


def written_rows(d: Column) -> Column:
    """ARRAY<STRUCT<id, modified_time>> of the rows a writer confirmed."""
    given = F.filter(rows_at(d, "written", "id:string,modified_time:string"),
                     lambda x: F.coalesce(x["id"], F.lit("")) != "")
    return F.transform(given, lambda x: F.struct(
        x["id"].alias("id"), iso_utc(x["modified_time"]).alias("modified_time")))


def flat_variant(item: Column) -> Column:
    """Text of one JSON value; an object that carries an id is that id."""
    return F.coalesce(F.try_variant_get(item, "$.id", "string"), F.try_variant_get(item, "$", "string"))


def flat_map(cells: Column) -> Column:
    """MAP<STRING, VARIANT> with every value as flat text."""
    return F.transform_values(cells, lambda _, item: flat_variant(item))


def map_at(d: Column, path: str) -> Column:
    """An object field as MAP<STRING, STRING> of flat values; null otherwise."""
    return flat_map(F.try_variant_get(d, path, "map<string,variant>"))


def entry_record_ids(ledger: DataFrame) -> DataFrame:
    """One row per (entry, record id), with the field that named it first."""
    def ranked(rank: int, source: str) -> Column:
        return F.transform(ids_from(F.col("d"), source),
                           lambda x: F.struct(x.alias("id"), F.lit(rank).alias("rank")))

    rows = F.concat(*[ranked(rank, source) for rank, source in enumerate(ID_SOURCES)])
    source_names = F.array(*[F.lit(source) for source in ID_SOURCES])
    return (parsed(ledger)
            .select("segment", "seq", "module", "outcome", F.inline(rows))
            .groupBy("segment", "seq", "module", "outcome", "id")
            .agg(F.min("rank").alias("rank"))
            .withColumn("source", F.get(source_names, F.col("rank")))
            .drop("rank"))
