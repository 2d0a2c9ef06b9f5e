"""Replace sensitive values so that rows can be shown outside."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.operators.ranking import dense_index

# Keys whose text is hidden, and what stands in for it.
SCRUB_KEYS = ("email", "primary_email", "Email", "Secondary_Email", "phone",
              "Phone", "Mobile", "company_name", "Website", "zgid", "zuid",
              "mc_status", "Owner_Email", "name", "first_name", "last_name",
              "full_name", "domain_name", "primary_zuid", "next_page_token")
MASK, MASK_EMAIL, MASK_TOKEN = "REDACTED", "redacted@example.com", "token_1"


def _stand_in(name: str) -> str:
    if "mail" in name.lower():
        return MASK_EMAIL
    return MASK_TOKEN if name == "next_page_token" else MASK


class _Walker:
    """Rebuilds a column by schema, hiding keys and swapping record ids.

    Ids inside lists have a fixed place too, because lists are cut short.
    """

    def __init__(self, keys: Iterable[str], list_keep: int, swapped: dict[str, Column] | None = None):
        self.keys, self.list_keep = set(keys), list_keep
        self.swapped, self.ids = swapped or {}, {}

    def _entry(self, key: Column, value: Column, kind: T.DataType) -> Column:
        """A map value: hidden under a sensitive key.  Ids in maps have no fixed place and stay."""
        if not isinstance(kind, T.StringType):
            return value
        shown = F.when(value.isNull(), value)
        for name in sorted(self.keys):
            shown = shown.when(key == name, F.lit(_stand_in(name)))
        return shown.otherwise(value)

    def visit(self, column: Column, kind: T.DataType, name: str, path: str) -> Column:
        if isinstance(kind, T.StringType):
            if name in self.keys:
                return F.when(column.isNotNull(), F.lit(_stand_in(name)))
            if name == "id":
                self.ids[path] = column
                return self.swapped.get(path, column)
            return column
        if isinstance(kind, T.StructType):
            parts = [self.visit(column.getField(f.name), f.dataType, f.name, f"{path}.{f.name}").alias(f.name)
                     for f in kind.fields]
            return F.when(column.isNotNull(), F.struct(*parts))
        if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            return F.transform_values(column, lambda k, v: self._entry(k, v, kind.valueType))
        if isinstance(kind, T.ArrayType):
            places = [self.visit(F.get(column, i), kind.elementType, "", f"{path}[{i}]")
                      for i in range(self.list_keep)]
            kept = F.slice(F.array(*places), 1, F.least(F.size(column), F.lit(self.list_keep)))
            return F.when(column.isNotNull(), kept)
        return column


def scrub(df: DataFrame, keys: Iterable[str] = SCRUB_KEYS, list_keep: int = 3) -> DataFrame:
    """Hide sensitive keys at any depth, shorten lists, rename numeric ids.

    The same id gets the same placeholder wherever it stands; placeholders are
    numbered in id order.  An id that is not a number stays.
    """
    finder = _Walker(keys, list_keep)
    for f in df.schema:
        finder.visit(F.col(f.name), f.dataType, f.name, f.name)
    if not finder.ids:
        return df.select(*[finder.visit(F.col(f.name), f.dataType, f.name, f.name).alias(f.name) for f in df.schema])
    every = df.select(F.explode(F.array_distinct(F.array(*finder.ids.values()))).alias("_id"))
    names = dense_index(every.where(F.col("_id").rlike("^[0-9]+$")).distinct(), ["_id"], "_i").select(
        "_id", F.concat(F.lit("id_"), (F.col("_i") + 1).cast("string")).alias("_name"))
    joined, swapped = df, {}
    for i, (path, column) in enumerate(finder.ids.items()):
        side = names.select(F.col("_id").alias(f"_id_{i}"), F.col("_name").alias(f"_name_{i}"))
        joined = joined.withColumn(f"_id_{i}", column).join(side, f"_id_{i}", "left")
        swapped[path] = F.coalesce(f"_name_{i}", f"_id_{i}")
    walker = _Walker(keys, list_keep, swapped)
    return joined.select(*[walker.visit(F.col(f.name), f.dataType, f.name, f.name).alias(f.name) for f in df.schema])
