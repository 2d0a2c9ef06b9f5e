"""Column expressions shared by every operator.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of fields the system stamps itself.  Names that start with
# "$" or end in "_Time" / "_Time__s" are covered by shape and not listed.
SYSTEM_FIELDS = ("id", "Created_By", "Modified_By", "Record_Image", "Locked__s", "Tag")

ISO_SHAPE = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(Z|[+-]\d\d:\d\d)?$"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
NOTE_LIMIT = 32000


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def iso_utc(value: Column | str) -> Column:
    """Text with an optional offset to an instant; anything unreadable is null.

    No offset means UTC, whatever the session zone is.
    """
    text = F.upper(F.btrim(as_column(value), F.lit(" \t\n\r\v\f")))
    zoned = F.when(F.length(text) == 19, F.concat(text, F.lit("Z"))).otherwise(text)
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(zoned))


def iso_text(value: Column | str) -> Column:
    return F.date_format(as_column(value), ISO_FORMAT)


def flat(df: DataFrame, name: str) -> Column:
    """One value as text: a reference by its id, everything else unambiguously."""
    return flat_value(F.col(name), df.schema[name].dataType)


def flat_value(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        if "id" in kind.fieldNames():
            return column.getField("id").cast("string")
        parts = [flat_value(column.getField(f.name), f.dataType).alias(f.name)
                 for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(column.isNotNull(), F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # a fixed scale keeps the text the same on every engine
        exact = column.try_cast("decimal(38,6)").cast("string")
        return F.coalesce(exact, column.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, ISO_MICROS)
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)), {"ignoreNullFields": "false"})
    if isinstance(kind, T.ArrayType):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column.cast("string")


def is_blank(df: DataFrame, name: str) -> Column:
    """Null, empty text, empty list or empty map."""
    return blank_value(F.col(name), df.schema[name].dataType)


def blank_value(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.coalesce(column == "", F.lit(True))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(column) <= 0, F.lit(True))
    return column.isNull()


def canonical(df: DataFrame, cols: Iterable[str]) -> Column:
    """Chosen columns as one JSON text: sorted names, explicit nulls, flat values."""
    parts = [flat(df, name).alias(name) for name in sorted(set(cols))]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def state_map(df: DataFrame, cols: Iterable[str]) -> Column:
    """Chosen columns as MAP<name, flat value>; nulls kept as null values."""
    cells: list[Column] = []
    for name in sorted(set(cols)):
        cells += [F.lit(name), flat(df, name)]
    if not cells:
        return F.expr("cast(map() as map<string,string>)")
    return F.create_map(*cells)


def change_ref(module: Column | str, record_id: Column | str, at: Column | str,
               raw: Column | str | None = None) -> Column:
    """Names a change, not a record: the same record edited twice is two refs.

    A time that cannot be read is named by its text, if ``raw`` gives it."""
    unread = F.lit("unreadable")
    if raw is not None:
        unread = F.concat_ws(":", unread, as_column(raw))
    return F.concat_ws(":", as_column(module), as_column(record_id), F.coalesce(iso_text(at), unread))


def moved(before: Column | str, now: Column | str) -> Column:
    """True, false, or null when either instant is unreadable."""
    return as_column(before) != as_column(now)


def same(current: Column, values: Column, columns: Column) -> Column:
    """Do two state maps agree on every named column?  No columns is false."""
    empty = F.expr("cast(map() as map<string,string>)")
    left, right = F.coalesce(current, empty), F.coalesce(values, empty)
    agree = F.forall(columns, lambda k: F.try_element_at(left, k).eqNullSafe(F.try_element_at(right, k)))
    return F.coalesce((F.size(columns) > 0) & agree, F.lit(False))


def intent_of(entry: Column, target: Column) -> Column:
    """A target's own intent, else the entry's, else nothing."""
    return F.coalesce(target, entry, F.expr("cast(map() as map<string,string>)"))


def days_ago(now: Column | str, days: int) -> Column:
    base = F.lit(now).cast("timestamp") if isinstance(now, str) else now
    return base - F.make_dt_interval(days=F.lit(days))


def today(now: Column | str) -> Column:
    return F.to_date(F.lit(now).cast("timestamp") if isinstance(now, str) else now)


def clip(text: Column | str, limit: int = NOTE_LIMIT) -> Column:
    return F.substring(as_column(text), 1, limit)


def valid_id(value: Column | str) -> Column:
    return F.coalesce(F.trim(as_column(value).cast("string")).rlike("^[0-9]+$"), F.lit(False))


def ignorable_field(field: Column | str, names: Iterable[str] = SYSTEM_FIELDS) -> Column:
    """System fields nobody can act on, by name or by shape."""
    name = as_column(field)
    return (name.isin(*names) | name.startswith("$")
            | name.endswith("_Time") | name.endswith("_Time__s"))


def is_ignorable(name: str, names: Iterable[str] = SYSTEM_FIELDS) -> bool:
    """The same rule for a column name known while the plan is built."""
    return name in set(names) or name.startswith("$") or name.endswith(("_Time", "_Time__s"))


def usable_written(written: Column) -> Column:
    """Written rows a later read can match; null when none is left."""
    kept = F.filter(written, lambda x: (F.coalesce(x["id"], F.lit("")) != "")
                    & (F.coalesce(x["modified_time"].cast("string"), F.lit("")) != ""))
    return F.when(F.size(kept) > 0, kept)
