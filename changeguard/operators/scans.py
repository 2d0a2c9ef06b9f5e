"""Selections, predicates, pages and set operations over record tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeguard.errors import SetTooLarge
from changeguard.functions.scalars import as_column, days_ago, today
from changeguard.operators.ranking import top_per_group
from changeguard.operators.selection import rows_between
from changeguard.session import written

# Default columns per module when a caller names none.
DEFAULT_FIELDS = {
    "Leads": ("Last_Name", "First_Name", "Email", "Company", "Phone",
              "Lead_Status", "Lead_Source", "Owner", "Modified_Time"),
    "Contacts": ("Last_Name", "First_Name", "Email", "Phone", "Account_Name",
                 "Title", "Owner", "Modified_Time"),
    "Accounts": ("Account_Name", "Website", "Phone", "Industry",
                 "Billing_City", "Billing_Country", "Owner", "Modified_Time"),
    "Deals": ("Deal_Name", "Account_Name", "Stage", "Amount",
              "Closing_Date", "Probability", "Owner", "Modified_Time"),
}
# Closed stages, the longer list for handover, the shorter for hygiene.
HANDOVER_CLOSED = ("Closed Won", "Closed Lost", "Closed-Lost to Competition")
HYGIENE_CLOSED = ("Closed Won", "Closed Lost")
USER_KINDS = ("AllUsers", "ActiveUsers", "DeactiveUsers", "ConfirmedUsers", "NotConfirmedUsers",
              "DeletedUsers", "ActiveConfirmedUsers", "AdminUsers", "ActiveConfirmedAdmins", "CurrentUser")


# --- whole and capped scans -------------------------------------------------

def scan_capped(df: DataFrame, order: Sequence[Column], cap: int,
                by: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """First ``cap`` rows in a stated order, and whether more were waiting.

    Exactly ``cap`` rows with nothing behind them is complete, so one row more
    than the cap is looked at.
    """
    if not by:
        waiting = df.limit(cap + 1).agg((F.count("*") > cap).alias("truncated"))
        return df.orderBy(*order).limit(cap), waiting
    ranked = top_per_group(df, by, order, cap + 1)
    truncated = ranked.groupBy(*by).agg((F.max("rank") > cap).alias("truncated"))
    return ranked.where(F.col("rank") <= cap).drop("rank"), truncated


def require_at_most(df: DataFrame, n: int | None, what: str = "the set") -> DataFrame:
    """The whole set, or a refusal; never a part of it."""
    if n is not None and df.limit(n + 1).count() > n:
        raise SetTooLarge(f"{what} holds more than {n} rows; narrow it rather than act on a part")
    return df


def scan_complete(df: DataFrame, cap: int | None = None) -> DataFrame:
    return require_at_most(df, cap, "the scan")


def lookup_by_ids(df: DataFrame, ids: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*dict.fromkeys(["id", *cols])).join(ids.select("id"), "id", "left_semi").select(*cols)


def records_full(df: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All columns of the wanted records, and the ids that do not exist."""
    wanted = ids.select("id")
    return df.join(wanted, "id", "left_semi"), wanted.join(df.select("id"), "id", "left_anti")


def search(views: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """A read-only SELECT over named tables, written ``from {name}``."""
    if not sql.lstrip("( \n\t").lower().startswith("select"):
        raise ValueError("search reads only; write a SELECT")
    session = next(iter(views.values())).sparkSession
    return session.sql(sql, **views)


def page(df: DataFrame, order: Sequence[Column], offset: int, n: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


# Pages that begin further on are found by counting ranges of the sort key.
SEEK_FROM = 10_000


def list_records(df: DataFrame, fields: Sequence[str], sort_by: str, desc: bool = True,
                 number: int = 1, per_page: int = 50, seek_from: int = SEEK_FROM) -> DataFrame:
    """One page of a table with ``more_records`` on every row.

    A page far into the table costs a few counting passes and a sort of the
    range that holds it, instead of all the pages before it.
    """
    if per_page < 1 or number < 1:
        raise ValueError("pages have at least one row and are numbered from 1")
    key = F.col(sort_by).desc_nulls_last() if desc else F.col(sort_by).asc_nulls_last()
    kept, offset = df.select(*dict.fromkeys([*fields, sort_by, "id"])), (number - 1) * per_page
    if offset < seek_from:
        rows = page(kept, [key, F.col("id")], offset, per_page + 1)
    else:
        rows = rows_between(kept, [(sort_by, desc), ("id", False)], offset, offset + per_page + 1, small=seek_from)
    # at most per_page + 1 rows are left here
    position = F.row_number().over(Window.orderBy(key, F.col("id")))
    more = F.max("_position").over(Window.partitionBy()) > per_page
    return (rows.withColumn("_position", position).withColumn("more_records", more)
            .where(F.col("_position") <= per_page).select(*fields, "more_records"))


def default_projection(df: DataFrame, module: str, fields: Sequence[str] | None = None,
                       meta: DataFrame | None = None,
                       defaults: Mapping[str, Sequence[str]] = DEFAULT_FIELDS) -> DataFrame:
    """Asked-for columns, else the module's ``defaults``, else all described ones."""
    if fields:
        return df.select(*fields)
    if module in defaults:
        return df.select(*defaults[module])
    if meta is None:
        raise ValueError(f"no readable fields on {module}; name some")
    # at most one row per column of the table
    rows = (meta.where((F.col("module") == module) & F.col("field").isin(*df.columns)).groupBy("field")
            .agg(F.min("position").alias("position")).orderBy("position", "field").collect())
    if not rows:
        raise ValueError(f"no readable fields on {module}; name some")
    return df.select(*[row.field for row in rows])


def list_users(users: DataFrame, kind: str = "ActiveConfirmedUsers", me: str | None = None) -> DataFrame:
    """Users of one class, with role and profile flattened to their names."""
    if kind not in USER_KINDS:
        raise ValueError(f"unknown user class {kind!r}")
    status = F.lower("status")
    active, confirmed = status == "active", F.coalesce("confirm", F.lit(False))
    admin = F.col("profile.name") == "Administrator"
    keep = {
        "AllUsers": F.lit(True),
        "ActiveUsers": active,
        "DeactiveUsers": status == "inactive",
        "ConfirmedUsers": confirmed,
        "NotConfirmedUsers": ~confirmed,
        "DeletedUsers": status == "deleted",
        "ActiveConfirmedUsers": active & confirmed,
        "AdminUsers": admin,
        "ActiveConfirmedAdmins": active & confirmed & admin,
        "CurrentUser": F.col("id") == F.lit(me),
    }[kind]
    return users.where(keep).select("id", "full_name", "email", F.col("role.name").alias("role"),
                                    F.col("profile.name").alias("profile"), "status")


# --- predicates -------------------------------------------------------------

def open_stage(closed_stages: Iterable[str] | None, column: str = "stage") -> Column:
    """``NOT IN`` keeps its SQL reading: a null stage is not selected."""
    return ~F.col(column).isin(*closed_stages) if closed_stages else F.lit(True)


def owned_by(df: DataFrame, owner: str | DataFrame, closed_stages: Iterable[str] | None = None) -> DataFrame:
    """Records of one owner, or of every owner in a table with ``owner_id``."""
    kept = df.where(open_stage(closed_stages)) if closed_stages else df
    if isinstance(owner, DataFrame):
        return kept.join(owner.select("owner_id"), "owner_id", "left_semi")
    return kept.where(F.col("owner_id") == owner)


def stale_before(df: DataFrame, now: str, days: int, closed_stages: Iterable[str] | None = None) -> DataFrame:
    kept = df.where(F.col("modified_time") < days_ago(now, days))
    return kept.where(open_stage(closed_stages)) if closed_stages else kept


def overdue_open(df: DataFrame, now: str, closed_stages: Iterable[str] = HYGIENE_CLOSED) -> DataFrame:
    return df.where((F.col("closing_date") < today(now)) & open_stage(closed_stages))


def missing_value(df: DataFrame, field: str) -> DataFrame:
    return df.where(F.col(field).isNull())


def changed_since(df: DataFrame, since: str | None = None, at: str = "modified_at") -> DataFrame:
    """Strictly newer than ``since``.  A row whose time cannot be read is kept:
    what cannot be proved old must not be lost."""
    if since is None:
        return df
    mark = df.sparkSession.range(1).select(F.lit(since).try_cast("timestamp").alias("t")).head().t
    if mark is None:
        raise ValueError(f"since is not a timestamp: {since!r}")
    return df.where((F.col(at) > F.lit(since).cast("timestamp")) | F.col(at).isNull())


def order_changes(df: DataFrame, at: str = "modified_at") -> DataFrame:
    """Ascending, mandatory under a cap: otherwise older rows fall behind the mark."""
    return df.orderBy(F.col(at).asc_nulls_first(), "module", "id")


# --- users ------------------------------------------------------------------

# Requests that one automaton holds; more are looked up in further passes over the users.
NEEDLE_BYTES = 4 << 20


def _needle_hits(batches: Iterator[pa.RecordBatch], needles: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """(needle, n, least): how many of the partition's (user_id, text) hold each needle, and the least id of them."""
    automaton = ahocorasick.Automaton()
    for i, needle in enumerate(needles):
        automaton.add_word(needle, i)
    automaton.make_automaton()
    n, least = [0] * len(needles), [None] * len(needles)
    for batch in batches:
        for user, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for i in {i for _, i in automaton.iter(text)}:
                n[i] += 1
                if user is not None and (least[i] is None or user < least[i]):
                    least[i] = user
    hit = [i for i, count in enumerate(n) if count]
    yield pa.RecordBatch.from_arrays(
        [pa.array([needles[i] for i in hit], pa.string()), pa.array([n[i] for i in hit], pa.int64()),
         pa.array([least[i] for i in hit], pa.string())], names=["needle", "n", "least"])


def substring_hits(haystack: DataFrame, needles: DataFrame, block_bytes: int = NEEDLE_BYTES) -> DataFrame:
    """(needle, n_matches, only): for each needle, the rows of ``haystack`` (user_id, text) that hold it.

    A block of needles is one automaton, which finds all of them in a text at
    once.  Tasks add up their hits, so rows of the haystack are not shuffled,
    also not for a needle that all of them hold.
    """
    wanted = needles.select("needle").where(F.col("needle") != "").distinct()
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("needle") + 16), F.lit(0))).head()[0]
    blocks, found = max(1, -(-total // block_bytes)), None
    for k in range(blocks):
        part = [r.needle for r in wanted.where(F.pmod(F.xxhash64("needle"), F.lit(blocks)) == k).collect()]
        if not part:
            continue
        hits = haystack.select("user_id", "text").mapInArrow(
            lambda batches, part=part: _needle_hits(batches, part), "needle string, n long, least string")
        hits = hits if blocks == 1 else written(hits, "needle_hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return wanted.select("needle", F.lit(0).cast("long").alias("n_matches"), F.lit(None).cast("string").alias("only"))
    return found.groupBy("needle").agg(F.sum("n").alias("n_matches"), F.min("least").alias("only"))


def resolve_user(users: DataFrame, requests: DataFrame, block_bytes: int = NEEDLE_BYTES) -> DataFrame:
    """Each ``who`` to one user: exact id first, else the only case-insensitive
    substring match of e-mail and name.  ``user_id`` is null unless unique.

    Users are read once for a block of requests, whatever their substrings are.
    """
    asked = requests.select(F.trim("who").alias("who")).distinct()
    exact = asked.join(users.select(F.col("id").alias("who")).distinct(), "who", "left_semi")
    rest = (asked.join(exact, "who", "left_anti").where(F.col("who") != "")
            .withColumn("needle", F.lower("who")))
    text = F.lower(F.concat_ws(" ", F.coalesce("email", F.lit("")), F.coalesce("full_name", F.lit(""))))
    hits = substring_hits(users.select(F.col("id").cast("string").alias("user_id"), text.alias("text")), rest, block_bytes)
    found = rest.join(hits, "needle").select("who", F.when(F.col("n_matches") == 1, F.col("only")).alias("user_id"), "n_matches")
    by_id = exact.select("who", F.col("who").alias("user_id"), F.lit(1).cast("bigint").alias("n_matches"))
    return (asked.join(by_id.unionByName(found), "who", "left")
            .select("who", "user_id", F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches")))


def departed_users(users: DataFrame) -> DataFrame:
    return users.where(F.lower("status") != "active")


def orphaned_records(df: DataFrame, departed: DataFrame) -> DataFrame:
    """Records whose owner is a departed user."""
    return df.join(departed.select(F.col("id").alias("owner_id")), "owner_id", "left_semi")


# --- set operations ---------------------------------------------------------

def union_modules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per-module tables as one, tagged with their module."""
    parts = [df.withColumn("module", F.lit(name)) for name, df in tables.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def minus(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``; duplicates stay."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def exclude_delivered(changes: DataFrame, delivered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New changes, and how many were dropped as already delivered."""
    seen = delivered.select("change_ref")
    skipped = changes.join(seen, "change_ref", "left_semi").agg(F.count("*").alias("skipped"))
    return minus(changes, delivered, ["change_ref"]), skipped
