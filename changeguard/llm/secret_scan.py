"""Secrets in texts, told apart by how many repositories and owners share a value.

Everything here is DataFrame expressions: spans are found with
``regexp_extract_all`` and placed by the lengths of what ``split`` leaves
between them, as both walk the same leftmost matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.session import written

# The kinds in their order, their patterns, the group that is the value, its least length.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
BARE = r"[A-Za-z0-9+/_.=-]{20,}"
KINDS = ("assign", "access", "hex", "bare")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

# A value that more owners than this share is an example that people copy.
MAX_OWNERS = 2

SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; inside a lambda an expression is computed for each element."""
    return F.transform(F.array(value), use)[0]


def _sum(numbers: Column, start: Column, count: Column) -> Column:
    return F.aggregate(F.slice(numbers, start, count), F.lit(0), lambda a, x: a + x)


def _sums_before(numbers: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use`` of a function that gives the sum of the first i numbers.

    Sums of blocks of about the square root of all are added up first, so the
    places of n matches take n times its root, not n times n.
    """
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(numbers))).cast("int"))

    def blocked(b: Column) -> Column:
        whole = lambda k: _sum(b["numbers"], k * b["size"] + 1, b["size"])
        block = lambda i: F.floor(i / b["size"]).cast("int")
        sums = F.transform(F.sequence(F.lit(0), block(F.size(b["numbers"]))), whole)
        before = lambda sums: F.transform(sums, lambda _, k: _sum(sums, F.lit(1), k))
        at = lambda before: lambda i: before[block(i)] + _sum(b["numbers"], block(i) * b["size"] + 1, i % b["size"])
        return _let(_let(sums, before), lambda before: use(at(before)))

    return _let(F.struct(numbers.alias("numbers"), size.alias("size")), blocked)


def _spans(text: Column, pattern: str, kind: str, least: int, group: int = 0) -> Column:
    """The matches of ``pattern`` whose ``group`` has ``least`` characters, with code point offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        F.transform(found, F.length).alias("lengths"),
        (found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("values"),
    )

    def placed(m: Column) -> Column:
        both = F.zip_with(m["gaps"], m["lengths"], lambda gap, length: gap + F.coalesce(length, F.lit(0)))
        span = lambda before: lambda value, i: F.struct(
            (before(i) + m["gaps"][i]).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            (before(i) + m["gaps"][i] + m["lengths"][i]).alias("end"),
            value.alias("value"),
        )
        return _sums_before(both, lambda before: F.transform(m["values"], span(before)))

    return F.filter(_let(parts, placed), lambda s: F.length(s["value"]) >= least)


def _none() -> Column:
    return F.array().cast(SPAN)


def base_spans(text: Column) -> Column:
    """Assignments, access keys and long hex strings, by start and then kind.

    Cheap tests come first, so that texts without any are passed over quickly.
    """
    lowered = F.lower(text)
    named = lowered.contains(NAMES[0])
    for name in NAMES[1:]:
        named = named | lowered.contains(name)
    return F.array_sort(
        F.concat(
            F.when(named, _spans(text, ASSIGN, "assign", 6, 2)).otherwise(_none()),
            F.when(text.contains("AKIA"), _spans(text, ACCESS, "access", 20)).otherwise(_none()),
            F.when(text.rlike(HEX), _spans(text, HEX, "hex", 24)).otherwise(_none()),
        )
    )


def bare_spans(text: Column) -> Column:
    """Long strings of key characters with a letter and a digit, whatever stands before them."""
    spans = F.when(text.rlike(BARE), _spans(text, BARE, "bare", 20)).otherwise(_none())
    return F.filter(spans, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))


def looks_live(value: Column) -> Column:
    """Long enough, with letters and digits, and no single character over and over."""
    return (
        (F.length(value) >= 16)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(r"(.)\1{5}")
        & ~F.lower(value).rlike("example|changeme|placeholder|xxxx|your[_-]")
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``candidates`` (hash, owner, repo, looks_live) to one row per hash: n_repos, n_owners, live.

    Counted in three steps that each combine before they shuffle, so a value
    that a third of all repositories hold stays a few rows per task.
    """
    repos = candidates.groupBy("hash", "owner", "repo").agg(F.max("looks_live").alias("looks_live"))
    owners = repos.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("looks_live").alias("looks_live"))
    return owners.groupBy("hash").agg(
        F.sum("repos").alias("n_repos"),
        F.count(F.lit(1)).alias("n_owners"),
        F.min("owner").alias("first_owner"),
        F.max("looks_live").alias("looks_live"),
    ).withColumn("live", F.col("looks_live") & (F.col("n_owners") <= MAX_OWNERS))


def find_secrets(
    docs: DataFrame, text: str = "text", key: str = "doc_id", repo: str = "doc_id", owner: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: key, base, bare (arrays of spans), n_live, n_shared.

    ``base`` holds what the patterns find.  ``bare`` holds repeats, without a
    telling name before them, of a value that some base span of the same owner
    holds and that the corpus shows to be that owner's own and live-looking.
    ``n_live`` and ``n_shared`` count base spans by the ownership of their
    value: owner-specific and live-looking, or held by more than
    ``MAX_OWNERS`` owners.  A null text is empty; a null owner or repository is
    an owner or repository of its own.  Repeated rows each get their own row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = written(
        docs.select(
            F.col(key).alias("key"),
            F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"),
            base_spans(whole).alias("base"),
            bare_spans(whole).alias("bare"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "spans",
    )
    value_hash = F.sha2(F.encode(F.col("span.value"), "utf-8"), 256)
    base = found.select("row", "owner", "repo", F.explode("base").alias("span")).withColumn("hash", value_hash)
    values = ownership(base.withColumn("looks_live", looks_live(F.col("span.value"))))
    own = base.join(values.filter("live"), "hash").select("hash", "owner").distinct()
    judged = base.join(values, "hash").groupBy("row").agg(
        F.count_if("live").alias("n_live"), F.count_if(F.col("n_owners") > MAX_OWNERS).alias("n_shared")
    )
    inside = lambda s: F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    apart = found.select("row", "owner", F.explode(F.filter("bare", lambda s: ~inside(s))).alias("span"))
    repeats = (
        apart.withColumn("hash", value_hash)
        .join(own, ["hash", "owner"], "left_semi")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("bare"))
    )
    return (
        found.drop("bare")
        .join(judged, "row", "left")
        .join(repeats, "row", "left")
        .select(
            F.col("key").alias(key),
            "base",
            F.coalesce("bare", _none()).alias("bare"),
            F.coalesce("n_live", F.lit(0)).alias("n_live"),
            F.coalesce("n_shared", F.lit(0)).alias("n_shared"),
        )
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start and then kind, with commas between."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
