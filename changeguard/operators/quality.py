"""Data quality: what is rotting, what is incomplete, what a table really holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import blank_value, days_ago, flat, is_blank, today
from changeguard.operators.ranking import top_per_group
from changeguard.operators.scans import HYGIENE_CLOSED, departed_users, open_stage

DEFAULT_SAMPLE = 5


@dataclass(frozen=True)
class Check:
    """One hygiene rule: rows of ``module`` where ``test`` holds are findings."""

    key: str
    module: str
    needs: tuple[str, ...]
    test: Column
    fix_with: str = "plan_update"


def hygiene_checks(now: str, stale_days: int = 90, closed: Iterable[str] = HYGIENE_CLOSED) -> list[Check]:
    stale = F.col("modified_time") < days_ago(now, stale_days)
    still_open = open_stage(list(closed))
    return [
        Check("stale_leads", "Leads", ("modified_time",), stale),
        Check("stale_deals", "Deals", ("modified_time", "stage"), stale & still_open),
        Check("overdue_deals", "Deals", ("closing_date", "stage"),
              (F.col("closing_date") < today(now)) & still_open),
        Check("leads_no_email", "Leads", ("email",), F.col("email").isNull()),
        Check("contacts_no_email", "Contacts", ("email",), F.col("email").isNull()),
    ]


def union_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check],
                 departed: DataFrame | None = None) -> tuple[DataFrame | None, list[tuple[str, str, str]]]:
    """(findings, unavailable checks).

    All checks of a module are tested in one scan of it.  A check whose column
    is absent is unavailable, not zero.
    """
    unavailable, parts = [], []
    for module, df in tables.items():
        usable = []
        for check in (c for c in checks if c.module == module):
            absent = [name for name in check.needs if name not in df.columns]
            if absent:
                unavailable.append((check.key, module, "no column " + ", ".join(absent)))
            else:
                usable.append(F.when(check.test, F.lit(check.key)))
        if departed is not None:
            if "owner_id" in df.columns:
                gone = departed.select(F.col("id").alias("owner_id")).distinct().withColumn("_gone", F.lit(True))
                df = df.join(gone, "owner_id", "left")
                usable.append(F.when(F.col("_gone"), F.lit(orphan_key(module))))
            else:
                unavailable.append((orphan_key(module), module, "no column owner_id"))
        if usable:
            hits = F.filter(F.array(*usable), lambda x: x.isNotNull())
            parts.append(df.select(F.explode(hits).alias("check"), F.lit(module).alias("module"), "id"))
    for check in checks:
        if check.module not in tables:
            unavailable.append((check.key, check.module, "no such table"))
    whole = None
    for part in parts:
        whole = part if whole is None else whole.unionByName(part)
    return whole, unavailable


def orphan_key(module: str) -> str:
    return f"orphaned_{module.lower()}"


def finding_counts(findings: DataFrame) -> DataFrame:
    """Rows per check, most first; a check without findings is not listed."""
    fix = F.when(F.col("check").startswith("orphaned_"), "plan_handover").otherwise("plan_update")
    return (findings.groupBy("check", "module").agg(F.count("*").alias("count"))
            .withColumn("fix_with", fix).orderBy(F.col("count").desc(), "check"))


def sample_per_check(findings: DataFrame, n: int = DEFAULT_SAMPLE) -> DataFrame:
    """The first ``n`` findings of each check by id."""
    if n < 0:
        raise ValueError("a sample has 0 rows or more")
    if n == 0:
        return findings.limit(0)
    return top_per_group(findings, ["check"], [F.col("id")], n).drop("rank")


def hygiene_scan(tables: Mapping[str, DataFrame], users: DataFrame | None, now: str, stale_days: int = 90,
                 include: Iterable[str] | None = None, sample: int = DEFAULT_SAMPLE,
                 closed: Iterable[str] = HYGIENE_CLOSED,
                 extra_checks: Sequence[Check] = ()) -> tuple[DataFrame, DataFrame, DataFrame, list]:
    """(counts per check, every finding, a sample per check, unavailable)."""
    if stale_days < 1:
        raise ValueError("stale_days must be at least 1")
    checks = [*hygiene_checks(now, stale_days, closed), *extra_checks]
    wanted = set(include) if include else None
    if wanted is not None:
        checks = [c for c in checks if c.key in wanted]
    departed = departed_users(users) if users is not None else None
    if wanted is not None and departed is not None and not any(orphan_key(m) in wanted for m in tables):
        departed = None
    findings, unavailable = union_checks(tables, checks, departed)
    if users is None:
        unavailable += [(orphan_key(m), m, "users could not be read") for m in tables
                        if wanted is None or orphan_key(m) in wanted]
    if wanted is not None:
        unavailable = [u for u in unavailable if u[0] in wanted]
    if findings is None:
        session = next(iter(tables.values())).sparkSession
        findings = session.createDataFrame([], "`check` string, module string, id string")
    elif wanted is not None:
        findings = findings.where(F.col("check").isin(*wanted))
    return finding_counts(findings), findings, sample_per_check(findings, sample), unavailable


# --- readiness --------------------------------------------------------------

def required_fields(meta: DataFrame, module: str, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(required fields the table has, required fields it lacks).

    Field metadata has one row per column of a table; that bound is enforced.
    """
    wanted = (meta.where((F.col("module") == module) & ~F.coalesce("read_only", F.lit(False))
                         & (F.coalesce("system_mandatory", F.lit(False)) | F.coalesce("required", F.lit(False))))
              .select("field").distinct().orderBy("field").limit(10_001).collect())
    if len(wanted) > 10_000:
        raise ValueError(f"more than 10000 required fields are described for {module}")
    names = [row.field for row in wanted]
    return [n for n in names if n in columns], [n for n in names if n not in columns]


def _names_where(tests: Sequence[tuple[str, Column]]) -> Column:
    if not tests:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def readiness(df: DataFrame, meta: DataFrame, module: str, require: Sequence[str] = ()) -> DataFrame:
    """One row per record: is it ready, and which fields hold it back."""
    have, lack = required_fields(meta, module, df.columns)
    missing = _names_where([(n, is_blank(df, n)) for n in have] + [(n, F.lit(True)) for n in lack])
    asked = [(n, n in df.columns) for n in dict.fromkeys(require)]
    requested = _names_where([(f"{n}: empty", is_blank(df, n)) if known else (f"{n}: not a field", F.lit(True))
                              for n, known in asked])
    return (df.select("id", F.array_sort(missing).alias("missing_required"), requested.alias("missing_requested"))
            .withColumn("ready", (F.size("missing_required") == 0) & (F.size("missing_requested") == 0)))


# --- profile ----------------------------------------------------------------

def profile_fields(df: DataFrame, meta: DataFrame, max_values: int = 50) -> DataFrame:
    """Declared fields with what the table really holds: nulls, distinct
    values, and the most frequent values.

    Values are counted per (field, value) before they are shuffled; no set of
    values is ever collected whole.
    """
    names = [c for c in df.columns]
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), flat(df, n).alias("value"),
                                         blank_value(F.col(n), df.schema[n].dataType).alias("blank"))
                                for n in names]))
    counted = (df.select(cells.alias("c")).groupBy("c.field", "c.value", "c.blank")
               .agg(F.count("*").alias("n")))
    totals = counted.groupBy("field").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), F.lit(0)).alias("blanks"),
        F.count("value").alias("distinct_values"))
    top = (top_per_group(counted.where(F.col("value").isNotNull()), ["field"],
                         [F.col("n").desc(), F.col("value")], max_values)
           .groupBy("field").agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("_top"))
           .select("field", F.transform("_top", lambda x: x["value"]).alias("top_values")))
    return meta.join(totals, "field", "left").join(top, "field", "left")
