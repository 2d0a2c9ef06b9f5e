"""The ledger as evidence: a filtered pack with the state of the whole chain,
and the outcome of a reconciliation written back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.operators.chains import verify_ledger
from changeguard.operators.ledgers import audit_counts, ledger_filter
from changeguard.operators.reconcile import SETTLING, entry_resolved
from changeguard.sources.ledger_store import RECORD_SCHEMA, LedgerStore, digests_by_entry


def audit_pack(ledger: DataFrame, segments: DataFrame, **filters: str | None) -> tuple[DataFrame, DataFrame]:
    """(one-row summary, entries in the window).  The chain is checked over the
    whole ledger, whatever the filters."""
    entries = ledger_filter(ledger, **filters)
    chain = verify_ledger(ledger, segments)
    summary = audit_counts(entries).select(
        "*", *[chain.select(c).scalar().alias(f"chain_{c}") for c in ("intact", "verified")])
    return summary, entries


def record_reconciliation(store: LedgerStore, verdicts: DataFrame, now: str) -> dict:
    """One reconciled entry per attempt, one record row per verdict."""
    judged = verdicts.where(F.col("verdict") != "already_committed")
    attempts = judged.groupBy("segment", "seq", "module").agg(
        F.first("basis").alias("basis"), F.max("merge_state").alias("merge_state"),
        F.bool_or(F.col("verdict").isin(*SETTLING)).alias("resolved"), F.count("*").alias("records"))
    # the id follows from what is recorded, so a repeated task writes the same one
    name = F.sha2(F.concat_ws("|", F.lit("reconciled"), "segment", "seq", F.lit(now)), 256)
    given = {"entry_id": name, "id": F.col("id"), "source": F.lit("verdicts"), "role": F.col("role"),
             "verdict": F.col("verdict")}
    records = judged.select(*[(given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in RECORD_SCHEMA])
    detail = F.to_json(F.struct(
        F.col("segment").alias("resolves_segment"), F.col("seq").alias("resolves_seq"), "resolved",
        F.col("basis").alias("verdict_basis"), "merge_state", "records", F.lit(now).alias("checked_at"),
        F.col("digest").alias("records_digest")), {"ignoreNullFields": "false"})
    entries = (attempts.withColumn("entry_id", name).join(digests_by_entry(records), "entry_id").select(
        "entry_id", F.lit("reconciled").alias("outcome"), F.lit("reconcile_writes").alias("command"),
        "module", F.lit(None).cast("string").alias("plan_key"), F.lit(now).cast("timestamp").alias("at"),
        detail.alias("detail")))
    return store.append(entries, records=records)


def still_open(verdicts: DataFrame) -> DataFrame:
    return entry_resolved(verdicts).where((~F.col("resolved")) | (F.col("still_open") > 0))
