"""Stored plans: addressed by what they do, valid for an hour.

Headers and rows are kept by the day they were stored on.  A load reads the
days that may hold a live plan, and a save drops the days that cannot.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeguard.sources import commits

TTL = "60 minutes"
TTL_SECONDS = 3600
HEADERS = "key string, kind string, module string, fingerprint string, count bigint, body string, token string, ts timestamp, extra array<string>, day string"


def plan_key(kind: str, module: str, selection: str, changes: object) -> str:
    """The text is hashed as given: literals that differ in case are different."""
    body = json.dumps({"kind": kind, "module": module, "selection": " ".join(selection.split()),
                       "changes": changes}, sort_keys=True, separators=(",", ":"), default=str)
    return hashlib.sha256(body.encode()).hexdigest()


@dataclass
class Plan:
    kind: str
    module: str
    key: str
    fingerprint: str
    count: int
    summary: dict
    rows: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)
    made: str | None = None  # when it was stored; the age of an unstored plan is not known


def _oldest_day(now: str, ttl_seconds: int = TTL_SECONDS) -> str:
    """The first day that a plan can be from and be alive."""
    return (datetime.fromisoformat(now.replace("Z", "")) - timedelta(seconds=ttl_seconds)).strftime("%Y-%m-%d")


def expire_plans(spark: SparkSession, path: str, now: str) -> list[str]:
    """Drop all days before the oldest that a live plan can be from; returns them."""
    path, gone = path.rstrip("/"), set()
    for part in ("headers", "rows"):
        for name in commits.children(spark, f"{path}/{part}"):
            if name.startswith("day=") and name[4:] < _oldest_day(now):
                commits.remove(spark, f"{path}/{part}/{name}")
                gone.add(name[4:])
    return sorted(gone)


def save_plan(plan: Plan, path: str, now: str) -> None:
    """Write the plan's rows and extra tables, then its header; without a header it is not there.

    Days of expired plans are dropped.
    """
    spark = plan.rows.sparkSession if plan.rows is not None else SparkSession.active()
    path, day = path.rstrip("/"), _oldest_day(now, 0)
    token = hashlib.sha256(f"{plan.key}|{now}".encode()).hexdigest()[:32]
    folder = f"{path}/rows/day={day}/{token}"
    if plan.rows is not None:
        plan.rows.write.mode("overwrite").parquet(f"{folder}/rows")
    for name, table in plan.extra.items():
        table.write.mode("overwrite").parquet(f"{folder}/extra-{name}")
    header = [(plan.key, plan.kind, plan.module, plan.fingerprint, plan.count,
               json.dumps(plan.summary, sort_keys=True, default=str), token, now, sorted(plan.extra), day)]
    (spark.createDataFrame(header, HEADERS.replace("ts timestamp", "ts string"))
     .withColumn("ts", F.col("ts").cast("timestamp"))
     .write.mode("append").partitionBy("day").parquet(f"{path}/headers"))
    expire_plans(spark, path, now)


def live_plans(headers: DataFrame, now: str, ttl: str = TTL) -> DataFrame:
    """The newest plan per key that is younger than ``ttl``."""
    fresh = headers.where(F.col("ts") > F.lit(now).cast("timestamp") - F.expr(f"interval {ttl}"))
    cols = [c for c in headers.columns if c != "key"]
    return (fresh.groupBy("key").agg(F.max_by(F.struct(*cols), "ts").alias("p")).select("key", "p.*"))


def load_plan(spark: SparkSession, path: str, key: str, now: str, ttl: str = TTL) -> Plan | None:
    path = path.rstrip("/")
    if not commits.exists(spark, f"{path}/headers"):
        return None
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers").where((F.col("day") >= _oldest_day(now)) & (F.col("key") == key))
    row = live_plans(headers, now, ttl).head()
    if row is None:
        return None
    folder = f"{path}/rows/day={row.day}/{row.token}"
    rows = spark.read.parquet(f"{folder}/rows") if commits.exists(spark, f"{folder}/rows") else None
    extra = {name: spark.read.parquet(f"{folder}/extra-{name}") for name in row.extra or ()}
    return Plan(row.kind, row.module, row.key, row.fingerprint, row["count"], json.loads(row.body), rows, extra,
                made=str(row.ts))
