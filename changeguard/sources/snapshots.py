"""A table that is changed by commits: a base, and only the rows each commit changed.

An update of a thousand rows writes a thousand rows, whatever the size of the
table.  ``read`` lays the newest version of each changed row over the base;
``compact`` writes a new base when there are many commits.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.errors import DriftRefused
from changeguard.sources import commits


class SnapshotTable:
    """Records of one module under ``path``, keyed by ``id``."""

    def __init__(self, spark: SparkSession, path: str, module: str):
        self.spark, self.path, self.module = spark, path.rstrip("/"), module

    @classmethod
    def create(cls, df: DataFrame, path: str, module: str) -> SnapshotTable:
        table = cls(df.sparkSession, path, module)
        token = uuid.uuid4().hex
        df.write.parquet(f"{table.path}/base/{token}")
        if not commits.write_once(table.spark, table._commit_path(0),
                                  {"version": 0, "kind": "base", "token": token, "schema": df.schema.json()}):
            raise DriftRefused(f"{path} already holds a table")
        return table

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def log(self) -> list[dict]:
        return commits.read_all(self.spark, f"{self.path}/commits")

    def version(self) -> int:
        return self.log()[-1]["version"]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the newest by default)."""
        log = [c for c in self.log() if version is None or c["version"] <= version]
        start = max(i for i, c in enumerate(log) if c["kind"] == "base")
        schema = T.StructType.fromJson(json.loads(log[start]["schema"]))
        base = self.spark.read.schema(schema).parquet(f"{self.path}/base/{log[start]['token']}")
        deltas = [c for c in log[start + 1:] if c["kind"] == "delta"]
        if not deltas:
            return base
        changed_schema = T.StructType([*schema.fields, T.StructField("_deleted", T.BooleanType())])
        order = F.create_map(*[x for c in deltas for x in (F.lit(c["token"]), F.lit(c["version"]))])
        token = F.regexp_extract(F.col("_metadata.file_path"), r"/delta/([0-9a-f]{32})/[^/]*$", 1)
        changed = (self.spark.read.schema(changed_schema)
                   .parquet(*[f"{self.path}/delta/{c['token']}" for c in deltas])
                   .withColumn("_version", F.element_at(order, token)))
        newest = changed.groupBy("id").agg(F.max_by(F.struct(*changed_schema.fieldNames()), "_version").alias("r"))
        latest = newest.select("r.*")
        kept = base.join(latest.select("id"), "id", "left_anti").select(*schema.fieldNames())
        return kept.unionByName(latest.where(~F.col("_deleted")).drop("_deleted"))

    def stage(self, changed: DataFrame | None, deleted: DataFrame | None = None) -> str:
        """Write changed rows and tombstones; nothing is visible yet."""
        token = uuid.uuid4().hex
        schema = self.read().schema
        parts = []
        if changed is not None:
            parts.append(changed.select(*schema.fieldNames()).withColumn("_deleted", F.lit(False)))
        if deleted is not None:
            blank = [F.col("id") if f.name == "id" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            parts.append(deleted.select(*blank).withColumn("_deleted", F.lit(True)))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rows.write.parquet(f"{self.path}/delta/{token}")
        return token

    def commit(self, token: str, on_version: int) -> int:
        """Make staged rows visible, if nobody committed since ``on_version``."""
        version = on_version + 1
        if not commits.write_once(self.spark, self._commit_path(version),
                                  {"version": version, "kind": "delta", "token": token}):
            raise DriftRefused(f"{self.module} was committed to since version {on_version}")
        return version

    def compact(self) -> int:
        log = self.log()
        version, token = log[-1]["version"], uuid.uuid4().hex
        whole = self.read()
        whole.write.parquet(f"{self.path}/base/{token}")
        if not commits.write_once(self.spark, self._commit_path(version + 1), {
                "version": version + 1, "kind": "base", "token": token, "schema": whole.schema.json()}):
            raise DriftRefused(f"{self.module} was committed to while it was compacted")
        return version + 1
