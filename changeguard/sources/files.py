"""Files: response envelopes in, timestamped reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_envelopes(spark: SparkSession, path: str, key: str = "data",
                   schema: T.StructType | None = None) -> DataFrame:
    """Records out of ``{status, body: {<key>: [...], info}}`` response files.

    Give ``schema`` (of one record) to skip inference on large folders.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(T.StructType([
            T.StructField("status", T.LongType()),
            T.StructField("body", T.StructType([T.StructField(key, T.ArrayType(schema))]))]))
    raw = reader.json(path)
    return (raw.select("status", F.explode(F.col(f"body.{key}")).alias("record"))
            .select("status", "record.*"))


def write_report(name: str, summary: DataFrame, detail: DataFrame, path: str, run_ts: str,
                 fmt: str = "json") -> str:
    """Counts and detail rows under ``path/name/run_ts=...``; returns the folder.

    The folder is named by the run, so a repeated run replaces its own report.
    """
    folder = f"{path.rstrip('/')}/{name}/run_ts={run_ts}"
    detail.write.mode("overwrite").format(fmt).save(f"{folder}/detail")
    summary.write.mode("overwrite").format(fmt).save(f"{folder}/summary")
    return folder


def read_report(spark: SparkSession, folder: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    return (spark.read.format(fmt).load(f"{folder}/summary"), spark.read.format(fmt).load(f"{folder}/detail"))
