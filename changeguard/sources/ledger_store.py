"""The ledger on disk: chained entries, the records they name, segment ends
and a chain of commits.

Entries are cut into segments of at most ``segment_size``.  Inside a segment
each entry's hash covers the one before it.  A new segment starts from a hash
of the newest commit and its own number, so all segments of one append are
chained in parallel; the commit that follows covers the ends of all of them and
the commit before it.  Large jobs keep one row per record in ``records``; the
entry holds a digest of those rows, so the chain covers them too.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.errors import DriftRefused
from changeguard.operators.chains import GENESIS, SEGMENT_SIZE, chain_entries, first_hash, segment_table
from changeguard.operators.fingerprints import combined, digest_words, lane_sums, row_digest, set_digest
from changeguard.operators.ranking import dense_index
from changeguard.sources import commits

TEXT, COUNT, TIME = T.StringType(), T.LongType(), T.TimestampType()
TEXT_MAP = T.MapType(TEXT, TEXT)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ENTRY_SCHEMA = _schema(segment=COUNT, seq=COUNT, entry_id=TEXT, outcome=TEXT, command=TEXT, module=TEXT,
                       plan_key=TEXT, at=TIME, detail=TEXT, prev=TEXT, entry_hash=TEXT)
SEGMENT_SCHEMA = _schema(segment=COUNT, chain_start=TEXT, n=COUNT, last_hash=TEXT)
RECORD_SCHEMA = _schema(entry_id=TEXT, id=TEXT, source=TEXT, role=TEXT, before=TEXT_MAP,
                        before_modified_time=TIME, intent=TEXT_MAP, written_time=TIME, verdict=TEXT, archive=TEXT)
COMMIT_SCHEMA = "number bigint, token string, prev string, segments_digest string, head string"
NEW_ENTRY = ("entry_id", "outcome", "command", "module", "plan_key", "at", "detail")
BLOCK = 256  # segments per write task
# every append writes its own folder, named by the segments it reaches, so a
# read of some segments opens only the folders that hold them
LAYOUT = _schema(from_segment=COUNT, to_segment=COUNT, token=TEXT)


def new_entry(outcome: str, command: str, module: str, plan_key: str, at: str, detail: dict) -> dict:
    return {"entry_id": uuid.uuid4().hex, "outcome": outcome, "command": command, "module": module,
            "plan_key": plan_key, "at": at, "detail": json.dumps(detail, sort_keys=True, separators=(",", ":"))}


def records_of(rows: DataFrame, entry_id: str, source: str, **columns) -> DataFrame:
    """Record rows of one entry, with every column of the records table."""
    given = {"entry_id": F.lit(entry_id), "source": F.lit(source), "id": F.col("id"), **columns}
    return rows.select(*[(given[f.name] if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in RECORD_SCHEMA])


def records_digest(records: DataFrame) -> str:
    """Order-free digest of record rows, for the entry that owns them."""
    flat = records.select(row_digest(records, RECORD_SCHEMA.fieldNames()).alias("_h"))
    return set_digest(flat, "records").head().digest


def digests_by_entry(records: DataFrame) -> DataFrame:
    """(entry_id, digest) of the record rows each entry owns, in one pass."""
    hashed = records.select("entry_id", row_digest(records, RECORD_SCHEMA.fieldNames()).alias("_h"))
    return (hashed.select("entry_id", *digest_words()).groupBy("entry_id")
            .agg(F.count("*").alias("records"), *lane_sums())
            .select("entry_id", combined("'records'").alias("digest")))


class LedgerStore:
    def __init__(self, spark: SparkSession, path: str, segment_size: int = SEGMENT_SIZE):
        if not 1 <= segment_size <= SEGMENT_SIZE:
            raise ValueError(f"segment_size must be between 1 and {SEGMENT_SIZE}")
        self.spark, self.path, self.segment_size = spark, path.rstrip("/"), segment_size

    # --- reading -------------------------------------------------------------

    def last(self) -> dict | None:
        return commits.last(self.spark, f"{self.path}/commits")

    def commit_table(self) -> DataFrame:
        return commits.table(self.spark, f"{self.path}/commits", COMMIT_SCHEMA)

    def _written(self, part: str, schema: T.StructType) -> DataFrame:
        stored = T.StructType([*schema.fields, *LAYOUT.fields])
        folder = f"{self.path}/{part}"
        if not commits.exists(self.spark, folder):
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(folder)

    def _folder(self, part: str, first: int, last: int, token: str) -> str:
        return f"{self.path}/{part}/from_segment={first}/to_segment={last}/token={token}"

    def _committed(self, part: str, schema: T.StructType) -> DataFrame:
        rows = self._written(part, schema).join(self.commit_table().select("token"), "token", "left_semi")
        return rows.select(*schema.fieldNames(), *LAYOUT.fieldNames())

    def read(self, segments: str | tuple[int, int] = "all") -> DataFrame:
        """Entries of all committed segments, of a range of them, or of the
        live one only."""
        entries = self._committed("entries", ENTRY_SCHEMA)
        if segments == "live":
            newest = self.last()
            segments = (newest["end_segment"],) * 2 if newest else (0, 0)
        if segments != "all":
            low, high = segments
            entries = entries.where((F.col("to_segment") >= low) & (F.col("from_segment") <= high)
                                    & F.col("segment").between(low, high))
        return entries.select(*ENTRY_SCHEMA.fieldNames())

    def records(self) -> DataFrame:
        return self._committed("records", RECORD_SCHEMA).select(*RECORD_SCHEMA.fieldNames())

    def segments(self) -> DataFrame:
        """Newest known end of every segment."""
        rows = self._committed("segments", SEGMENT_SCHEMA)
        return (rows.groupBy("segment").agg(F.max_by(F.struct("chain_start", "n", "last_hash"), "n").alias("s"))
                .select("segment", "s.*"))

    # --- writing -------------------------------------------------------------

    def append(self, entries: DataFrame | Iterable[dict], order: Sequence[str] = ("at", "entry_id"),
               records: DataFrame | None = None) -> dict:
        """Chain a batch, write it, and commit.  Returns the commit.

        A full segment is never reopened; the live one is filled up first.
        """
        indexed, count = self._indexed(entries, order)
        if not count:
            raise ValueError("nothing to append")
        last = self.last()
        head, number = (last["head"], last["number"]) if last else (GENESIS, 0)
        live, used = (last["live_segment"], last["live_n"]) if last else (0, 0)
        size = self.segment_size
        place = F.col("_i") + F.lit(live * size + used)
        numbered = indexed.select(F.floor(place / size).cast("bigint").alias("segment"),
                                  (place % size + 1).cast("bigint").alias("seq"), *NEW_ENTRY)
        reached = (live * size + used + count - 1) // size
        fresh = first_hash(F.lit(head), F.col("segment"))
        start = F.when(F.col("segment") == live, F.lit(last["live_hash"])).otherwise(fresh) if used else fresh
        starts = numbered.select("segment").distinct().withColumn("start_hash", start)
        token = uuid.uuid4().hex
        folder = {part: self._folder(part, live, reached, token) for part in ("entries", "segments", "records")}
        # whole blocks of segments per file, in order: row groups then hold few
        # segments each, and their statistics prune a read of some of them
        (chain_entries(numbered, starts).select(*ENTRY_SCHEMA.fieldNames())
         .repartition(F.floor(F.col("segment") / BLOCK)).sortWithinPartitions("segment", "seq")
         .write.parquet(folder["entries"]))
        written = self.spark.read.schema(ENTRY_SCHEMA).parquet(folder["entries"])
        self._ends(segment_table(written), live if used else None).write.parquet(folder["segments"])
        if records is not None:
            records.select(*RECORD_SCHEMA.fieldNames()).write.parquet(folder["records"])
        digest, newest = self._segments_digest(self.spark.read.schema(SEGMENT_SCHEMA).parquet(folder["segments"]))
        commit = {"number": number + 1, "token": token, "prev": head, "segments_digest": digest,
                  "end_segment": newest.segment, "live_segment": newest.segment, "live_n": newest.n,
                  "live_hash": newest.last_hash}
        commit["head"] = commit_head(commit)
        if commit["live_n"] >= size:
            commit["live_segment"], commit["live_n"] = newest.segment + 1, 0
        if not commits.write_once(self.spark, f"{self.path}/commits/{number + 1:012d}.json", commit):
            raise DriftRefused("the ledger was appended to meanwhile; append again")
        return commit

    def _indexed(self, entries: DataFrame | Iterable[dict], order: Sequence[str]) -> tuple[DataFrame, int]:
        """Entries with their position in the batch, and how many there are.  A list was made by the
        caller, one entry per step of a job, and is already in hand."""
        if not isinstance(entries, DataFrame):
            rows = sorted(entries, key=lambda row: tuple(row[c] for c in order))
            plain = "entry_id string, outcome string, command string, module string, plan_key string, at string, detail string"
            frame = self.spark.createDataFrame(
                [(i, *[row[c] for c in NEW_ENTRY]) for i, row in enumerate(rows)], f"_i bigint, {plain}")
            return frame.withColumn("at", F.col("at").cast("timestamp")), len(rows)
        typed = entries.select(*[F.col(c).cast("timestamp").alias(c) if c == "at" else F.col(c) for c in NEW_ENTRY])
        indexed = dense_index(typed, order, "_i")
        return indexed, indexed.count()

    def _ends(self, ends: DataFrame, continued: int | None) -> DataFrame:
        """Segment rows; a continued segment keeps its start and adds its count."""
        if continued is None:
            return ends
        old = self.segments().where(F.col("segment") == continued).select(
            "segment", F.col("chain_start").alias("_start"), F.col("n").alias("_n"))
        return (ends.join(old, "segment", "left")
                .select("segment", F.coalesce("_start", "chain_start").alias("chain_start"),
                        (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), "last_hash"))

    def _segments_digest(self, rows: DataFrame):
        hashed = rows.select("segment", "n", "last_hash", row_digest(rows, SEGMENT_SCHEMA.fieldNames()).alias("_h"))
        row = set_digest(hashed, "segments", F.expr(
            "max_by(struct(segment, n, last_hash), segment) as newest")).head()
        return row.digest, row.newest

    def verify_commits(self) -> DataFrame:
        """One row per commit: does it follow the one before it, and does it
        still cover the segment ends it was made for?"""
        rows = self._written("segments", SEGMENT_SCHEMA)
        hashed = rows.select("token", row_digest(rows, SEGMENT_SCHEMA.fieldNames()).alias("_h"))
        ends = (hashed.select("token", *digest_words()).groupBy("token")
                .agg(F.count("*").alias("records"), *lane_sums())
                .select("token", combined("'segments'").alias("found")))
        log = self.commit_table()
        body = F.concat_ws("|", "prev", F.col("number").cast("string"), "token", "segments_digest")
        before = log.select((F.col("number") + 1).alias("number"), F.col("head").alias("before"))
        why = (F.when(~F.col("prev").eqNullSafe(F.coalesce("before", F.when(F.col("number") == 1, GENESIS), F.lit(""))),
                      "does not follow the commit before it")
               .when(~F.col("head").eqNullSafe(F.concat(F.lit("sha256:"), F.sha2(body, 256))), "commit was changed")
               .when(~F.col("segments_digest").eqNullSafe(F.col("found")), "segment ends were changed"))
        return (log.join(before, "number", "left").join(ends, "token", "left")
                .select("number", why.isNull().alias("ok"), why.alias("why")))

    def verify_records(self) -> DataFrame:
        """Entries whose record rows are not the ones their digest was made of."""
        stated = self.read().select("entry_id", F.get_json_object("detail", "$.records_digest").alias("stated"))
        found = digests_by_entry(self.records())
        why = (F.when(F.col("digest").isNull() & F.col("stated").isNotNull(), "records missing")
               .when(F.col("stated").isNull() & F.col("digest").isNotNull(), "records without a digest")
               .when(F.col("stated") != F.col("digest"), "records were changed"))
        return (stated.join(found, "entry_id", "full").withColumn("why", why)
                .where(F.col("why").isNotNull()).select("entry_id", "why"))


def commit_head(commit: dict) -> str:
    body = "|".join([commit["prev"], str(commit["number"]), commit["token"], commit["segments_digest"]])
    return "sha256:" + hashlib.sha256(body.encode()).hexdigest()


def import_book(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, segments) of JSON books ``{chain_start, entries: [...]}``.

    One file is one segment, numbered in name order; positions are explicit.
    ``detail`` is kept as text whatever its shape.
    """
    entry = ("struct<outcome:string, command:string, module:string, plan_key:string, seq:bigint, at:string, "
             "detail:variant, prev:string, entry_hash:string>")
    books = (spark.read.option("multiLine", True).schema(f"chain_start string, entries array<{entry}>").json(path)
             .select("chain_start", "entries", F.col("_metadata.file_name").alias("_file")))
    # one row per file, so the numbering join stays far smaller than the books
    order = dense_index(books.select("_file").distinct(), ["_file"], "segment")
    numbered = books.join(order.withColumn("segment", F.col("segment").cast("bigint")), "_file")
    rows = numbered.select("segment", "chain_start", F.posexplode("entries").alias("pos", "e"))
    entries = rows.select(
        "segment", (F.col("pos") + 1).cast("bigint").alias("seq"),
        F.concat_ws("-", F.lit("book"), "segment", F.col("pos") + 1).alias("entry_id"),
        "e.outcome", "e.command", "e.module", "e.plan_key", F.to_timestamp("e.at").alias("at"),
        F.to_json("e.detail").alias("detail"), "e.prev", "e.entry_hash")
    return entries, numbered.select("segment", F.coalesce("chain_start", F.lit(GENESIS)).alias("chain_start"),
                                    F.size("entries").cast("bigint").alias("n"),
                                    F.get(F.col("entries"), F.size("entries") - 1)["entry_hash"].alias("last_hash"))
