"""State digests of record sets, and the rows behind a changed digest.

Every row is hashed with SHA-256 over its canonical text.  The row hashes are
added up in eleven independent lanes (ten of 24 bits, one of 16), and the lane
sums are hashed again together with the module and the row count.  Addition
does not care about order, so Spark combines it inside each partition: one row
per task is shuffled, however large the set and however uneven its keys.  Lane
sums stay exact in 64 bits up to 5 * 10^11 rows.

The digest detects drift.  It is not meant to withstand someone who may choose
row contents freely in order to forge a sum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.functions.scalars import canonical, flat, flat_value

# the 64 hex digits of a row hash as six numbers of 12, 12, 12, 12, 12 and 4
# digits; each of the long ones is two lanes
WORDS = [(1 + 12 * i, 12) for i in range(5)] + [(61, 4)]
LANES = [f"lane_{i}" for i in range(11)]
LOW = (1 << 24) - 1


def row_digest(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.sha2(canonical(df, cols), 256)


def digest_words(digest: str = "_h") -> list[Column]:
    """A row hash as numbers, for ``lane_sums``."""
    return [F.expr(f"cast(conv(substring({digest}, {start}, {size}), 16, 10) as bigint) as _w{i}")
            for i, (start, size) in enumerate(WORDS)]


def lane_sums() -> list[Column]:
    """Order-free sums over the columns of ``digest_words``."""
    parts = [part for i in range(5) for part in (f"shiftright(_w{i}, 24)", f"_w{i} & {LOW}")] + ["_w5"]
    return [F.expr(f"coalesce(sum({part}), 0) as {lane}") for part, lane in zip(parts, LANES, strict=True)]


def combined(label: str) -> Column:
    """The final digest from a grouped row that holds ``records`` and the
    lanes; ``label`` is a SQL expression."""
    parts = ", ".join([label, "cast(records as string)", *[f"cast({lane} as string)" for lane in LANES]])
    return F.expr(f"concat('sha256:', sha2(concat_ws('|', {parts}), 256))")


def set_digest(hashed: DataFrame, label: str, *extra: Column) -> DataFrame:
    """One digest of a set of row hashes in column ``_h``: (records, digest)."""
    kept = [c for c in hashed.columns if c != "_h"]
    sums = hashed.select(*kept, *digest_words()).agg(F.count("*").alias("records"), *lane_sums(), *extra)
    more = [c for c in sums.columns if c != "records" and c not in LANES]
    return sums.select("records", combined(f"'{label}'").alias("digest"), *more)


def state_fingerprint(df: DataFrame, module: str | None, guard: Sequence[str],
                      by: Sequence[str] = ()) -> DataFrame:
    """One digest of the guard columns of a set (or of each group in ``by``).

    Order does not matter, a null is not a missing value, and the module is
    part of the digest.  Rows without an id are counted in ``null_ids``: they
    cannot be guarded, and a caller must treat them as errors.
    """
    hashed = df.select(*by, "id", row_digest(df, ["id", *guard]).alias("_h"))
    sums = hashed.select(*by, "id", *digest_words()).groupBy(*by).agg(
        F.count("*").alias("records"), F.expr("count_if(id is null) as null_ids"), *lane_sums())
    label = "module" if module is None else "'" + module.replace("'", "''") + "'"
    return sums.select(*by, "records", "null_ids", combined(label).alias("digest"))


def fingerprint_value(df: DataFrame, module: str, guard: Sequence[str]):
    """The digest row, computed now: (records, null_ids, digest)."""
    return state_fingerprint(df, module, guard).head()


def ownership_fingerprint(df: DataFrame) -> DataFrame:
    """Digest of which record ids belong to the set, per module and nothing else."""
    hashed = df.select(F.sha2(F.concat_ws("|", "module", "id"), 256).alias("_h"))
    return set_digest(hashed, "ownership")


def drift_rows(plan_rows: DataFrame, now_rows: DataFrame, guard: Sequence[str],
               keys: Sequence[str] = ("id",)) -> DataFrame:
    """Records that were added, removed or changed between two states.

    Only the key and a row hash are shuffled, not the columns behind it.
    """
    before = plan_rows.select(*keys, row_digest(plan_rows, guard).alias("_before"))
    after = now_rows.select(*keys, row_digest(now_rows, guard).alias("_after"))
    kind = (F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed")
            .when(F.col("_before") != F.col("_after"), "changed"))
    return (before.join(after, list(keys), "full").withColumn("drift", kind)
            .where(F.col("drift").isNotNull()).select(*keys, "drift"))


def would_change(rows: DataFrame, changes: Mapping[str, object]) -> DataFrame:
    """How many rows hold another value than the one about to be written."""
    differs = F.lit(False)
    for name, value in changes.items():
        kind = rows.schema[name].dataType
        wanted = flat_value(F.lit(value).cast(kind), kind) if not isinstance(value, dict) else F.lit(str(value["id"]))
        differs = differs | ~flat(rows, name).eqNullSafe(wanted)
    return rows.agg(F.count("*").alias("records"), F.count_if(differs).alias("would_change"))
