"""Merkle evidence: a hash tree over the rows of a table.

Rows are dealt into buckets by the first hex digits of a digest of their id.
A bucket's hash covers its rows in order; a node's hash covers its at most
sixteen children, up to one root.  Unlike a sum of hashes, no choice of row
contents makes another set of rows come out with the same root.  Each level is
one aggregation of the level below, so the tree of N rows costs one shuffle of
N row hashes and little more.  Two trees tell where they differ from the root
down: below equal nodes nothing is looked at, and only rows of differing
buckets are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.operators.fingerprints import row_digest
from changeguard.session import written

FAN_OUT = 16
BUCKET_ROWS = 256  # of a finest bucket, about


def depth_for(rows: int) -> int:
    """Levels below the root that leave about ``BUCKET_ROWS`` rows in a bucket."""
    depth = 0
    while rows > BUCKET_ROWS * FAN_OUT**depth:
        depth += 1
    return depth


def _place(key: Column) -> Column:
    return F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "utf-8"))


def leaves(df: DataFrame, cols: Sequence[str], depth: int, key: str = "id") -> DataFrame:
    """(bucket, place, id, leaf): one row per row; ``leaf`` hashes the key and ``cols``.

    A null key is its own value in the hash and placed as an empty text;
    repeated rows are leaves each.
    """
    place = _place(F.col(key))
    return df.select(F.substring(place, 1, depth).alias("bucket"), place.alias("place"), F.col(key).alias("id"),
                     row_digest(df, [key, *[c for c in cols if c != key]]).alias("leaf"))


def _hash(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, "\n"), 256)


def tree(rows: DataFrame, depth: int) -> DataFrame:
    """(level, node, records, hash) of ``leaves``; level 0 is the root, level ``depth`` has the buckets.

    Buckets hold about as many rows at any size, since the depth grows with
    the table.  Nodes without rows are absent, an empty table has no node.
    """
    line = F.concat_ws(":", "place", "leaf")
    level = rows.groupBy(F.col("bucket").alias("node")).agg(
        F.count("*").alias("records"), _hash(F.array_sort(F.collect_list(line))).alias("hash"))
    whole = level.withColumn("level", F.lit(depth))
    for at in range(depth - 1, -1, -1):
        child = F.struct("node", F.concat_ws(":", F.substring("node", at + 1, 1), F.col("records").cast("string"), "hash").alias("line"))
        level = level.groupBy(F.substring("node", 1, at).alias("node")).agg(
            F.sum("records").alias("records"),
            _hash(F.transform(F.array_sort(F.collect_list(child)), lambda c: c["line"])).alias("hash"))
        whole = whole.unionByName(level.withColumn("level", F.lit(at)))
    return whole.select("level", "node", "records", "hash")


def merkle_tree(df: DataFrame, cols: Sequence[str], depth: int | None = None, key: str = "id") -> DataFrame:
    depth = depth_for(df.count()) if depth is None else depth
    return tree(leaves(df, cols, depth, key), depth)


@dataclass(frozen=True)
class Proof:
    """What it takes to get from one row's hash to the root: the other rows of its bucket, the siblings above."""

    place: str
    leaf: str
    bucket: tuple[str, ...]  # the lines of the bucket in order, the row's own among them
    siblings: tuple[tuple[tuple[str, int, str], ...], ...]  # per level from the buckets up: (digit, records, hash)


def prove(rows: DataFrame, nodes: DataFrame, depth: int, key_value: str) -> Proof | None:
    """The proof that a row is in the tree; None if there is no row of that key.

    Reads one bucket and at most sixteen nodes a level.
    """
    place = hashlib.md5(str(key_value).encode()).hexdigest()
    held = rows.where(F.col("bucket") == place[:depth]).select("place", "leaf").collect()
    own = sorted(r.leaf for r in held if r.place == place)
    if not own:
        return None
    wanted = F.lit(False)
    for at in range(1, depth + 1):
        wanted = wanted | ((F.col("level") == at) & F.startswith("node", F.lit(place[:at - 1])))
    found = nodes.where(wanted).collect()
    siblings = tuple(tuple(sorted((n.node[-1], n.records, n.hash) for n in found if n.level == at))
                     for at in range(depth, 0, -1))
    return Proof(place, own[0], tuple(sorted(f"{r.place}:{r.leaf}" for r in held)), siblings)


def holds(proof: Proof, root: str) -> bool:
    """Whether the proof leads from its row to ``root``."""
    sha = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    if f"{proof.place}:{proof.leaf}" not in proof.bucket or list(proof.bucket) != sorted(proof.bucket):
        return False
    now, records, depth = sha(proof.bucket), len(proof.bucket), len(proof.siblings)
    for up, level in enumerate(proof.siblings):
        if (proof.place[depth - up - 1], records, now) not in level:
            return False
        now, records = sha(f"{d}:{n}:{h}" for d, n, h in level), sum(n for _, n, _ in level)
    return now == root


def differing(before: DataFrame, after: DataFrame, depth: int) -> DataFrame:
    """(node, kind) of the buckets in which two trees of one depth differ.

    From the root down, children are compared only below nodes that differ;
    ``kind`` is ``changed``, or ``added`` or ``removed`` where one tree has no
    such bucket.
    """
    open_ = None
    for at in range(depth + 1):
        side = lambda t, name: t.where(F.col("level") == at).select("node", F.col("hash").alias(name))  # noqa: B023, E731
        one, two = side(before, "h1"), side(after, "h2")
        if open_ is not None:
            below = F.substring("node", 1, at - 1)
            one, two = (s.join(open_.select(F.col("node").alias("up")), below == F.col("up"), "left_semi") for s in (one, two))
        open_ = one.join(two, "node", "full").where(~F.col("h1").eqNullSafe(F.col("h2")))
    kind = F.when(F.col("h1").isNull(), "added").when(F.col("h2").isNull(), "removed").otherwise("changed")
    return open_.select("node", kind.alias("kind"))


def located_drift(before: DataFrame, after: DataFrame, cols: Sequence[str], depth: int | None = None,
                  key: str = "id") -> DataFrame:
    """(bucket, id, drift) of every row that was added, removed or changed, found through the trees.

    Rows of equal buckets are not shuffled again.  Repeated keys are compared
    by their sorted hashes.
    """
    depth = depth_for(before.count()) if depth is None else depth
    one, two = leaves(before, cols, depth, key), leaves(after, cols, depth, key)
    trees = [written(tree(rows, depth), "merkle") for rows in (one, two)]
    buckets = differing(*trees, depth).select(F.col("node").alias("bucket"))
    held = lambda rows, name: (rows.join(buckets, "bucket", "left_semi").groupBy("bucket", "place")
                               .agg(F.any_value("id").alias(f"{name}_id"), F.array_sort(F.collect_list("leaf")).alias(name)))
    both = held(one, "h1").join(held(two, "h2"), ["bucket", "place"], "full").where(~F.col("h1").eqNullSafe(F.col("h2")))
    kind = F.when(F.col("h1").isNull(), "added").when(F.col("h2").isNull(), "removed").otherwise("changed")
    return both.select("bucket", F.coalesce("h1_id", "h2_id").alias("id"), kind.alias("drift"))
