"""Documents linked by the Jaccard similarity of their n-gram sets: an exact, grouped prefix join.

The n-grams of a set are put in one order for all documents, those of rare
hash buckets first.  Two sets can be similar enough only if they share an
n-gram near the beginning of both (their prefixes), at places that leave room
for the overlap they need.  Equal sets are one class; classes of one size and
one prefix are one group.  Group pairs are filtered on sizes and places, those
that remain are expanded to classes, and class pairs whose profiles leave room
for the overlap are verified on whole sets.

Links are looked for in two steps, since only components are asked for.
First every group meets the leader of each of its n-grams; that makes as many
pairs as there are prefix entries, also in a family of many near copies.  Then
the entries of each n-gram whose classes are still in different components are
compared with each other, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.llm.components import components
from changeguard.llm.text import array_views, byte_texts, hashed, shingles
from changeguard.session import written

SIZE = 4
PERCENT = 85
# Frequencies only decide the order of n-grams, so counters by hash are enough; they are a table of fixed size.
BUCKETS = 1 << 18
BLOCK = 1024  # entries of an n-gram that are compared with as many others at a time


def grams(text: bytes, size: int = SIZE) -> np.ndarray:
    """The distinct n-grams of a text as sorted hashes: words between white space, A-Z lower-cased."""
    found = text.lower().split()
    return np.unique(shingles(hashed(found), size))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h & np.uint64(buckets - 1)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch], size: int, buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(buckets, np.int64)
    for batch in batches:
        held, room = [], 0
        for text in byte_texts(batch.column(0)):
            held.append(_bucket(grams(text, size), buckets))
            room += len(held[-1])
            if room > buckets:
                counts += np.bincount(np.concatenate(held), minlength=buckets)
                held, room = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=buckets)
    some = np.flatnonzero(counts)
    for part in np.array_split(some, 1 + len(some) // 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["bucket", "n"])


def frequency_table(texts: DataFrame, size: int = SIZE, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all of ``texts`` (one column) fall into each bucket; ``buckets`` is a power of two."""
    found = texts.mapInArrow(lambda batches: _frequencies(batches, size, buckets), "bucket long, n long")
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(buckets, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def least_overlap(one, two, percent: int = PERCENT):
    """The least number of common n-grams that sets of these sizes need."""
    return -(-percent * (one + two) // (100 + percent))


def prefix(found: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The n-grams of a set, rarest bucket first, that any set similar enough has one in common with."""
    size = len(found) - -(-percent * len(found) // 100) + 1
    return found[np.lexsort((found, counts[_bucket(found, len(counts))]))[:size]]


def profile(found: np.ndarray) -> bytes:
    """How many n-grams of a set have each first byte: one byte a count, or four where a count needs them."""
    counts = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=256)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def most_common(one: bytes, two: bytes) -> int:
    """The most n-grams that two sets with these profiles can have in common."""
    read = lambda p: np.frombuffer(p, np.uint8 if len(p) == 256 else np.uint32).astype(np.int64)
    return int(np.minimum(read(one), read(two)).sum())


def _signed(batches: Iterator[pa.RecordBatch], counts: np.ndarray, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Adds to (doc_id, text): n, same (hash of the set), beginning (hash of size and prefix), prefix, profile; no words: nulls."""
    for batch in batches:
        n, same, beginning, prefixes, profiles = [], [], [], [], []
        for text in byte_texts(batch.column("text")):
            found = grams(text, size)
            n.append(len(found))
            front = prefix(found, counts, percent).tobytes() if len(found) else None
            same.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            beginning.append(None if front is None else xxhash.xxh3_128_digest(len(found).to_bytes(8, "little") + front))
            prefixes.append(front)
            profiles.append(profile(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in (same, beginning, prefixes, profiles))],
            names=["doc_id", "n", "same", "beginning", "prefix", "profile"],
        )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups (gid, n, copies, prefix) to one row per n-gram of the prefix: gram, place, gid, n, copies."""
    for batch in batches:
        fronts = array_views(batch.column("prefix"), np.int64)
        sizes = np.array([len(f) for f in fronts], np.int64)
        at = np.repeat(np.arange(len(fronts)), sizes)
        place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        pick = lambda c: pa.array(batch.column(c).to_numpy()[at])  # noqa: B023, E731
        gram = np.concatenate(fronts) if fronts else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram), pa.array(place), pick("gid"), pick("n"), pick("copies")], names=["gram", "place", "gid", "n", "copies"]
        )


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by n-gram, leaders first, to the others with their leader beside them; lone entries go."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, place, gid, n = (batch.column(c).to_numpy() for c in ("gram", "place", "gid", "n"))
        if before is not None:
            gram, place, gid, n = (np.concatenate([[b], c]) for b, c in zip(before, (gram, place, gid, n)))
        new = np.ones(len(gram), bool)
        new[1:] = gram[1:] != gram[:-1]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(gram)), 0))
        rest = np.flatnonzero(~new)
        columns = [gram[rest], place[rest], gid[rest], n[rest], gid[lead[rest]], n[lead[rest]], place[lead[rest]]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "place", "gid", "n", "lead", "lead_n", "lead_place"])
        before = tuple(c[lead[-1]] for c in (gram, place, gid, n))


def may_link(n1, place1, n2, place2, percent: int = PERCENT):
    """Whether sets of these sizes that first share an n-gram at these places can be similar enough."""
    need = least_overlap(n1, n2, percent)
    return (percent * np.maximum(n1, n2) <= 100 * np.minimum(n1, n2)) & (place1 <= n1 - need) & (place2 <= n2 - need)


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Comparisons (members) of an n-gram's entries to pairs (a, b) of parts that may have a link."""
    for batch in batches:
        members = batch.column("members")
        ends = members.offsets.to_numpy()
        left, part, n, place, root = (c.to_numpy(zero_copy_only=False) for c in members.values.flatten())
        found = [np.empty((2, 0), np.int64)]
        for i, j in zip(ends[:-1], ends[1:]):
            side = left[i:j]
            one = i + np.flatnonzero(side)
            two = one if side.all() else i + np.flatnonzero(~side)
            good = root[one][:, None] != root[two]
            good &= may_link(n[one][:, None], place[one][:, None], n[two], place[two], percent)
            x, y = np.nonzero(good)
            found.append(np.sort(np.stack([part[one[x]], part[two[y]]]), axis=0))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t, size).tobytes() for t in byte_texts(batch.column("text"))]
        same = [xxhash.xxh3_128_digest(f) for f in found]
        yield pa.RecordBatch.from_arrays([pa.array(same, pa.binary()), pa.array(found, pa.binary())], names=["same", "grams"])


def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, profile_a, n_b, profile_b) to those whose profiles leave room for the overlap they need."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("n_a", "profile_a", "n_b", "profile_b"))
        good = [most_common(p, q) >= least_overlap(x, y, percent) for x, p, y, q in zip(*columns)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _plausible(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) without those that counts of their n-grams by first byte rule out; few bytes a class travel for it."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    known = signed.select("row", "n", "profile").join(asked, "row")
    one, two = (known.select(F.col("row").alias(c), F.col("n").alias(f"n_{c}"), F.col("profile").alias(f"profile_{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(lambda batches: _possible(batches, percent), "a long, b long")


def _common(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, grams_a, grams_b) to those that are similar enough."""
    for batch in batches:
        good = []
        for x, y in zip(array_views(batch.column("grams_a"), np.uint64), array_views(batch.column("grams_b"), np.uint64)):
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            good.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    one, two = (sets.select(F.col("cid").alias(c), F.col("grams").alias(f"grams_{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(lambda batches: _common(batches, percent), "a long, b long")


def _star_pairs(led: DataFrame, classes: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Class pairs (a, b): the classes of each group with the head of every leader that it may link to, and with its own head."""
    need = F.expr(f"({percent} * (n + lead_n) + {99 + percent}) div {100 + percent}")
    fits = (percent * F.greatest("n", "lead_n") <= 100 * F.least("n", "lead_n")) & (F.col("place") <= F.col("n") - need)
    met = led.filter(fits & (F.col("lead_place") <= F.col("lead_n") - need)).select("gid", F.col("lead").alias("of")).distinct()
    heads = groups.select(F.col("gid").alias("of"), F.col("head").alias("b"))
    outer = met.join(classes.select("gid", F.col("cid").alias("a")), "gid").join(heads, "of").select("a", "b")
    inner = classes.join(groups.filter("members > 1").select("gid", "head"), "gid").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    pairs = outer.union(inner).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _open_blocks(led: DataFrame, parts: DataFrame, groups: DataFrame) -> DataFrame:
    """What the leaders leave: comparisons (gram, i, j, members) of entries in different components.

    ``parts`` (part, gid, root) are the classes of a group that are in one
    component.  Of an n-gram whose entries are in several, those outside the
    most frequent component are away, and are compared with all; away entries
    and the others are dealt into blocks of ``BLOCK`` by hash, and only blocks
    of an away side meet.  A group of several classes also is an n-gram of its
    own.  Entries are five numbers; texts and sets do not travel here.
    """
    lead = led.select("gram", F.col("lead_place").alias("place"), F.col("lead").alias("gid"), F.col("lead_n").alias("n")).distinct()
    own = groups.filter("members > 1").select(F.xxhash64("gid").alias("gram"), F.lit(0).cast("long").alias("place"), "gid", "n")
    entries = led.select("gram", "place", "gid", "n").union(lead).union(own).join(parts, "gid").drop("gid")
    sizes = entries.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("gram").agg(F.max(F.struct("n", "root")).alias("home"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("roots"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = open_.filter("roots > 1").select(
        "gram", F.col("home.root").alias("home"), blocks(F.col("total") - F.col("home.n")).alias("aways"), blocks(F.col("home.n")).alias("homes")
    )
    held = entries.join(open_, "gram").withColumn("away", F.col("root") != F.col("home"))
    dealt = lambda n: F.pmod(F.xxhash64("part"), n).cast("int")
    block = F.when(F.col("away"), dealt(F.col("aways"))).otherwise(F.col("aways") + dealt(F.col("homes")))
    others = F.sequence(F.lit(0), F.when(F.col("away"), F.col("aways") + F.col("homes")).otherwise(F.col("aways")) - 1)
    spread = held.withColumn("block", block).withColumn("other", F.explode(others))
    left = F.col("away") & (F.col("block") <= F.col("other"))
    member = F.struct(left.alias("left"), "part", "n", "place", "root")
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    return spread.groupBy("gram", i, j).agg(F.collect_list(member).alias("members"))


def link_components(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE, percent: int = PERCENT, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents are linked when 100 times the number of common n-grams is at
    least ``percent`` times that of all n-grams of both; ``component_id`` is
    the least key that links reach.  Fewer words than ``size`` are one n-gram;
    a document without words, null text or empty, has none and is linked with
    nothing, not even its like.  Null keys are passed over by the minimum, a
    component of null keys alone has a null id; repeated rows are each other's
    copies.  Texts are read whole, of any length.  Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = frequency_table(rows.select("text"), size, buckets)
    kind = docs.schema[key].dataType.simpleString()
    signed = rows.mapInArrow(
        lambda batches: _signed(batches, counts, size, percent), f"doc_id {kind}, n long, same binary, beginning binary, prefix binary, profile binary"
    )
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    wordy = signed.filter("n > 0").groupBy("same")
    classes = written(
        wordy.agg(
            F.min(F.struct("row", "doc_id")).alias("first"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
            F.any_value("n").alias("n"), F.any_value("beginning").alias("beginning"),
        ).select("same", F.col("first.row").alias("cid"), F.col("first.doc_id").alias("of"), "least", "copies", "n", "beginning"),
        "classes",
    )
    groups = classes.groupBy("beginning").agg(
        F.min("cid").alias("gid"), F.max(F.struct("copies", (-F.col("cid")).alias("minus"))).alias("best"),
        F.count(F.lit(1)).alias("members"), F.sum("copies").alias("copies"), F.any_value("n").alias("n"),
    )
    groups = written(groups.withColumn("head", -F.col("best.minus")).drop("best"), "groups")
    grouped = written(classes.join(groups.select("beginning", "gid"), "beginning").select("cid", "least", "same", "of", "gid"), "grouped")
    fronts = groups.select("gid", "n", "copies").join(signed.select(F.col("row").alias("gid"), "prefix"), "gid")
    entries = fronts.mapInArrow(_entries, "gram long, place long, gid long, n long, copies long")
    entries = entries.repartition("gram").sortWithinPartitions("gram", F.desc("copies"), "place", "gid")
    led = written(entries.mapInArrow(_led, "gram long, place long, gid long, n long, lead long, lead_n long, lead_place long"), "led")

    def sets_of(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(grouped, "cid")
        asked = written(asked.select("cid", "same", "of"), "asked")  # a table, so that Spark knows its size before it deals out texts
        of = asked.select(F.col("of").alias("__of")).distinct()
        found = rows.join(of, F.col("doc_id").eqNullSafe(F.col("__of")), "left_semi").select("text")
        found = found.mapInArrow(lambda batches: _sets(batches, size), "same binary, grams binary")
        return written(found.join(asked.select("same", "cid"), "same").dropDuplicates(["cid"]).select("cid", "grams"), "sets")

    stars = written(_star_pairs(led, grouped, groups, percent), "star_pairs")
    likely = written(_plausible(stars, signed, percent), "likely_pairs")
    first = written(_linked(likely, sets_of(likely), percent), "star_links")
    roots = components(first).withColumnRenamed("node", "cid")
    placed = grouped.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    placed = written(placed, "placed")
    parts = placed.groupBy("gid", "root").agg(F.min("cid").alias("part"))
    found = _open_blocks(led, parts, groups).mapInArrow(lambda batches: _block_pairs(batches, percent), "a long, b long").distinct()
    members = placed.join(parts, ["gid", "root"]).select("part", "cid")
    one, two = (members.select(F.col("part").alias(c), F.col("cid").alias(f"cid_{c}")) for c in ("a", "b"))
    rest = found.join(one, "a").join(two, "b").select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b"))
    rest = written(rest.join(stars, ["a", "b"], "left_anti"), "rest_pairs")
    rest = written(_plausible(rest, signed, percent), "likely_pairs")
    second = _linked(rest, sets_of(rest), percent)
    root_of = lambda c: placed.select(F.col("cid").alias(c), F.col("root").alias(f"root_{c}"))
    second = second.join(root_of("a"), "a").join(root_of("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    joined = components(second).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    whole = placed.join(joined, "root", "left").select("same", "least", F.coalesce("joined", "root").alias("component"))
    whole = written(whole, "components")
    names = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = whole.join(names, "component").select("same", "component_id")
    return signed.select("doc_id", F.col("n").alias("n_shingles"), "same").join(named, "same", "left").select(
        "doc_id", "n_shingles", F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
