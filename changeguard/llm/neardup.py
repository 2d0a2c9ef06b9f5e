"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

Shingles are five words.  Their weights are sublinear term frequency times a
damped inverse document frequency.  Improved consistent weighted sampling
draws ``BANDS * ROWS`` (shingle, level) samples per document that two
documents share with a probability equal to their weighted Jaccard
similarity.  Documents that share all samples of a band are candidates; every
link that is used is verified on the exact weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.llm.components import components
from changeguard.llm.text import array_views, byte_texts, mixed, shingles, word_hashes
from changeguard.session import small_batches, written

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 12, 4  # a pair at 0.8 shares a band with probability 0.998, one at 0.3 with 0.09
SAMPLES = BANDS * ROWS
LEAST_SHARED = SAMPLES // 2
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20  # of members of one key that are compared with as many others at a time

# Document frequencies are counted by hash of the shingle.  A document of a
# thousand shingles raises the floor of each counter by 0.4 % of the
# documents at any size of the corpus: only frequent shingles stand out.
BUCKETS = 1 << 18
# A group of near copies makes its own shingles frequent.  The floor keeps
# that from lowering their similarity: weights differ by a tenth at most.
IDF_FLOOR = 0.9
IDF_FULL = 1000.0  # rarer than one document in so many: full weight

_rng = np.random.default_rng(20240607)
_SIZE = 1 << 16
GAMMA_R = _rng.gamma(2.0, 1.0, _SIZE).astype(np.float32)
LOG_C = np.log(_rng.gamma(2.0, 1.0, _SIZE)).astype(np.float32)
BETA = _rng.random(_SIZE, np.float32)
MULTIPLIERS = _rng.integers(1, 1 << 62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in byte_texts(batch.column(0)):
            counts[np.unique(_bucket(shingles(word_hashes(text))))] += 1
            docs += 1
    some = np.flatnonzero(counts)
    for part in np.array_split(some, 1 + len(some) // 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["bucket", "n"])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([docs], pa.int64())], names=["bucket", "n"])


def idf_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The IDF factor of each bucket, counted over all documents; a table of fixed size."""
    rows = docs.select(text).mapInArrow(_frequencies, "bucket long, n long")
    with small_batches(docs.sparkSession):
        found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts, place = np.zeros(BUCKETS + 1), found["bucket"].to_numpy()
    counts[place] = found["n"].to_numpy()
    rarity = np.log((counts[-1] + 1) / (counts[:-1] + 1)) / np.log(IDF_FULL)
    return (IDF_FLOOR + (1 - IDF_FLOOR) * np.clip(rarity, 0, 1)).astype(np.float32)


def weighted(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text, in order, and their weights."""
    found, tf = np.unique(shingles(word_hashes(text), SHINGLE), return_counts=True)
    return found, ((1 + np.log(tf)) * idf[_bucket(found)]).astype(np.float32)


def samples(found: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sampled (shingle, level) hashes: one row per document, one column per sample.

    ``starts`` are the offsets of the documents, none of them empty.
    """
    log_w, sizes = np.log(weights), np.diff(np.append(starts, len(found)))
    out = np.empty((len(starts), SAMPLES), np.uint64)
    for j in range(SAMPLES):
        at = ((found * MULTIPLIERS[j]) >> np.uint64(48)).astype(np.int64)
        r, beta = GAMMA_R[at], BETA[at]
        level = np.floor(log_w / r + beta)
        log_a = LOG_C[at] - r * (level - beta) - r
        least = np.repeat(np.minimum.reduceat(log_a, starts), sizes)
        hits = np.flatnonzero(log_a == least)
        first = hits[np.searchsorted(hits, starts)]
        out[:, j] = mixed(found[first] ^ (level[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def _signatures(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds to (doc_id, digest, text): same (hash of the words), bands, marks (a byte per sample); no words: null."""
    for batch in batches:
        texts = byte_texts(batch.column("text"))
        same, bands, marks = [None] * len(texts), [None] * len(texts), [None] * len(texts)
        held, size = [], 0

        def flush(held=held):
            found = [f for _, f, _ in held]
            starts = np.concatenate(([0], np.cumsum([len(f) for f in found])[:-1])).astype(np.int64)
            drawn = samples(np.concatenate(found), np.concatenate([w for _, _, w in held]), starts)
            key = np.zeros((len(held), BANDS), np.uint64)
            for j in range(ROWS):
                key = key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, j::ROWS]
            key = mixed(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            for k, (row, _, _) in enumerate(held):
                bands[row] = key[k]
                marks[row] = (drawn[k] >> np.uint64(56)).astype(np.uint8).tobytes()

        for row, text in enumerate(texts):
            hashes = word_hashes(text)
            if not len(hashes):
                continue
            same[row] = xxhash.xxh3_128_hexdigest(hashes.tobytes())
            found, tf = np.unique(shingles(hashes, SHINGLE), return_counts=True)
            held.append((row, found, ((1 + np.log(tf)) * idf[_bucket(found)]).astype(np.float32)))
            size += len(found)
            if size > 50_000:
                flush()
                held.clear()
                size = 0
        if held:
            flush()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("digest"),
                pa.array(same, pa.string()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(marks, pa.binary()),
            ],
            names=["doc_id", "digest", "same", "bands", "marks"],
        )


def _features(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [weighted(t, idf) for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("cid"),
                pa.array([f.tobytes() for f, _ in both], pa.binary()),
                pa.array([w.tobytes() for _, w in both], pa.binary()),
            ],
            names=["cid", "found", "weights"],
        )


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two documents as sorted distinct shingles with weights."""
    place = np.searchsorted(b[0], a[0])
    inside = place < len(b[0])
    inside[inside] = b[0][place[inside]] == a[0][inside]
    common = float(np.minimum(a[1][inside], b[1][place[inside]]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    return common / (total - common) if total else 0.0


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        read = lambda name, kind: array_views(batch.column(name), kind)  # noqa: B023, E731
        one = zip(read("found_a", np.uint64), read("weights_a", np.float32))
        two = zip(read("found_b", np.uint64), read("weights_b", np.float32))
        similar = [weighted_jaccard(a, b) for a, b in zip(one, two)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(similar, pa.float64())], names=["a", "b", "similarity"]
        )


def _shared(one: Column, two: Column) -> Column:
    """How many of the samples two documents share, up to chance matches of a byte in 256."""
    byte = lambda c, i: F.substring(c, i + 1, 1)
    return sum((F.when(byte(one, i) == byte(two, i), 1).otherwise(0) for i in range(SAMPLES)), F.lit(0))


def _stars(members: DataFrame) -> DataFrame:
    """``members`` (key, cid, copies) to (a, b, key): each class with the class of its key that has most copies.

    The leader of a key is found by an aggregation and joined back; a key that
    a third of all classes share is one row on the right of that join.
    """
    leaders = (
        members.groupBy("key")
        .agg(F.max(F.struct("copies", (-F.col("cid")).alias("minus"))).alias("best"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("key", (-F.col("best.minus")).alias("b"))
    )
    return members.join(leaders, "key").filter("cid <> b").select(F.col("cid").alias("a"), "b", "key")


def links(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of ``classes`` (cid, copies, bands, marks) with the leaders of their keys; the keys' other pairs.

    In each band, all classes are paired with the one of most copies: near
    copies of a document are closest to it.  Pairs that share less than half of
    the samples are not near 0.8 (five standard deviations) and go.  The second
    table, (key, cid), has the members but the leader of all keys that have
    three or more: they are yet to be compared with each other.
    """
    members = classes.select("cid", "copies", F.explode("bands").alias("key"))
    stars = written(_stars(members), "stars")
    marks = classes.select("cid", "marks")
    one, two = marks.withColumnsRenamed({"cid": "a", "marks": "m1"}), marks.withColumnsRenamed({"cid": "b", "marks": "m2"})
    pairs = stars.select("a", "b").distinct().join(one, "a").join(two, "b").filter(_shared(F.col("m1"), F.col("m2")) >= LEAST_SHARED)
    several = stars.groupBy("key").count().filter("count > 1").select("key")
    rest = stars.join(several, "key").select("key", F.col("a").alias("cid"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), rest


def _blocks(rest: DataFrame, placed: DataFrame, features: DataFrame) -> DataFrame:
    """The comparisons that stars leave: key, i, j, members (cid, root, away, bands, marks, found, weights).

    ``rest`` (key, cid) are members of a key without its leader, ``placed``
    (cid, root, bands, marks) has the groups that the stars made.  In a key
    whose members are all in one group nothing is left to do.  Else those
    outside its largest group are away, and are compared with all members.
    Each member is in one block of its key, drawn by hash; comparison (i, j) is
    of the away members of block i with the members of block j.
    """
    known = rest.join(placed.select("cid", "root"), "cid")
    sizes = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    opened = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("n", "root")).alias("home"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"))
        .filter("roots > 1")
        .select("key", "home.root", "n")
        .withColumnRenamed("root", "home")
    )
    opened = written(known.join(opened, "key").withColumn("away", F.col("root") != F.col("home")).drop("home"), "open")
    held = opened.join(placed.select("cid", "bands", "marks"), "cid").join(features, "cid")
    bytes_of = held.groupBy("key").agg(F.sum(F.length("found")).alias("bytes"))
    held = held.join(bytes_of, "key")
    n_blocks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    held = held.withColumn("blocks", n_blocks).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # only blocks with an away member have comparisons
    sides = held.filter("away").select("key", "block").distinct().withColumnRenamed("block", "i")
    member = F.struct("cid", "root", "bands", "marks", "found", "weights").alias("member")
    right = held.join(sides, "key").select("key", "i", F.col("block").alias("j"), F.lit(False).alias("left"), "away", member)
    left = held.filter("away").select(
        "key", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("left"), "away", member
    )
    return left.union(right).groupBy("key", "i", "j").agg(F.collect_list(F.struct("left", "away", "member")).alias("members"))


def _compared(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Links (a, b, similarity, root_a, root_b) of the comparisons of ``_blocks``.

    Pairs of one group are passed over, also of groups that were joined here
    just now.  A pair that shares several keys is compared in the first.
    """
    for batch in batches:
        out = []
        for key, members in zip(batch.column("key").to_pylist(), batch.column("members")):
            rows = members.as_py()
            one, two = ([r["member"] | {"away": r["away"]} for r in rows if r["left"] == side] for side in (True, False))
            if not one or not two:
                continue
            read = lambda rows: [(np.frombuffer(r["found"], np.uint64), np.frombuffer(r["weights"], np.float32)) for r in rows]
            f1, f2 = read(one), read(two)
            total = np.array([w.sum(dtype=np.float64) for _, w in f2])
            cids, away = np.array([r["cid"] for r in two]), np.array([r["away"] for r in two])
            marks = np.frombuffer(b"".join(r["marks"] for r in two), np.uint8).reshape(-1, SAMPLES)
            bands = np.array([r["bands"] for r in two], np.int64)
            own = {r["root"]: r["root"] for r in (*one, *two)}
            roots = np.array([r["root"] for r in two])
            for r, (found, weights) in zip(one, f1):
                own_bands = np.array(r["bands"], np.int64)
                place = int(np.flatnonzero(own_bands == key)[0])
                shared = (marks == np.frombuffer(r["marks"], np.uint8)).sum(axis=1)
                weight = weights.sum(dtype=np.float64)
                good = (shared >= LEAST_SHARED) & (roots != own[r["root"]]) & (~away | (cids > r["cid"]))
                good &= np.minimum(total, weight) >= (similar - 1e-6) * np.maximum(total, weight)
                good &= ~(bands[:, :place] == own_bands[:place]).any(axis=1)
                at = np.flatnonzero(good)
                for k in at[np.argsort(-shared[at], kind="stable")]:
                    mine, other = own[r["root"]], roots[k]
                    if mine == other:
                        continue
                    value = weighted_jaccard((found, weights), f2[k])
                    if value >= similar:
                        out.append((r["cid"], two[k]["cid"], value, r["root"], two[k]["root"]))
                        roots[roots == other] = mine
                        for root in own:
                            if own[root] == other:
                                own[root] = mine
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "similarity", "root_a", "root_b"]
        )


def _written(df: DataFrame, name: str) -> DataFrame:
    """``written`` for steps that hand texts or features to Python."""
    with small_batches(df.sparkSession):
        return written(df, name)


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, group_id, group_size, n_links, kept, digest.

    ``class_id`` is the least key among the documents of the same words;
    classes with a weighted Jaccard similarity of ``similar`` or more are
    linked, and linked classes are one group, named by its least key
    (``n_links`` are the links of the class that were needed to find it).  One row of each group is kept: the one with the
    least key, of repeated rows any one.  Documents without a word, null or
    empty, are groups of their own.  Null keys come first in order.  ``digest``
    is that of the text, to tell rows of one key apart.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.md5(F.encode(whole, "utf-8")).alias("digest"), whole.alias("text"))
    idf = idf_table(rows)
    signed = _written(
        rows.mapInArrow(
            lambda batches: _signatures(batches, idf),
            f"doc_id {docs.schema[key].dataType.simpleString()}, digest string, same string, bands array<long>, marks binary",
        ).withColumn("row", F.monotonically_increasing_id()),
        "signatures",
    )
    named = F.coalesce("same", F.concat(F.lit("row "), F.col("row")))
    classes = written(
        signed.groupBy(named.alias("same"))
        .agg(
            F.min(F.struct("doc_id", "row", "digest")).alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.any_value("bands").alias("bands"),
            F.any_value("marks").alias("marks"),
        )
        .withColumn("cid", F.col("rep.row")),
        "classes",
    )
    pairs, rest = (written(t, n) for t, n in zip(links(classes.filter("bands is not null")), ("pairs", "rest")))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cid")).union(rest.select("cid")).distinct()
    wanted = asked.join(classes, "cid").select(
        "cid", F.col("rep.doc_id").alias("rep_id"), F.col("rep.digest").alias("rep_digest")
    )
    features = _written(
        rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("digest") == F.col("rep_digest")))
        .select("cid", "text")
        .mapInArrow(lambda batches: _features(batches, idf), "cid long, found binary, weights binary")
        .dropDuplicates(["cid"]),
        "features",
    )
    one = features.withColumnsRenamed({"cid": "a", "found": "found_a", "weights": "weights_a"})
    two = features.withColumnsRenamed({"cid": "b", "found": "found_b", "weights": "weights_b"})
    linked = _written(
        pairs.join(one, "a")
        .join(two, "b")
        .mapInArrow(_verified, "a long, b long, similarity double")
        .filter(F.col("similarity") >= similar),
        "links",
    )
    roots = components(linked.select("a", "b")).withColumnRenamed("node", "cid")
    starred = written(
        classes.select("same", "cid", "copies", "rep", "bands", "marks")
        .join(roots, "cid", "left")
        .withColumn("root", F.coalesce("root", "cid")),
        "starred",
    )
    compared = _written(
        _blocks(rest, starred, features).mapInArrow(
            lambda batches: _compared(batches, similar), "a long, b long, similarity double, root_a long, root_b long"
        ),
        "compared",
    )
    both = linked.select("a", "b").union(compared.select(F.least("a", "b"), F.greatest("a", "b"))).distinct()
    degree = both.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count(F.lit(1)).alias("n_links"))
    joined = components(compared.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("joined"))
    placed = (
        starred.select("same", "cid", "copies", "rep", "root")
        .join(degree, "cid", "left")
        .join(joined, "root", "left")
        .withColumn("root", F.coalesce("joined", "root"))
    )
    placed = written(placed, "placed")
    groups = placed.groupBy("root").agg(F.min("rep").alias("first"), F.sum("copies").alias("group_size"))
    where = placed.join(groups, "root").select("same", "rep", "first", "group_size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return (
        signed.select("doc_id", "digest", "row", named.alias("same"))
        .join(where, "same")
        .select(
            "doc_id",
            F.col("rep.doc_id").alias("class_id"),
            F.col("first.doc_id").alias("group_id"),
            "group_size",
            "n_links",
            (F.col("row") == F.col("first.row")).alias("kept"),
            "digest",
        )
    )


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group of near copies; all columns stay as they are."""
    kept = near_groups(docs, text, key, similar).filter("kept")
    kept = kept.select(F.col("doc_id").alias("__kept_id"), F.col("digest").alias("__kept"))
    marked = docs.withColumn("__digest", F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")))
    same = marked[key].eqNullSafe(F.col("__kept_id")) & (F.col("__digest") == F.col("__kept"))
    return marked.join(kept, same, "left_semi").dropDuplicates([key, "__digest"]).drop("__digest")
