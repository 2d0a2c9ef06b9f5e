"""How the sources of a language differ in their words, as exact integers.

Each language keeps the terms that enough of its documents use.  A (language,
source) group and the language itself give every kept term a smoothed
probability in whole billionths, and sources are compared on these.  The terms
that set a group apart come from a skyband: a term that is dominated by k
others (used as often or more in the group, as seldom or more seldom in the
language, and earlier in UTF-8) cannot be among its first k.  Partitions keep
their skybands, skybands are merged, and what is left is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeguard.llm.text import byte_texts
from changeguard.session import written

LEAST_DOCS = 30
FIRST = 50
SCALE, SMOOTH = 1_000_000_000, 5
MERGE_SALTS = 16  # merges of one group's skybands; ranking needs no more than that they are small
CHUNK = 4096  # terms whose dense counts are compared at a time
HELD = 200_000  # distinct (group, term) pairs a task holds before it emits them


def _letters() -> bytes:
    """Byte table: A-Z to a-z, a-z and bytes above 0x7F as they are, all else to a space."""
    keep = lambda b: b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    return bytes(keep(b) for b in range(256))


TERM_BYTES = _letters()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), combined over as many rows as fit."""
    uses, docs, held = {}, {}, 0

    def rows() -> pa.RecordBatch:
        flat = [(*group, term, n, docs[group][term]) for group, terms in uses.items() for term, n in terms.items()]
        lang, source, term, n, d = zip(*flat) if flat else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [
                pa.array(lang, pa.string()),
                pa.array(source, pa.string()),
                pa.array(term, pa.binary()).cast(pa.string()),
                pa.array(n, pa.int64()),
                pa.array(d, pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_texts(batch.column(2))):
            group = (lang, source)
            mine = uses.setdefault(group, Counter())
            before = len(mine)
            found = Counter(text.translate(TERM_BYTES).split())
            mine.update(found)
            docs.setdefault(group, Counter()).update(found.keys())
            held += len(mine) - before
            if held > HELD:
                yield rows()
                uses, docs, held = {}, {}, 0
    yield rows()


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n, sources: array of (source, n)): the terms that ``least_docs`` documents of the language use.

    ``docs`` has lang, source and text without nulls.  Tasks combine their
    counts before the one shuffle; an array holds a source once.
    """
    rows = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    each = rows.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = each.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return whole.filter(F.col("docs") >= least_docs).drop("docs")


def _billionths(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)); decimals, since a count may be over nine billion."""
    return F.expr(f"1 + ({SCALE} * cast({n} + {SMOOTH} as decimal(20, 0))) div cast({total} + {SMOOTH} * {terms} as decimal(20, 0))")


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (lang, terms, size, groups) to (lang, one, two, value): sums of differences of each two groups over the chunk."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            groups, size = row["groups"], row["size"]
            place = {g["source"]: i for i, g in enumerate(groups)}
            big = max(max((s["n"] for t in row["terms"] for s in t["sources"]), default=0), 5) > 9_000_000_000
            counts = np.zeros((len(row["terms"]), len(groups)), object if big else np.int64)
            for i, t in enumerate(row["terms"]):
                for s in t["sources"]:
                    counts[i, place[s["source"]]] = s["n"]
            under = np.array([g["n"] + SMOOTH * size for g in groups], counts.dtype)
            p = SCALE * (counts + SMOOTH) // under + 1
            for i in range(len(groups) - 1):
                sums = np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(axis=0)
                out += [(row["lang"], groups[i]["source"], groups[j]["source"], int(v)) for j, v in enumerate(sums, i + 1)]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "one", "two", "value"])


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): each ordered pair of a language's sources with its summed difference.

    ``groups`` is (lang, source, n, size, lang_n).  There are as many rows as
    the result asks for; the sums come from chunks of terms and are combined
    before they are shuffled.
    """
    lists = groups.groupBy("lang").agg(
        F.any_value("size").alias("size"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("groups")
    )
    chunk = F.pmod(F.xxhash64("term"), F.ceil(F.col("size") / CHUNK).cast("long"))
    chunks = (
        kept.join(lists.select("lang", "size"), "lang")
        .groupBy("lang", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("sources")).alias("terms"))
        .join(lists, "lang")
        .select("lang", "terms", "size", "groups")
    )
    sums = chunks.mapInArrow(_pair_sums, "lang string, one string, two string, value long")
    sums = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    names = lists.select("lang", F.transform("groups", lambda g: g["source"]).alias("names"))
    pairs = (
        names.select("lang", F.explode("names").alias("one"), "names")
        .select("lang", "one", F.explode("names").alias("two"))
        .filter("one < two")
        .join(sums, ["lang", "one", "two"], "left")
        .withColumn("value", F.coalesce("value", F.lit(0)))
    )
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    return pairs.select("lang", both.alias("side"), "value").select("lang", "side.source", "side.item", "value")


def skyband(n: np.ndarray, lang_n: np.ndarray, item: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate: ``n`` as high, ``lang_n`` as low, ``item`` earlier.

    In order of lang_n, every dominator of a row stands before it; of those
    before it, only kept ones and those of its own block need be counted.
    """
    rank = np.empty(len(item), np.int64)
    rank[np.argsort(item, kind="stable")] = np.arange(len(item))
    order = np.lexsort((rank, -n, lang_n))
    kept = order[:0]
    for at in range(0, len(order), 512):
        block = order[at : at + 512]
        before = np.concatenate([kept, block])
        over = (n[before][None, :] >= n[block][:, None]) & (rank[before][None, :] < rank[block][:, None])
        over[:, len(kept) :] &= np.tri(len(block), k=-1, dtype=bool)
        kept = np.concatenate([kept, block[over.sum(axis=1) < k]])
    return kept


def _skybands(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of (lang, source, salt, term, n, lang_n), the skyband of each (lang, source, salt) of the partition."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    _, run = np.unique(np.array(["\0".join((a, b, str(c))) for a, b, c in zip(*(table.column(i).to_pylist() for i in range(3)))], object), return_inverse=True)
    n, lang_n = table.column("n").to_numpy(), table.column("lang_n").to_numpy()
    term = np.array([t.encode() for t in table.column("term").to_pylist()], object)
    order = np.argsort(run, kind="stable")
    ends = np.flatnonzero(np.diff(run[order])) + 1
    keep = [rows[skyband(n[rows], lang_n[rows], term[rows], k)] for rows in np.split(order, ends)]
    yield from table.take(pa.array(np.concatenate(keep))).combine_chunks().to_batches()


def telling_terms(kept: DataFrame, groups: DataFrame, first: int = FIRST) -> DataFrame:
    """(lang, source, item, value, rank): the ``first`` terms by which each group exceeds its language most."""
    rows = kept.withColumnRenamed("n", "lang_n").select("lang", F.explode("sources").alias("s"), "term", "lang_n").filter("s.n > 0")
    rows = rows.select("lang", "s.source", F.lit(0).alias("salt"), "term", "s.n", "lang_n")
    shape = "lang string, source string, salt int, term string, n long, lang_n long"
    local = rows.mapInArrow(lambda batches: _skybands(batches, first), shape)
    salted = local.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(MERGE_SALTS)).cast("int"))
    merged = salted.repartition("lang", "source", "salt").mapInArrow(lambda batches: _skybands(batches, first), shape)
    named = groups.select("lang", "source", F.col("n").alias("group_n"), "size", F.col("lang_n").alias("total"))
    p, q = _billionths("n", "group_n", "size"), _billionths("lang_n", "total", "size")
    valued = merged.join(named, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).filter("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, first: int = FIRST) -> DataFrame:
    """One row per finding: lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language with the summed
    difference of all kept terms (0 without kept terms).  Part ``term``: the
    first terms that the group uses more than its language does.  Ranks are
    by value descending, then item; a tie in both cannot be, items are
    distinct.  Null lang, source or text count as empty; a group without terms
    has its pairs and no term rows, an empty table no rows.  Repeated rows and
    doc_ids count as often as they stand there.  Texts are read whole, one at
    a time.  Columns other than lang, source and text are not read.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = written(kept_terms(docs, least_docs), "kept_terms")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("lang_n"))
    used = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = written(groups.na.fill(0, ["n", "size", "lang_n"]), "source_groups")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(kept, groups).withColumn("rank", F.row_number().over(by_value))
    terms = telling_terms(kept, groups, first)
    shaped = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shaped(pairs, "pair").union(shaped(terms, "term"))
