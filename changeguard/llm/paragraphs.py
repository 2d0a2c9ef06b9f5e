"""Repeated passages by MinHash over moving paragraphs.

A passage may stand anywhere in a document, so every run of ``PARAGRAPH``
words is a paragraph.  Its MinHash value in a band is the least of its hashed
five-word shingles; neighbouring paragraphs mostly have the same one, so a
document is about one value in twenty words and band.  Bands have one row:
two paragraphs at a Jaccard similarity of 0.8 share a value with probability
0.96 in two bands, equal ones always.  Colliding paragraphs are verified on the
Jaccard similarity of their aligned shingles, and repeats are clustered by
connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeguard.llm.components import components
from changeguard.llm.text import array_views, byte_texts, mixed, shingles, word_hashes
from changeguard.session import written

PARAGRAPH = 46  # words
SHINGLE = 5
WIDTH = PARAGRAPH - SHINGLE + 1  # shingles of a paragraph
SIMILAR = 0.8
RUN = 38  # shingles of a paragraph of which all others differ, where it just reaches SIMILAR
LEAST_COMMON = min(n for n in range(WIDTH + 1) if n / (2 * WIDTH - n) >= SIMILAR)
BANDS = 2
DRIFT = 2  # words that a passage may shift by insertions inside one paragraph
BAND_SEEDS = np.array([[0x243F6A8885A308D3], [0x13198A2E03707344]], np.uint64)


def least_places(v: np.ndarray, width: int) -> np.ndarray:
    """Where the least value of each run of ``width`` stands, the first of equal ones; never falls.  Rows of ``v`` are apart.

    Runs are put together from two of half the width, the last ones from two that overlap.
    """
    least, at, size = v, np.broadcast_to(np.arange(v.shape[-1]), v.shape), 1
    while size < width:
        step = min(size, width - size)
        later = least[..., step:] < least[..., :-step]
        least = np.minimum(least[..., step:], least[..., :-step])
        at = np.where(later, at[..., step:], at[..., :-step])
        size += step
    return at


def minima(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct MinHash values over all paragraphs of a text, and where each first stands.

    Values of different bands differ by their lowest bit.
    """
    if len(found) < WIDTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    v = mixed(found ^ BAND_SEEDS)
    at = least_places(v, WIDTH)
    new = np.ones(at.shape, bool)
    np.not_equal(at[:, 1:], at[:, :-1], out=new[:, 1:])
    band, run = np.nonzero(new)
    places = at[band, run]
    values = (v[band, places] & ~np.uint64(1)) | band.astype(np.uint64)
    order = np.argsort(values, kind="stable")
    values, places = values[order], places[order]
    first = np.append(True, values[1:] != values[:-1])
    return values[first], places[first]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [minima(shingles(word_hashes(t), SHINGLE)) for t in byte_texts(batch.column("text"))]
        ends = pa.array(np.cumsum([0, *(len(v) for v, _ in both)]), pa.int32())
        lists = [
            pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, kind), *(x[i].view(kind) for x in both)])))
            for i, kind in ((0, np.int64), (1, np.int64))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), lists[0], lists[1].cast(pa.list_(pa.int32()))],
            names=["doc_id", "digest", "values", "places"],
        )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wants: list of first, last) to one row per want with the shingles around it.

    32 bits of a shingle travel: enough to tell places apart that stand beside
    each other, which is all that cut-outs are compared on.
    """
    for batch in batches:
        rows, firsts, lasts, starts, around = [], [], [], [], []
        for row, text, wants in zip(batch.column("row").to_pylist(), byte_texts(batch.column("text")), batch.column("wants").to_pylist()):
            found = (shingles(word_hashes(text), SHINGLE) >> np.uint64(32)).astype(np.uint32)
            for want in wants:
                start = max(0, want["first"] - WIDTH)
                rows.append(row)
                firsts.append(want["first"])
                lasts.append(want["last"])
                starts.append(start)
                around.append(found[start : want["last"] + WIDTH + 1].tobytes())
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip((rows, firsts, lasts, starts, around), kinds)],
            names=["row", "first", "last", "start", "around"],
        )


def run_starts(places: np.ndarray, size: int) -> np.ndarray:
    """Where runs of ``RUN`` begin that a paragraph around one of the places may hold, in a text of ``size`` shingles."""
    low, high = np.maximum(places + 1 - WIDTH, 0), np.minimum(places + WIDTH - RUN, size - RUN) + 1
    change = np.bincount(low, minlength=size + 1) - np.bincount(high, minlength=size + 1)
    return np.flatnonzero(np.cumsum(change) > 0)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, places) to (value, row, place): each run of ``RUN`` shingles that a paragraph around one of the places may hold."""
    for batch in batches:
        out, size = [], 0

        def flush(out=out):
            value, row, place = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(row), pa.array(place.astype(np.int32))], names=["value", "row", "place"]
            )

        for row, text, places in zip(batch.column("row").to_pylist(), byte_texts(batch.column("text")), batch.column("places").to_pylist()):
            found = shingles(word_hashes(text), SHINGLE)
            if len(found) < WIDTH:
                continue
            starts = run_starts(np.array(places), len(found))
            out.append((shingles(found, RUN)[starts], np.full(len(starts), row, np.int64), starts))
            size += len(starts)
            if size > 200_000:
                yield flush()
                out.clear()
                size = 0
        if out:
            yield flush()


def common_spans(one: np.ndarray, two: np.ndarray, shift: int) -> list[tuple[int, int, int, int]]:
    """Passages that two texts share, as shingles, where ``two`` stands ``shift`` places after ``one``.

    A place counts as common when the other text has its shingle at most
    ``DRIFT`` places away.  Where the aligned paragraphs around it reach the
    Jaccard similarity, all common places in them are part of a passage:
    (first, past last) in one, and in two, in words.
    """
    size = len(one)
    if size < WIDTH:
        return []
    both = np.zeros(size, bool)
    found = []
    for drift in sorted(range(-DRIFT, DRIFT + 1), key=abs, reverse=True):
        ahead = shift + drift
        low, high = max(0, -ahead), min(size, len(two) - ahead)
        if low < high:
            same = one[low:high] == two[low + ahead : high + ahead]
            both[low:high] |= same
            found.append((low, ahead, same))
    # 2 * WIDTH * SIMILAR / (1 + SIMILAR) places are needed in one paragraph
    if np.count_nonzero(both) < LEAST_COMMON:
        return []
    sums = np.concatenate(([0], np.cumsum(both)))
    inside = sums[WIDTH:] - sums[:-WIDTH]
    fits = np.flatnonzero(inside / (2 * WIDTH - inside) >= SIMILAR)
    spans = []
    if len(fits):
        partner = np.full(size, -1)
        for low, ahead, same in found:
            at = low + np.flatnonzero(same)
            partner[at] = at + ahead
        breaks = np.flatnonzero(np.diff(fits) > WIDTH)
        for start, end in zip(fits[np.concatenate(([0], breaks + 1))], fits[np.concatenate((breaks, [len(fits) - 1]))]):
            part = start + np.flatnonzero(both[start : end + WIDTH])
            other = partner[part]
            spans.append((int(part[0]), int(part[-1]) + SHINGLE, int(other.min()), int(other.max()) + SHINGLE))
    return spans


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        around = {f"around_{x}": array_views(batch.column(f"around_{x}"), np.uint32) for x in "ab"}
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names if n not in around} | around
        for i in range(batch.num_rows):
            one, two = (cols[f"around_{x}"][i] for x in "ab")
            start_a, start_b = cols["start_a"][i], cols["start_b"][i]
            # the texts differ by first_b - first_a; the cut-outs begin elsewhere
            shift = (cols["first_b"][i] - start_b) - (cols["first_a"][i] - start_a)
            for a0, a1, b0, b1 in common_spans(one, two, shift):
                out.append((cols["a"][i], start_a + a0, start_a + a1, cols["b"][i], start_b + b0, start_b + b1))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.int32()] * 2
        names = ["a", "a_start", "a_end", "b", "b_start", "b_end"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per repeated passage of each document: doc_id, start, end (words), cluster_id, kept, digest.

    Passages have at least about ``PARAGRAPH`` words.  ``cluster_id`` is the
    least key of the documents that hold the passage or one connected with it.
    A passage that an earlier row holds is a removal; so the first row of each
    content keeps it.  Overlapping removals of a document are one, and so are
    overlapping kept passages.  Texts under ``PARAGRAPH`` words, null and empty
    ones have none; repeated rows repeat each other.  Null keys come first in
    order.  ``digest`` is that of the text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.md5(F.encode(whole, "utf-8")).alias("digest"), whole.alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    anchors = written(
        rows.mapInArrow(_anchors, f"doc_id {kind}, digest string, values array<long>, places array<int>").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "anchors",
    )
    values = anchors.select("row", F.explode(F.arrays_zip("values", "places")).alias("x")).select(
        "row", F.col("x.values").alias("value"), F.col("x.places").alias("place")
    )
    # Each document is matched with the first and the last one that has the value: a value that
    # the one shares by chance alone seldom does not come with the passage in the other.  Those
    # that neither answers for are matched on exact runs.
    here = F.struct("row", "place")
    ends = values.groupBy("value").agg(F.min(here).alias("lo"), F.max(here).alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo.row <> hi.row")
    pair = F.explode(F.array(F.struct(here.alias("a"), F.col("lo").alias("b")), F.struct(F.col("hi").alias("a"), here.alias("b"))))
    found = _found(values.join(ends, "value").select(pair.alias("p")).filter("p.a.row <> p.b.row"), rows, anchors)
    more = _found(_run_pairs(values, ends, found, rows, anchors), rows, anchors)
    return _clustered(found.union(more).distinct(), anchors)


def _texts(rows: DataFrame, anchors: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked``, one line per row number, with the text of the row.

    Rows of one digest have one text, so one of them answers for all; texts
    that nothing is asked of stay where they are.
    """
    wanted = written(asked.join(anchors.select("row", "digest"), "row"), "wanted")
    texts = rows.select("digest", "text").join(wanted.select("digest").distinct(), "digest", "left_semi")
    return texts.dropDuplicates(["digest"]).join(wanted, "digest")


def _found(pairs: DataFrame, rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """The passages around colliding places ``p`` (a, b: row, place) that verification finds."""
    # Values that two documents share at one distance are one match.
    matches = written(
        pairs.groupBy(
            F.col("p.a.row").alias("a"), F.col("p.b.row").alias("b"), (F.col("p.b.place") - F.col("p.a.place")).alias("shift")
        )
        .agg(
            F.min("p.a.place").alias("first_a"), F.max("p.a.place").alias("last_a"),
            F.min("p.b.place").alias("first_b"), F.max("p.b.place").alias("last_b"),
        ),
        "matches",
    )
    wants = matches.select(F.col("a").alias("row"), F.col("first_a").alias("first"), F.col("last_a").alias("last")).union(
        matches.select("b", "first_b", "last_b")
    )
    wants = wants.distinct().groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("wants"))
    contexts = written(
        _texts(rows, anchors, wants).select("row", "text", "wants").mapInArrow(
            _contexts, "row long, first int, last int, start int, around binary"
        ),
        "contexts",
    )
    side = lambda x: contexts.withColumnsRenamed(
        {"row": x, **{n: f"{n}_{x}" for n in ("first", "last", "start", "around")}}
    )
    joined = matches.join(side("a"), ["a", "first_a", "last_a"]).join(side("b"), ["b", "first_b", "last_b"])
    return written(
        joined.mapInArrow(_verified, "a long, a_start int, a_end int, b long, b_start int, b_end int"), "common"
    )


def _run_pairs(values: DataFrame, ends: DataFrame, found: DataFrame, rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Pairs ``p`` of places for values whose first and last holder do not answer for all others.

    Such a value is a shingle of a frequent line, and its holders may share
    passages among themselves.  All of them are matched anew on every run of
    ``RUN`` shingles around the value.  Two places with the same run always
    pass the verification, so the first holder of a run answers for all.
    """
    spans = found.select(F.col("a").alias("row"), F.col("a_start").alias("start"), F.col("a_end").alias("end")).union(
        found.select("b", "b_start", "b_end")
    )
    answered = _islands(spans.distinct(), 0).select("row", "start", "end")
    held = values.join(ends.filter("n > 2"), "value")
    here = F.struct("row", "place")
    left = held.filter((here != F.col("lo")) & (here != F.col("hi"))).alias("h").join(
        answered.alias("s"), (F.col("h.row") == F.col("s.row")) & F.col("h.place").between(F.col("s.start"), F.col("s.end") - 1), "left_anti"
    )
    opened = left.select("value").distinct()
    asked = values.join(opened, "value").groupBy("row").agg(F.collect_set("place").alias("places"))
    runs = written(
        _texts(rows, anchors, asked).select("row", "text", "places").mapInArrow(_runs, "value long, row long, place int"), "runs"
    )
    firsts = runs.groupBy("value").agg(F.min(here).alias("lo"), F.max("row").alias("last")).filter("lo.row <> last")
    return runs.join(firsts, "value").filter("row <> lo.row").select(F.struct(here.alias("a"), F.col("lo").alias("b")).alias("p"))


SPANS = "array<struct<start:int,end:int>>"


def _islands(spans: DataFrame, kind: int) -> DataFrame:
    """Spans of a row that overlap or touch as one: row, start, end, spans, node (written, so that it is the same to all)."""
    in_order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", (F.col("start") > F.coalesce(before, F.lit(-1))).cast("int"))
    found = (
        opened.withColumn("part", F.sum("new").over(in_order))
        .groupBy("row", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_list(F.struct("start", "end")).alias("spans"))
        .withColumn("node", F.monotonically_increasing_id() * 2 + kind)
    )
    return written(found, "islands")


def _clustered(found: DataFrame, anchors: DataFrame) -> DataFrame:
    """Spans that overlap in a document are one passage; linked passages are one cluster."""
    ends = found.select(
        F.col("a").alias("row"), F.col("a_start").alias("start"), F.col("a_end").alias("end"), F.lit(True).alias("removal")
    ).union(found.select("b", "b_start", "b_end", F.lit(False)))
    spans = written(ends.groupBy("row", "start", "end").agg(F.max("removal").alias("removal")), "spans")
    removals = _islands(spans.filter("removal"), 0)
    # A kept span that lies in removals but for a few words is what they are about, seen in another match.
    seen = spans.filter(~F.col("removal")).select("row", "start", "end")
    over = removals.select("row", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "node")
    common = F.least("end", "r_end") - F.greatest("start", "r_start")
    inside = seen.join(over, "row").filter(common >= 0.8 * (F.col("end") - F.col("start")))
    inside = inside.groupBy("row", "start", "end").agg(F.max("node").alias("node"))
    kept = _islands(seen.join(inside, ["row", "start", "end"], "left_anti"), 1)
    more = inside.groupBy("node").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    removals = removals.join(more, "node", "left").withColumn("spans", F.concat("spans", F.coalesce("more", F.array().cast(SPANS))))
    columns = ["row", "node", "start", "end", "spans"]
    passages = removals.select(*columns, F.lit(True).alias("removal")).union(
        kept.select(*columns, F.lit(False).alias("removal"))
    )
    passages = written(passages, "passages")
    span = passages.select("row", "node", F.explode("spans").alias("s")).select("row", "node", "s.start", "s.end")
    one = span.select(F.col("row").alias("a"), F.col("start").alias("a_start"), F.col("end").alias("a_end"), F.col("node").alias("one"))
    two = span.select(F.col("row").alias("b"), F.col("start").alias("b_start"), F.col("end").alias("b_end"), F.col("node").alias("two"))
    edges = found.join(one, ["a", "a_start", "a_end"]).join(two, ["b", "b_start", "b_end"])
    roots = components(edges.select(F.col("one").alias("a"), F.col("two").alias("b")))
    placed = (
        passages.select("node", "row", "start", "end", "removal")
        .join(roots, "node")
        .join(anchors.select("row", "doc_id", "digest"), "row")
    )
    placed = written(placed, "placed")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("cluster_id"), F.count(F.lit(1)).alias("n"))
    return placed.join(least, "root").select(
        "doc_id",
        "start",
        "end",
        "cluster_id",
        F.col("n").alias("cluster_size"),
        (~F.col("removal")).alias("kept"),
        "digest",
    )
