"""Benchmark decontamination with an FM-index per training shard.

A shard is what one task holds at a time.  Its words, reduced to the alphabet
of the test phrases, become a suffix array, a Burrows-Wheeler transform and a
wavelet matrix; all phrases are searched backwards at once, their occurrences
found by walking to sampled suffix positions, and the hit words merged into
removal spans.  Documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.llm.text import byte_texts, words

WINDOW = 10
SHARD_BYTES = 24 << 20
SAMPLE = 8  # every so many text positions keep their suffix position
BLOCK_BYTES = 4 << 20  # of phrases that go to the tasks at once
END, GAP, FIRST = 0, 1, 2  # symbols: end of shard, between runs, first word

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order; the last symbol must be the only smallest one.

    Prefix doubling; after each round only suffixes that still tie are sorted.
    """
    n = len(text)
    bits = int(text.max()).bit_length()
    width = max(1, 62 // max(1, bits))
    key = np.zeros(n, np.int64)
    for i in range(width):
        key <<= bits
        key[: max(0, n - i)] |= text[i:]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    start = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    slots = np.flatnonzero(np.repeat(np.diff(np.append(start, n)) > 1, np.diff(np.append(start, n))))
    while len(slots):
        at = order[slots]
        after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        pair = rank[at] * (n + 1) + after
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[slots] = at
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        rank[at] = np.repeat(slots[first], size)
        slots = slots[np.repeat(size > 1, size)]
        width *= 2
    return order


class WaveletMatrix:
    """Symbols in ``levels`` bit planes; rank and access in one step per plane, for many queries at once."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.planes = []
        for level in reversed(range(levels)):
            bit = (symbols >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int32)), dtype=np.int32)
            zeros = len(symbols) - int(ones[-1])
            self.planes.append((level, ones, zeros))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands in front of each position."""
        low, high = np.zeros(len(before), np.int64), before.astype(np.int64)
        for level, ones, zeros in self.planes:
            one = ((symbol >> level) & 1).astype(bool)
            low1, high1 = ones[low], ones[high]
            low = np.where(one, zeros + low1, low - low1)
            high = np.where(one, zeros + high1, high - high1)
        return high - low

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        low, high, symbol = np.zeros_like(at), at, np.zeros_like(at)
        for level, ones, zeros in self.planes:
            one = ones[high + 1] > ones[high]
            symbol |= one.astype(np.int64) << level
            low1, high1 = ones[low], ones[high]
            low = np.where(one, zeros + low1, low - low1)
            high = np.where(one, zeros + high1, high - high1)
        return symbol, high - low


class FMIndex:
    """Count and locate phrases in one text of symbols that ends with its only ``END``."""

    def __init__(self, text: np.ndarray):
        text = text.astype(np.int64)
        suffixes = suffix_array(text)
        levels = max(1, int(text.max()).bit_length())
        self.size = len(text)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << levels))))
        self.tree = WaveletMatrix(text[suffixes - 1], levels)
        kept = suffixes % SAMPLE == 0
        self.kept = kept
        self.kept_rank = np.concatenate(([0], np.cumsum(kept, dtype=np.int32)))
        self.samples = suffixes[kept]
        self.symbols = 1 << levels

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of phrases, given reversed: column 0 is the last word; rows are padded at will."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.flatnonzero(lengths > 0)
        for column in range(phrases.shape[1]):
            live = live[(lengths[live] > column) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = phrases[live, column]
            known = symbol < self.symbols
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            base = self.before[symbol]
            low[live], high[live] = base + self.tree.rank(symbol, low[live]), base + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        away = np.flatnonzero(~self.kept[rows])
        while len(away):
            symbol, rank = self.tree.step(rows[away])
            rows[away] = self.before[symbol] + rank
            steps[away] += 1
            away = away[~self.kept[rows[away]]]
        return self.samples[self.kept_rank[rows]] + steps


class Phrases:
    """The windows of a block of benchmark items as symbol rows, and the items that each belongs to."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            found = words((text or "").encode("utf-8", "surrogatepass"))
            for i in range(max(1, len(found) - window + 1) if found else 0):
                owners.setdefault(tuple(found[i : i + window]), set()).add(item)
        names = sorted({w for phrase in owners for w in phrase})
        self.symbol = {w: i + FIRST for i, w in enumerate(names)}
        self.items = [sorted(x) for x in owners.values()]
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.rows = np.full((len(owners), int(self.lengths.max(initial=1))), END, np.int64)
        for k, phrase in enumerate(owners):
            self.rows[k, : len(phrase)] = [self.symbol[w] for w in reversed(phrase)]
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 1


def _reduced(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of known words long enough to hold a phrase, each with a gap after it, and where they stood.

    ``ids`` are 0 for unknown words and after each document.
    """
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8)))))
    start, end = edge[::2], edge[1::2]
    fits = end - start >= shortest
    turn = np.zeros(len(ids) + 1, np.int8)
    turn[start[fits]] += 1
    turn[end[fits] + 1] -= 1  # a run may begin right after the gap of the one before
    kept = np.flatnonzero(np.cumsum(turn[:-1], dtype=np.int8))
    return np.where(ids[kept] > 0, ids[kept], GAP), kept


def shard_hits(texts: list[bytes], phrases: Phrases) -> tuple[list[int], list[np.ndarray], list[list[str]]]:
    """For each text: its number of words, its merged hit spans (rows of first and past-last word), its items."""
    known = phrases.symbol.get
    counts, parts = [], []
    for text in texts:
        found = words(text)
        counts.append(len(found))
        parts.append(np.fromiter((known(w, 0) for w in found), np.int32, len(found)))
        parts.append(np.zeros(1, np.int32))
    spans, items = [np.empty((0, 2), np.int64)] * len(texts), [[] for _ in texts]
    reduced, origin = _reduced(np.concatenate(parts), phrases.shortest) if parts else (np.empty(0, np.int32), None)
    if not len(reduced) or not phrases.items:
        return counts, spans, items
    index = FMIndex(np.append(reduced, END))
    low, high = index.search(phrases.rows, phrases.lengths)
    many = high - low
    which = np.repeat(np.arange(len(many)), many)
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    at = origin[index.locate(rows)]
    borders = np.concatenate(([0], np.cumsum(np.array(counts) + 1)))
    doc = np.searchsorted(borders, at, side="right") - 1
    cover = np.zeros(int(borders[-1]) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[which], -1)
    hit = np.cumsum(cover) > 0
    for d in np.unique(doc):
        inside = hit[borders[d] : borders[d + 1] - 1].view(np.int8)
        spans[d] = np.flatnonzero(np.diff(np.concatenate(([0], inside, [0])))).reshape(-1, 2)
    pairs = np.unique(doc * len(many) + which)
    for d, k in zip(pairs // len(many), pairs % len(many)):
        items[d] = sorted({*items[d], *phrases.items[k]})
    return counts, spans, items


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
HITS = T.StructType(
    [
        T.StructField("__words", T.LongType()),
        T.StructField("__spans", SPANS),
        T.StructField("__items", T.ArrayType(T.StringType())),
    ]
)
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _shards(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``SHARD_BYTES`` of text, each at least one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    borders = np.flatnonzero(np.diff(size // SHARD_BYTES)) + 1
    for start, end in zip([0, *borders], [*borders, batch.num_rows]):
        yield batch.slice(start, end - start)


def _search(batches: Iterator[pa.RecordBatch], text: str, items: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    phrases = Phrases(items)
    for batch in batches:
        for shard in _shards(batch, text):
            counts, spans, found = shard_hits(byte_texts(shard.column(text)), phrases)
            yield pa.RecordBatch.from_arrays(
                [
                    *shard.columns,
                    pa.array(counts, pa.int64()),
                    pa.array([[{"start": int(x), "end": int(y)} for x, y in s] for s in spans], ARROW_SPANS),
                    pa.array(found, pa.list_(pa.string())),
                ],
                names=[*shard.schema.names, *HITS.names],
            )


def _blocks(benchmark: DataFrame, text: str, item: str) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of a bounded number of bytes, each at least one item."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("item", F.coalesce("item", F.lit("")))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_BYTES) if total else 0
    for block in range(blocks):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()]


def annotate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` with ``__words``, ``__spans`` (hit words, from and to) and ``__items`` (sorted ids as strings).

    Each block of phrases is one more pass of the same kind over the rows that
    are already in the task.  Null and empty texts have no words.  Without
    phrases nothing is hit.  All columns of ``docs`` pass through.
    """
    out = docs
    steps = 0
    for block in _blocks(benchmark, text, item):
        schema = T.StructType([*docs.schema.fields, *HITS.fields])
        found = out.select(*[out[f"`{c}`"] for c in docs.columns], *([F.struct(*HITS.names).alias("__old")] if steps else []))
        if steps:
            schema = T.StructType([*docs.schema.fields, T.StructField("__old", HITS), *HITS.fields])
        out = found.mapInArrow(lambda batches, block=block: _search(batches, text, block), schema)
        if steps:
            out = out.withColumns(
                {
                    "__spans": merged_spans("__old.__spans", "__spans"),
                    "__items": F.array_sort(F.array_union("__old.__items", "__items")),
                }
            ).drop("__old")
        steps += 1
    if not steps:
        out = _search_nothing(docs, text)
    return out


def _search_nothing(docs: DataFrame, text: str) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *HITS.fields])
    return docs.mapInArrow(lambda batches: _search(batches, text, []), schema)


def merged_spans(one: str, two: str):
    """Two sorted span lists as one, with overlapping and touching spans joined."""
    step = lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
        F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(
                F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                )
            ),
        ),
    ).otherwise(F.concat(done, F.array(s)))
    empty = F.array().cast(SPANS)
    return F.aggregate(F.array_sort(F.concat(F.col(one), F.col(two))), empty, step)


def hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id"
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, spans of hit words, items."""
    found = annotate(docs.select(F.col(key), F.col(text)), benchmark, text, item)
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return found.select(
        F.col(key),
        F.col("__words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("__spans").alias("spans"),
        F.col("__items").alias("items"),
    )


def _cut(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column(text).to_pylist(), batch.column("__spans").to_pylist()
        for k, cuts in enumerate(spans):
            if cuts:
                places = [m.span() for m in WORD.finditer(texts[k].translate(UPPER_TO_LOWER))]
                kept, at = [], 0
                for cut in cuts:
                    kept.append(texts[k][at : places[cut["start"]][0]])
                    at = places[cut["end"] - 1][1]
                texts[k] = "".join([*kept, texts[k][at:]])
        place = batch.schema.get_field_index(text)
        yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, action: str = "drop", text: str = "text", item: str = "item_id"
) -> DataFrame:
    """``docs`` without benchmark passages, with its own columns.

    ``drop`` leaves out documents with any hit; ``cut`` takes the hit spans out
    of their texts, from the first character of the first hit word to the last
    of the last one.  Rows without a hit are passed on unchanged.
    """
    if action not in ("drop", "cut"):
        raise ValueError(f"action must be drop or cut, not {action!r}")
    found = annotate(docs, benchmark, text, item)
    if action == "drop":
        found = found.filter(F.size("__spans") == 0)
    else:
        found = found.mapInArrow(lambda batches: _cut(batches, text), found.schema)
    return found.drop(*HITS.names)
