"""Scoring texts by a log-bilinear model trained with noise-contrastive estimation.

The corpus gives two sets of counts: of all words, and of symbols after
symbols.  Symbols are the most frequent words and, for all others, classes by
word ending.  The model predicts the next symbol from the last one through two
tables of vectors; it is trained in numpy on the whole table of symbol pairs,
with the noise taken in expectation instead of by drawing.  Batched matrix
products turn contexts into normalised log-probabilities.  Inside a class,
words have their smoothed share of the class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeguard.llm.text import byte_texts, most_frequent
from changeguard.session import written

FOLDS, HELD_OUT = 7, 2
WORDS, CLASSES = 768, 256  # symbols: the end of a text, the most frequent words, classes by ending
NEAR_WORDS = 150_000  # words whose counts go to the tasks; all others get theirs by a join
DIMS, NOISE, STEPS, RATE = 48, 10, 250, 0.05
END = b""  # no word is empty


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and the end."""
    return [*text.lower().split(), END]


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def fold(key: Column) -> Column:
    """The fold of a key; null keys are in the first."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "utf-8")), F.lit(FOLDS)), F.lit(0))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def emit():
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(list(counts.values()), pa.int64()), pa.array([ending(k) for k in keys], pa.int32())],
            names=["word", "n", "ending"],
        )

    for batch in batches:
        for text in byte_texts(batch.column("text")):
            counts.update(tokens(text))
            if len(counts) > 400_000:
                yield from emit()
                counts.clear()
    if counts:
        yield from emit()


def count_words(train: DataFrame) -> DataFrame:
    """(word, n, ending) over all of ``train``."""
    rows = train.select("text").mapInArrow(_counted, "word binary, n long, ending int")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.first("ending").alias("ending"))


@dataclass
class Symbols:
    """Words that tasks know with their counts, and what each symbol stands for."""

    place: dict[bytes, int]  # near words
    symbol: np.ndarray  # of each near word
    log_count: np.ndarray  # log10(c + 1) of each near word
    log_share: np.ndarray  # log10 of its share of its symbol
    log_class: np.ndarray  # log10 of what shares of each class are measured against

    @property
    def size(self) -> int:
        return WORDS + CLASSES


def symbols(vocabulary: DataFrame) -> Symbols:
    near = most_frequent(vocabulary, "n", NEAR_WORDS).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words = [bytes(w) for w in near["word"]]
    n, place_of = near["n"].to_numpy(np.float64), near["ending"].to_numpy(np.int64)
    own = np.zeros(len(words), bool)
    own[:WORDS] = True
    classes = vocabulary.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).toPandas()
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    mass[classes["ending"]], kinds[classes["ending"]] = classes["n"], classes["kinds"]
    np.subtract.at(mass, place_of[own], n[own])
    np.subtract.at(kinds, place_of[own], 1)
    log_class = np.log10(mass + kinds + 1)
    log_count = np.log10(n + 1)
    return Symbols(
        {w: i for i, w in enumerate(words)},
        np.where(own, np.arange(len(words)), WORDS + place_of),
        log_count,
        np.where(own, 0.0, log_count - log_class[place_of]),
        log_class,
    )


def _placed(found: list[bytes], known: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Near word (or -1) and symbol of each token."""
    get = known.place.get
    near = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
    symbol = known.symbol[near] if len(known.symbol) else np.zeros(len(found), np.int64)
    for i in np.flatnonzero(near < 0):
        symbol[i] = WORDS + ending(found[i])
    return near, symbol


def _pairs(batches: Iterator[pa.RecordBatch], known: Symbols) -> Iterator[pa.RecordBatch]:
    start = int(_placed([END], known)[1][0])
    cells = np.zeros(known.size**2, np.int64)
    for batch in batches:
        for text in byte_texts(batch.column("text")):
            symbol = _placed(tokens(text), known)[1]
            key = np.concatenate(([start], symbol[:-1])) * known.size + symbol
            np.add.at(cells, key, 1) if len(key) < 50_000 else np.add(cells, np.bincount(key, minlength=len(cells)), out=cells)
    some = np.flatnonzero(cells)
    for part in np.array_split(some, 1 + len(some) // 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(cells[part])], names=["cell", "n"])


def pair_counts(train: DataFrame, known: Symbols) -> np.ndarray:
    """How often each symbol follows each, over all of ``train``: a table of fixed size."""
    rows = train.select("text").mapInArrow(lambda batches: _pairs(batches, known), "cell long, n long")
    found = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.zeros(known.size**2)
    cells[found["cell"].to_numpy()] = found["n"].to_numpy()
    return cells.reshape(known.size, known.size)


@dataclass
class LogBilinear:
    context: np.ndarray  # symbols x DIMS, already turned by the context matrix
    target: np.ndarray  # symbols x DIMS
    bias: np.ndarray

    def log10_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of all symbols after each of ``contexts``."""
        scores = self.context[contexts] @ self.target.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return scores / np.log(10)


def train_nce(counts: np.ndarray, steps: int = STEPS, seed: int = 5) -> LogBilinear:
    """Tell the pairs of the corpus from ``NOISE`` times as many with targets drawn by frequency.

    The objective is a sum over all pairs of symbols, so noise needs no
    drawing: each pair counts as often as noise would bring it.  Adam on the
    full gradient.
    """
    size, total = len(counts), max(1.0, counts.sum())
    rng = np.random.default_rng(seed)
    often = ((counts.sum(axis=0) + 0.1) / (counts.sum() + 0.1 * size)).astype(np.float32)
    data = (counts / total).astype(np.float32)
    noise = (NOISE * data.sum(axis=1, keepdims=True) * often).astype(np.float32)
    shift = np.log(NOISE * often)
    vectors = rng.normal(0, 0.1, (size, DIMS)).astype(np.float32)
    turn = np.eye(DIMS, dtype=np.float32)
    target = rng.normal(0, 0.1, (size, DIMS)).astype(np.float32)
    bias = np.log(often)
    parts = [vectors, turn, target, bias]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        context = vectors @ turn
        real = 1 / (1 + np.exp(np.clip(shift - bias - context @ target.T, -60, 60)))
        pull = data * (1 - real) - noise * real
        back = pull @ target
        slopes = [back @ turn.T, vectors.T @ back, pull.T @ context, pull.sum(axis=0)]
        rate = RATE * min(1.0, 2 - 2 * step / steps)
        for p, g, m, v in zip(parts, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-10)
    return LogBilinear(vectors @ turn, target, bias)


def _scored(batches: Iterator[pa.RecordBatch], known: Symbols, model: LogBilinear, whole: float) -> Iterator[pa.RecordBatch]:
    """Adds what is known in the task; words that are not near come out in ``rest`` with their numbers."""
    start = int(_placed([END], known)[1][0])
    rest_kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    table = np.full((known.size, known.size), np.nan, np.float32)
    for batch in batches:
        out: list[tuple] = []
        for text in byte_texts(batch.column("text")):
            found = tokens(text)
            near, symbol = _placed(found, known)
            context = np.concatenate(([start], symbol[:-1]))
            fresh = np.unique(context)
            fresh = fresh[np.isnan(table[fresh, 0])]
            if len(fresh):
                table[fresh] = model.log10_probabilities(fresh)
            here = near >= 0
            score = table[context, symbol].sum(dtype=np.float64) + known.log_share[near[here]].sum()
            score -= known.log_class[symbol[~here] - WORDS].sum()
            base = known.log_count[near[here]].sum() - len(found) * whole
            rest = Counter(found[i] for i in np.flatnonzero(~here))
            out.append((len(found), int(here.sum()), base, score, [{"word": w, "n": n} for w, n in rest.items()]))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), rest_kind]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            names=["doc_id", "n_tokens", "n_near", "base", "model", "rest"],
        )


def score_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all rows outside the held-out fold of the key.  A null or
    empty text is the end alone.  Repeated rows count as often as they occur
    and each get a row.  Without training rows every word is unknown.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    train = rows.filter(fold(F.col("doc_id")) != HELD_OUT)
    vocabulary = written(count_words(train), "words")
    total, kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known = symbols(vocabulary)
    model = train_nce(pair_counts(train, known))
    whole = float(np.log10(total + kinds + 1))
    scored = written(
        rows.mapInArrow(
            lambda batches: _scored(batches, known, model, whole),
            f"doc_id {kind}, n_tokens long, n_near long, base double, model double, rest array<struct<word:binary,n:int>>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    far = scored.select("row", F.explode("rest").alias("rest")).select("row", F.col("rest.word").alias("word"), F.col("rest.n").alias("times"))
    more = (
        far.join(vocabulary.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum("times").alias("n_far"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    )
    none = F.lit(0)
    return scored.drop("rest").join(more, "row", "left").select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_near") + F.coalesce("n_far", none)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", none)).alias("base_score"),
        (F.col("model") + F.coalesce("more", none)).alias("score"),
    )
