"""Toxicity by two Kneser-Ney bigram models, one of toxic and one of ordinary texts.

Both models back off to the same continuation counts, pooled over the classes,
so that an expression that is rare in both says little.  A text is judged by
its length-normalised log-likelihood ratio, over all of it and over its most
toxic window, calibrated on labelled rows that the models have not seen.

Words are 64-bit hashes, and a pair of words is one of both.  Every word and
pair of the labelled rows has its ratio.  They go to the executors once, with
eight bytes for each distinct pair of those at most 2 * ``MAX_ROWS`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeguard.llm.text import byte_texts, mixed, word_hashes
from changeguard.session import written

MAX_ROWS = 10_000  # labelled rows of each class that the classifier is fitted on, drawn by hash
DISCOUNT = 0.75
EVIDENCE = 5.0  # pooled counts at which half of a ratio is believed
WINDOW = 6  # words
REJECT = 0.7
START = 0  # in place of the word before the first


def fold(key: Column, parts: int) -> Column:
    return F.pmod(F.crc32(F.encode(key.cast("string"), "utf-8")), F.lit(parts))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """At most about ``MAX_ROWS`` labelled rows of each class, outside the held-out third: key, text, toxic.

    A document with several labels is toxic if one of them says so; null keys
    and labels are left out.  The draw depends on the key alone.
    """
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.filter(fold(F.col("doc_id"), 3) != 1)
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, min(1.0, MAX_ROWS / max(1, sizes.get(1, 0)))).otherwise(
        min(1.0, MAX_ROWS / max(1, sizes.get(0, 0)))
    )
    drawn = marks.filter("toxic in (0, 1)").filter(draw < share)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(drawn, "doc_id")


def calibrating(key: str) -> Column:
    """The fifth of the labelled rows whose words are not counted."""
    return F.pmod(F.xxhash64(key, F.lit(11)), F.lit(5)) == 0


def _before(found: np.ndarray) -> np.ndarray:
    return np.concatenate((np.array([START], np.uint64), found[:-1]))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + word)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (before, word, n_toxic, n_ordinary), added up in each text."""
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), byte_texts(batch.column("text"))):
            word = word_hashes(text)
            if not len(word):
                continue
            before = _before(word)
            _, first, n = np.unique(pair_keys(before, word), return_index=True, return_counts=True)
            n = n.astype(np.int64)
            columns = [before[first].view(np.int64), word[first].view(np.int64), n * toxic, n * (1 - toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["before", "word", "n_toxic", "n_ordinary"])


class Lookup:
    """Values by the upper 48 bits of 64-bit hashes; an entry travels as eight bytes."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.keys = hashes[order] >> np.uint64(16)
        self.values = values[order].astype(np.float32)

    def __getstate__(self):
        sizes = np.bincount((self.keys >> np.uint64(32)).astype(np.int64), minlength=1 << 16)
        return sizes, self.keys.astype(np.uint32), self.values

    def __setstate__(self, state):
        sizes, rest, self.values = state
        self.keys = (np.repeat(np.arange(1 << 16, dtype=np.uint64), sizes) << np.uint64(32)) | rest

    def get(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each hash, 0 where there is none, and whether there is one."""
        if not len(self.keys):
            return np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        asked = hashes >> np.uint64(16)
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        known = self.keys[at] == asked
        return np.where(known, self.values[at].astype(float), 0.0), known


@dataclass
class Ratio:
    """Log-likelihood ratios (toxic to ordinary) of words after words, and how to turn them into a score."""

    tables: Broadcast | None = None  # ratios of words, backed off, and of pairs
    centre: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    share: float = 0.0  # of toxic texts, the score of a text without words

    def ratios(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word of a text: the ratio after the word before, and backed off.  A word nobody knows is no sign."""
        if self.tables is None:
            return np.zeros(len(word)), np.zeros(len(word))
        words, pairs = self.tables.value
        alone, _ = words.get(word)
        paired, seen = pairs.get(pair_keys(_before(word), word))
        return np.where(seen, paired, alone), alone

    def features(self, text: bytes) -> tuple[float, float, float]:
        """Mean ratio of the text, mean ratio of its most toxic window, highest backed-off ratio of one word."""
        word = word_hashes(text)
        if not len(word):
            return np.nan, np.nan, np.nan
        ratio, alone = self.ratios(word)
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        size = min(WINDOW, len(ratio))
        return float(ratio.mean()), float((sums[size:] - sums[:-size]).max() / size), float(alone.max())

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.column_stack([(features - self.centre) / self.scale, np.ones(len(features))]) @ self.weights
        return np.where(np.isnan(z), self.share, 1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _pair_ratios(batches: Iterator[pa.RecordBatch], stats: Broadcast) -> Iterator[pa.RecordBatch]:
    """(before, word, n1, n0) to the key of the pair and its ratio, from what the models know of each word."""
    words, n0, n1, leave, lower, unseen = stats.value
    for batch in batches:
        first, second = (batch.column(c).to_numpy().view(np.uint64) for c in ("before", "word"))
        before, word = np.searchsorted(words, first), np.searchsorted(words, second)
        seen = {0: batch.column("n0").to_numpy().astype(float), 1: batch.column("n1").to_numpy().astype(float)}
        p = {
            c: np.maximum(seen[c] - DISCOUNT, 0) / np.maximum(n[before], 1) + leave[c][before] * lower[c][word]
            for c, n in ((0, n0), (1, n1))
        }
        value = np.log(p[1] / p[0]) - np.log(leave[1] / leave[0])[before]
        n = seen[0] + seen[1]
        value = ((value - unseen) * n / (n + EVIDENCE)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(pair_keys(first, second).view(np.int64)), pa.array(value)], names=["pair", "value"])


def _calibrated(ratio: Ratio, features: np.ndarray, toxic: np.ndarray) -> Ratio:
    """Logistic regression with a small ridge, by Newton steps."""
    good = ~np.isnan(features[:, 0])
    ratio.share = float(toxic.mean())
    features, toxic = features[good], toxic[good]
    ratio.centre, ratio.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([(features - ratio.centre) / ratio.scale, np.ones(len(features))])
    w, ridge = np.zeros(4), np.diag([1e-2, 1e-2, 1e-2, 1e-6]) * max(1.0, len(x) / 1000)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    ratio.weights = w
    return ratio


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Ratio:
    """The classifier from labelled rows outside the held-out third; four fifths count words, one fifth calibrates.

    Without labels of both classes every text gets the share of toxic ones, or 0.
    """
    rows = written(training_rows(docs, labels, text, key).select("doc_id", "text", "toxic"), "labelled")
    empty = Ratio()
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        empty.share = 1.0 if sizes.get(1) else 0.0
        empty.weights[3] = 50.0 if sizes.get(1) else -50.0
        return empty
    pairs = written(
        rows.filter(~calibrating("doc_id"))
        .mapInArrow(_pairs, "before long, word long, n_toxic long, n_ordinary long")
        .groupBy("before", "word")
        .agg(F.sum("n_toxic").alias("n1"), F.sum("n_ordinary").alias("n0")),
        "pairs",
    )
    after = pairs.groupBy(F.col("before").alias("w")).agg(
        *[f(F.col(f"n{c}")).alias(f"{name}{c}") for c in (0, 1) for name, f in (("n", F.sum), ("t", lambda n: F.count_if(n > 0)))]
    )
    into = pairs.groupBy(F.col("word").alias("w")).agg(
        *[F.count_if(F.col(f"n{c}") > 0).alias(f"k{c}") for c in (0, 1)], F.count(F.lit(1)).alias("k")
    )
    totals = into.agg(F.sum("k0"), F.sum("k1"), F.sum("k"), F.count_if(F.col("k0") > 0), F.count_if(F.col("k1") > 0), F.count(F.lit(1))).first()
    if not totals[5]:
        empty.weights[3] = -50.0
        return empty
    known = into.join(after, "w", "full").na.fill(0).toArrow().to_pandas()
    known = known.iloc[np.argsort(known["w"].to_numpy().view(np.uint64))]
    words = known["w"].to_numpy().view(np.uint64)
    count = {c: known[c].to_numpy(float) for c in ("n0", "n1", "t0", "t1", "k0", "k1", "k")}
    shared = (count["k"] + 1) / (totals[2] + totals[5] + 1)
    lower = {}
    for c in (0, 1):
        all_c, kinds = max(1, totals[c]), max(1, totals[3 + c])
        lower[c] = (np.maximum(count[f"k{c}"] - DISCOUNT, 0) + DISCOUNT * kinds * shared) / all_c
    leave = {c: np.where(count[f"n{c}"] > 0, DISCOUNT * count[f"t{c}"] / np.maximum(count[f"n{c}"], 1), 1.0) for c in (0, 1)}
    # The shares left to backing off differ by class size alone; they are taken out of all
    # ratios, so that words which neither class knows are no sign, and neither are those
    # that one of them has met once or twice.
    unseen = np.log(max(1, totals[4]) / max(1, totals[1])) - np.log(max(1, totals[3]) / max(1, totals[0]))
    single = (np.log(lower[1] / lower[0]) - unseen) * count["k"] / (count["k"] + EVIDENCE)
    context = docs.sparkSession.sparkContext
    stats = context.broadcast((words, count["n0"], count["n1"], leave, lower, unseen))
    rated = pairs.mapInArrow(lambda batches: _pair_ratios(batches, stats), "pair long, value float").toArrow()
    stats.unpersist()
    in_pairs = Lookup(rated.column("pair").to_numpy().view(np.uint64), rated.column("value").to_numpy())
    del rated
    tables = Lookup(words, single), in_pairs
    ratio = Ratio(context.broadcast(tables))
    found = rows.filter(calibrating("doc_id")).mapInArrow(
        lambda batches: _features(batches, ratio, ["toxic"]), "toxic int, f0 double, f1 double, f2 double"
    ).toPandas()
    if found["toxic"].nunique() < 2:
        found = rows.mapInArrow(
            lambda batches: _features(batches, ratio, ["toxic"]), "toxic int, f0 double, f1 double, f2 double"
        ).toPandas()
    return _calibrated(ratio, found[["f0", "f1", "f2"]].to_numpy(), found["toxic"].to_numpy(float))


def _features(batches: Iterator[pa.RecordBatch], ratio: Ratio, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([ratio.features(t) for t in byte_texts(batch.column("text"))], float).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k).cast(pa.int32()) for k in keep), *map(pa.array, found.T)], names=[*keep, "f0", "f1", "f2"]
        )


def _scores(batches: Iterator[pa.RecordBatch], ratio: Ratio, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([ratio.features(t) for t in byte_texts(batch.column(text))], float).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ratio.score(found))], names=[*batch.schema.names, "__toxic"])


def with_scores(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``__toxic``, from 0 to 1.

    A null or empty text has no words: it gets the share of toxic texts among
    those that calibrate.  Repeated rows get equal scores.  Labels
    are never looked up for the row that is scored.
    """
    ratio = fit(docs, labels, text, key)
    schema = T.StructType([*docs.schema.fields, T.StructField("__toxic", T.DoubleType())])
    return docs.mapInArrow(lambda batches: _scores(batches, ratio, text), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` whose score is under ``reject``, with their own columns."""
    return with_scores(docs, labels, text, key).filter(F.col("__toxic") < reject).drop("__toxic")
