import math
import random
import zlib
from collections import Counter

import numpy as np

from changeguard.llm import language_model as L

SCHEMA = "doc_id long, text string, n_tokens string"


def brute(texts):
    tokens = [(t or "").encode().lower().split() + [b""] for _, t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (i, h, len(t), sum(w in counts for w in t), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t))
        for (i, _), h, t in zip(texts, held, tokens)
    ]


def corpus():
    rng = random.Random(2)
    texts = []
    for i in range(400):
        letters = "abcd" if i % 2 else "wxyz"
        texts.append((i, " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(40)) + f" Rare{i % 97}\x0bÄb"))
    return [*texts, (400, None), (401, ""), (402, " \n "), (None, "abc abd"), (7, "abc " * 3000), (7, "abc " * 3000)]


def check(rows, texts):
    out = L.score_texts(rows([(i, t, "x") for i, t in texts], SCHEMA)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for got, want in zip(sorted(out, key=lambda r: key(r)), sorted(brute(texts), key=key), strict=True):
        assert tuple(got[:5]) == want[:5]
        assert math.isclose(got.base_score, want[5], rel_tol=1e-9)
    return out


def test_counts_and_base_score(rows, monkeypatch):
    monkeypatch.setattr(L, "NEAR_WORDS", 900)  # so that some words get their counts by the join
    out = check(rows, corpus())
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_without_training_rows(rows):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    out = L.score_texts(rows([(held, "a b", "x")], SCHEMA)).collect()
    assert (out[0].n_known, out[0].train_tokens, out[0].base_score) == (0, 0, 0.0)
    assert L.score_texts(rows([], SCHEMA)).count() == 0


def test_probabilities_are_normalised_and_learned():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 3, (L.WORDS + L.CLASSES,) * 2).astype(float)
    counts[:5] = 0
    counts[0, 7] = counts[1, 8] = 5000
    model = L.train_nce(counts, steps=150)
    table = model.log10_probabilities(np.arange(20))
    assert np.allclose((10.0**table).sum(axis=1), 1, atol=1e-4)
    assert table[0].argmax() == 7 and table[1].argmax() == 8


def test_words_of_the_model_add_up_to_one(spark, rows):
    train = rows([(i, f"w{i % 40} w{i % 7} x{i}", "x") for i in range(900)], SCHEMA)
    vocabulary = L.count_words(train).cache()
    known = L.symbols(vocabulary)
    share = np.zeros(known.size)
    np.add.at(share, known.symbol, 10.0**known.log_share)
    share[L.WORDS :] += 10.0 ** -known.log_class  # the unseen words of a class
    assert (share[L.WORDS :] <= 1 + 1e-9).all()
