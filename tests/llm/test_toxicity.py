import math
import pickle
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeguard.llm import queries
from changeguard.llm import toxicity as X
from changeguard.llm.text import word_hashes, words

SCHEMA = "doc_id long, text string, toxic string, lang string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    texts, marks = {}, {}
    for i in range(1200):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        marks[i] = int(i % 6 == 0)
        for _ in range(3 * marks[i]):
            w[rng.randrange(len(w))] = rng.choice(["Vile", "ROTTEN", "scoundrel"])
        texts[i] = " ".join(w)
    return texts, marks


def scores(rows, texts, labels, extra=()):
    table = rows([(i, t, "x", None) for i, t in [*texts.items(), *extra]], SCHEMA)
    return X.with_scores(table, rows(labels, LABELS)).collect()


def test_held_out_rows_are_told_apart(rows, corpus):
    texts, marks = corpus
    labels = [(i, None, m) for i, m in marks.items()] + [(None, 1, 1), (5, 1, None), (7, 1, marks[7]), (99_999, 0, 1)]
    extra = [(5000, None), (5001, ""), (None, "abcd"), (5002, "vile " + texts[1] * 300), (3, texts[3])]
    out = scores(rows, texts, labels, extra)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 1200 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    wrong = [r for r in held if (r["__toxic"] >= X.REJECT) != bool(marks[r.doc_id])]
    assert len(held) > 300 and len(wrong) <= 0.02 * len(held)
    assert all(0 <= r["__toxic"] <= 1 for r in out)
    assert {r["__toxic"] < X.REJECT for r in out if r.doc_id in (5000, 5001)} == {True}
    assert len({r["__toxic"] for r in out if r.doc_id == 3}) == 1


def test_labels_of_the_held_out_third_do_not_matter(rows, corpus):
    texts, marks = corpus
    honest = [(i, 1, m) for i, m in marks.items()]
    turned = [(i, 1, 1 - m if zlib.crc32(str(i).encode()) % 3 == 1 else m) for i, m in marks.items()]
    one, two = ({r.doc_id: r["__toxic"] for r in scores(rows, texts, labels)} for labels in (honest, turned))
    assert one == pytest.approx(two)


def test_without_labels_nothing_is_rejected(rows, corpus):
    texts = dict(list(corpus[0].items())[:5])
    table = rows([(i, t, "x", "en") for i, t in texts.items()], SCHEMA)
    out = X.drop_toxic(table, rows([], LABELS))
    assert out.columns == table.columns and out.count() == 5
    assert X.drop_toxic(rows([], SCHEMA), rows([(1, 1, 1)], LABELS)).count() == 0


def test_query_tells_the_fold_of_every_row(spark, rows, tmp_path):
    rows([(1, "some words"), (None, "no key"), (None, None), (4, "")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = queries.op9_toxicity(spark, str(tmp_path)).collect()
    assert len(out) == 4 and all(isinstance(r.held_out, bool) and r.predicted in (0, 1) and 0 <= r.score <= 1 for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)


def plain_kneser_ney(texts):
    """(toxic, text) rows to the ratio of each word alone and of each pair, from dictionaries of words."""
    bigrams = {0: Counter(), 1: Counter()}
    for toxic, text in texts:
        found = words(text.encode())
        bigrams[toxic].update(zip([None, *found], found))
    both = set(bigrams[0]) | set(bigrams[1])
    kinds = {c: Counter(w for _, w in bigrams[c]) for c in (0, 1)}
    shared = Counter(w for _, w in both)
    lower, after, held = {}, {0: Counter(), 1: Counter()}, {0: defaultdict(int), 1: defaultdict(int)}
    for c in (0, 1):
        for (b, _), n in bigrams[c].items():
            after[c][b] += n
            held[c][b] += 1
        lower[c] = {
            w: (max(kinds[c][w] - X.DISCOUNT, 0) + X.DISCOUNT * len(kinds[c]) * (shared[w] + 1) / (len(both) + len(shared) + 1)) / len(bigrams[c])
            for w in shared
        }
    unseen = math.log(len(kinds[1]) / len(bigrams[1])) - math.log(len(kinds[0]) / len(bigrams[0]))
    leave = lambda c, b: X.DISCOUNT * held[c][b] / after[c][b] if after[c][b] else 1.0
    p = lambda c, b, w: max(bigrams[c][b, w] - X.DISCOUNT, 0) / max(after[c][b], 1) + leave(c, b) * lower[c][w]
    single = {w: (math.log(lower[1][w] / lower[0][w]) - unseen) * n / (n + X.EVIDENCE) for w, n in shared.items()}
    paired = {}
    for b, w in both:
        n = bigrams[0][b, w] + bigrams[1][b, w]
        paired[b, w] = (math.log(p(1, b, w) / p(0, b, w)) - math.log(leave(1, b) / leave(0, b)) - unseen) * n / (n + X.EVIDENCE)
    return single, paired


def test_ratios_are_those_of_plain_kneser_ney(rows, corpus):
    """Every word and pair, those met once too."""
    texts, marks = corpus
    table, labels = rows([(i, t, "x", None) for i, t in texts.items()], SCHEMA), rows([(i, 1, m) for i, m in marks.items()], LABELS)
    counted = X.training_rows(table, labels, "text", "doc_id").filter(~X.calibrating("doc_id")).collect()
    single, paired = plain_kneser_ney([(r.toxic, r.text) for r in counted])
    ratio = X.fit(table, labels)
    assert tuple(len(t.keys) for t in ratio.tables.value) == (len(single) + 1, len(paired))  # and the start of a text
    for i in range(0, 1200, 17):
        found = words(texts[i].encode())
        got, alone = ratio.ratios(word_hashes(texts[i].encode()))
        assert alone == pytest.approx(np.array([single.get(w, 0.0) for w in found]), abs=1e-6)
        want = [paired.get(pair, single.get(pair[1], 0.0)) for pair in zip([None, *found], found)]
        assert got == pytest.approx(np.array(want), abs=1e-6)


def test_tables_come_back_from_their_packed_form():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 64, 5000, np.uint64)
    table = pickle.loads(pickle.dumps(X.Lookup(hashes, np.arange(5000))))
    value, known = table.get(np.concatenate((hashes, rng.integers(0, 1 << 64, 5000, np.uint64))))
    assert (value[:5000] == np.arange(5000)).all() and known[:5000].all() and not known[5000:].any()
    empty = pickle.loads(pickle.dumps(X.Lookup(hashes[:0], np.empty(0))))
    assert not empty.get(hashes)[1].any()


def test_a_rare_expression_of_toxic_texts_is_a_sign(rows):
    """Words that all texts use, in an order that few toxic ones use."""
    rng = random.Random(8)
    plain = [f"w{i}" for i in range(60)]
    texts = [[rng.choice(plain) for _ in range(40)] for _ in range(900)]
    for i in range(0, 900, 5):
        texts[i][7:11] = ["w1", "w2", "w1", "w2"]
    labels = rows([(i, 1, int(i % 5 == 0)) for i in range(900)], LABELS)
    ratio = X.fit(rows([(i, " ".join(t), "x", None) for i, t in enumerate(texts)], SCHEMA), labels)
    paired, alone = ratio.ratios(word_hashes(b"w9 w1 w2"))
    assert paired[2] > alone[2] and paired[2] > 0.5
