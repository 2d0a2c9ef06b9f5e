import random

import numpy as np

from changeguard.llm import paragraphs as P
from changeguard.llm.text import mixed, shingles

SCHEMA = "doc_id long, text string, start string, row string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def test_passages_anywhere_are_found(rows):
    rng = random.Random(8)
    passages = [words(rng, n) for n in (51, 60, 140)]
    texts, want = {}, {}
    for i in range(60):
        own, at = words(rng, 200), rng.randint(0, 200)
        if i < 45:
            p = passages[i % 3]
            own[at:at] = p
            want[i] = (at, at + len(p))
        texts[i] = " ".join(own)
    texts |= {100: None, 101: "", 102: " ".join(passages[0][:40]), 103: " ".join(words(rng, 3000))}
    out = P.repeats(rows([(i, t, "x", None) for i, t in texts.items()], SCHEMA)).collect()
    assert {r.doc_id: (r.start, r.end) for r in out} == want
    for k in range(3):
        group = [r for r in out if r.doc_id % 3 == k]
        assert {r.cluster_id for r in group} == {k} and {r.cluster_size for r in group} == {15}
        assert [r.doc_id for r in group if r.kept] == [k]


def test_edited_passages_are_linked(rows):
    rng = random.Random(9)
    passage = words(rng, 120)
    texts = []
    for i in range(12):
        p = list(passage)
        if i:
            p[10 * i] = "edited"
            p.insert(60, "inserted" * (i % 2)) if i % 3 == 0 else None
        texts.append((i, " ".join([*words(rng, 80), *p, *words(rng, 80)]), "x", None))
    out = P.repeats(rows(texts, SCHEMA)).collect()
    assert {r.doc_id for r in out} == set(range(12)) and len({r.cluster_id for r in out}) == 1


def test_copies_of_whole_documents_repeated_rows_and_null_keys(rows):
    rng = random.Random(10)
    text = " ".join(words(rng, 90))
    out = P.repeats(rows([(1, text, "a", "b"), (1, text, "a", "b"), (None, text, "a", "b"), (4, "short", "a", "b")], SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.start, r.end) for r in out) == [(0, 0, 90), (1, 0, 90), (1, 0, 90)]
    assert sum(r.kept for r in out) == 1
    assert P.repeats(rows([], SCHEMA)).count() == 0


def test_equal_paragraphs_always_share_a_value():
    rng = np.random.default_rng(3)
    for _ in range(50):
        shared = rng.integers(0, 1 << 62, P.WIDTH, dtype=np.uint64)
        texts = [np.concatenate((rng.integers(0, 1 << 62, n, dtype=np.uint64), shared, rng.integers(0, 1 << 62, 70 - n, dtype=np.uint64))) for n in (0, 33, 70)]
        values = [set(P.minima(t)[0].tolist()) for t in texts]
        assert values[0] & values[1] and values[0] & values[2] and values[1] & values[2]


def test_passages_with_a_common_line_of_other_documents(rows):
    """The values of a passage that stand in its common line are first and last held by documents without the passage."""
    rng = random.Random(12)
    line = words(rng, 30)
    passages = [words(rng, 8) + line + words(rng, 13) for _ in range(12)]
    plain = lambda: words(rng, 60) + line + words(rng, 60)
    texts = {i: plain() for i in (0, 1, 2, 900, 901, 902)}
    for i in range(12):
        for k in (0, 1):
            texts[10 + 2 * i + k] = words(rng, 70) + passages[i] + words(rng, 70)
    out = P.repeats(rows([(i, " ".join(t), "x", None) for i, t in sorted(texts.items())], SCHEMA)).collect()
    want = {(10 + 2 * i + k, 70, 121, k == 0, 10 + 2 * i) for i in range(12) for k in (0, 1)}
    assert {(r.doc_id, r.start, r.end, r.kept, r.cluster_id) for r in out} == want


def test_least_places_and_long_runs_equal_plain_ones():
    rng = np.random.default_rng(5)
    for size in (0, 1, 4, 41, 42, 43, 90, 300):
        for kinds in (2, 40, 1 << 62):
            v = rng.integers(0, kinds, size).astype(np.uint64)
            for width in (1, 2, 5, 38, 42):
                if size >= width:
                    plain = [i + int(v[i : i + width].argmin()) for i in range(size - width + 1)]
                    assert P.least_places(v, width).tolist() == plain
                if size:
                    n, out = min(width, size), []
                    for i in range(size - n + 1):
                        value = 0
                        for word in v[i : i + n].tolist():
                            value = (value * 0x9E3779B97F4A7C15 + word) % (1 << 64)
                        out.append((value + n) % (1 << 64))
                    assert shingles(v, width).tolist() == mixed(np.array(out, np.uint64)).tolist()


def test_common_spans_need_enough_common_places_in_one_paragraph():
    one = np.arange(100, dtype=np.uint32)
    for same in (P.LEAST_COMMON - 1, P.LEAST_COMMON):
        two = np.where(np.arange(100) < same, one, one + 1000).astype(np.uint32)
        expected = [(0, same - 1 + P.SHINGLE, 0, same - 1 + P.SHINGLE)] if same >= P.LEAST_COMMON else []
        assert P.common_spans(one, two, 0) == expected
    assert P.common_spans(one, one[:0], 0) == [] and P.common_spans(one, one, 500) == []


def test_run_starts_and_minima_equal_plain_ones():
    rng = np.random.default_rng(8)
    for size in (P.WIDTH, P.WIDTH + 1, 60, 400):
        places = rng.integers(0, size, 5)
        plain = {s for p in places for s in range(p + 1 - P.WIDTH, p + P.WIDTH - P.RUN + 1) if 0 <= s <= size - P.RUN}
        assert P.run_starts(places, size).tolist() == sorted(plain)
        found = rng.integers(0, 30, size).astype(np.uint64)  # many equal shingles
        want = {}
        for band, seed in enumerate(P.BAND_SEEDS[:, 0]):
            v = mixed(found ^ seed)
            for i in range(size - P.WIDTH + 1):
                at = i + int(np.argmin(v[i : i + P.WIDTH]))
                want.setdefault(int(v[at]) & ~1 | band, at)
        values, first = P.minima(found)
        assert dict(zip(values.tolist(), first.tolist())) == want and (values[1:] > values[:-1]).all()
