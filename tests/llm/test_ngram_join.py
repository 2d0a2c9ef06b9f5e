import random

import numpy as np
import pytest

from changeguard.llm import ngram_join as J

SCHEMA = "doc_id long, text string, n long, row long, same string, gid long, component_id string"


def table(rows, data):
    return rows([(i, t, 5, None, "x", 1, "y") for i, t in data], SCHEMA)


def plain_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    size = min(4, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain(data):
    """(doc_id, n, component) of every row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(data):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(data, sets))), key=str)


def told(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n)]


def families(rng, count, size, low, high):
    """Near copies whose similarity to their base is spread around the threshold."""
    texts = []
    for _ in range(count):
        base = words(rng, rng.randint(60, 160))
        for _ in range(size):
            share = rng.uniform(low, high)
            texts.append(" ".join(w if rng.random() > share else rng.choice(words(rng, 3)) for w in base))
    return texts


@pytest.mark.parametrize("block", [1024, 4])
def test_components_equal_all_pairs(rows, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = random.Random(block)
    line = " ".join(words(rng, 12))
    texts = families(rng, 5, 40, 0.0, 0.05) + [line + " " + t for t in families(rng, 3, 25, 0.01, 0.03)]
    texts += [" ".join(words(rng, rng.randint(1, 8), "ab")) for _ in range(150)]
    texts += [t.upper() for t in texts[::9]] + texts[::7] + [t + " end" for t in texts[::5]]
    data = list(enumerate(texts, 100))
    rng.shuffle(data)
    assert told(J.link_components(table(rows, data))) == plain(data)


def test_groups_of_one_prefix(rows):
    """Sets of one size that share their first n-grams and differ in later ones; few buckets make many such."""
    rng = random.Random(6)
    base = words(rng, 60)
    tails = [" ".join(words(rng, 12)) for _ in range(6)]
    texts = [" ".join(base[: rng.choice([30, 60])]) + " " + rng.choice(tails) for _ in range(60)] + tails * 10
    data = list(enumerate(texts))
    assert told(J.link_components(table(rows, data), buckets=16)) == plain(data)


def test_odd_rows(rows):
    long = " ".join(str(i) for i in range(60_000))
    data = [(1, None), (2, ""), (3, " \t\x0b\n"), (4, "one two"), (5, "One\ttwo "), (6, "one two three"), (7, "a a a a a a a a"), (None, "A a a a")]
    data += [(9, long), (8, long.replace(" 7 ", " x ")), (4, "one two"), (None, None), (None, "no key at all here"), (12, "a\xa0a a a"), (13, "漢 é É e")]
    assert told(J.link_components(table(rows, data))) == plain(data)
    assert J.link_components(table(rows, [])).collect() == []


def test_threshold_is_exact(rows):
    """85 of 100 common n-grams are a link, 84 of 100 are none."""
    common = [f"w{i}" for i in range(88)]
    one = " ".join(common)  # 85 n-grams
    data = [(1, one), (2, " ".join(common + [f"x{i}" for i in range(15)]))]
    assert [r[2] for r in told(J.link_components(table(rows, data)))] == [1, 1]
    data = [(1, one), (2, " ".join(common + [f"x{i}" for i in range(16)]))]
    assert [r[2] for r in told(J.link_components(table(rows, data)))] == [1, 2]


def test_places_leave_out_no_pair():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, J.BUCKETS)
    for _ in range(400):
        pool = rng.integers(1, 1 << 62, 80, dtype=np.uint64)
        one, two = (np.unique(np.concatenate([pool[: rng.integers(40, 80)], rng.integers(1, 1 << 62, rng.integers(0, 8), dtype=np.uint64)])) for _ in range(2))
        shared = len(np.intersect1d(one, two))
        if 100 * shared >= 85 * (len(one) + len(two) - shared):
            a, b = J.prefix(one, counts).tolist(), J.prefix(two, counts).tolist()
            assert any(J.may_link(len(one), i, len(two), b.index(g)) for i, g in enumerate(a) if g in b)


def test_profiles_never_rule_out_common_grams():
    rng = np.random.default_rng(8)
    for scale in (40, 4000, 200_000):
        pool = rng.integers(1, 1 << 63, scale, dtype=np.uint64)
        one, two = (np.unique(rng.choice(pool, scale)) for _ in range(2))
        assert J.most_common(J.profile(one), J.profile(two)) >= len(np.intersect1d(one, two))
