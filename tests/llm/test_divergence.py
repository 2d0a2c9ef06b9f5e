import random
import re
from collections import Counter

import numpy as np

from changeguard.llm import divergence as D

SCHEMA = "doc_id long, lang string, source string, text string, n long, term string, size long, salt string"


def table(rows, data):
    return rows([(i, lang, source, text, 7, "x", None, "y") for i, (lang, source, text) in enumerate(data)], SCHEMA)


def plain(data, least, first):
    data = [tuple(x or "" for x in row) for row in data]
    uses, docs = Counter(), Counter()
    for lang, source, text in data:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for t in found:
            uses[lang, source, t] += 1
        for t in set(found):
            docs[lang, t] += 1
    out = []
    for lang in {row[0] for row in data}:
        kept = [t for (x, t), d in docs.items() if x == lang and d >= least]
        sources = sorted({s for x, s, _ in data if x == lang})

        def share(count, kept=kept):
            total = sum(count(t) for t in kept)
            return {t: 1 + 10**9 * (count(t) + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: share(lambda t, s=s, lang=lang: uses[lang, s, t]) for s in sources}
        q = share(lambda t, lang=lang, sources=sources: sum(uses[lang, s, t] for s in sources))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if uses[lang, s, t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(terms)[:first], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    data = []
    for i in range(300):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "S2", "é", None])
        start = hash((source, 1)) % 3 * 30
        words = rng.choices(vocabulary[start : start + 60], k=rng.randint(0, 40))
        data.append((lang, source, rng.choice([" ", "9", "_"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return data + [("xx", "only", None), ("yy", "a", ""), ("yy", "b", "!?"), ("en", "s1", "Bb " * 200_000)] + data[:20]


def test_equal_to_plain_counts(rows):
    data = corpus()
    out = D.audit(table(rows, data), least_docs=4, first=5)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == plain(data, 4, 5)


def test_empty_and_termless_tables(rows):
    assert D.audit(table(rows, [])).collect() == []
    out = D.audit(table(rows, [("en", "a", "few words"), ("en", "b", None)])).collect()
    assert sorted(map(tuple, out)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_skyband_counts_dominators():
    rng = np.random.default_rng(5)
    for k in (1, 3, 50):
        n, lang_n = rng.integers(1, 12, 1500), rng.integers(5, 30, 1500)
        item = np.array([f"t{i}".encode() for i in rng.permutation(1500)], object)
        got = set(D.skyband(n, lang_n, item, k).tolist())
        for i in range(1500):
            over = (n >= n[i]) & (lang_n <= lang_n[i]) & (item < item[i])
            assert (over.sum() < k) == (i in got)


def test_counts_beyond_nine_billion(spark):
    kept = spark.createDataFrame(
        [("en", "a", 30_000_000_000, [("s", 20_000_000_000), ("t", 10_000_000_000)]), ("en", "b", 5, [("t", 5)])],
        "lang string, term string, n long, sources array<struct<source:string,n:long>>",
    )
    groups = spark.createDataFrame(
        [("en", "s", 20_000_000_000, 2, 30_000_000_005), ("en", "t", 10_000_000_005, 2, 30_000_000_005)],
        "lang string, source string, n long, size long, lang_n long",
    )
    share = lambda c, n: 1 + 10**9 * (c + 5) // (n + 10)
    s, t, q = 20_000_000_000, 10_000_000_005, 30_000_000_005
    want = abs(share(s, s) - share(t - 5, t)) + abs(share(0, s) - share(5, t))
    assert {r.value for r in D.source_pairs(kept, groups).collect()} == {want}
    out = {(r.source, r.item): r.value for r in D.telling_terms(kept, groups).collect()}
    diffs = {("s", "a"): share(s, s) - share(q - 5, q), ("t", "a"): share(t - 5, t) - share(q - 5, q), ("t", "b"): share(5, t) - share(5, q)}
    assert out == {k: v for k, v in diffs.items() if v > 0}
