import random

import numpy as np
import pyarrow as pa

from changeguard.llm import neardup as N
from changeguard.llm.components import components

SCHEMA = "doc_id long, text string, digest string, bands string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def edited(rng, base, share):
    return [w if rng.random() > share else "zz" + w for w in base]


def corpus():
    rng = random.Random(11)
    texts = {}
    for family in range(6):
        base = words(rng, 220)
        texts[family * 100] = " ".join(base)
        for k in range(1, 9):
            texts[family * 100 + k] = " ".join(edited(rng, base, 0.004 * k))
    for k in range(40):
        texts[1000 + k] = " ".join(words(rng, 150))
    texts[2000], texts[2001], texts[2002], texts[2003], texts[2004] = None, "", "?!", "one two", "One, two!"
    return texts


def test_links_equal_brute_force(rows):
    texts = corpus()
    table = rows([(i, t, "x", None) for i, t in texts.items()], SCHEMA)
    out = {r.doc_id: r for r in N.near_groups(table).collect()}
    assert len(out) == len(texts)
    idf = N.idf_table(table)
    feats = {i: N.weighted((t or "").encode(), idf) for i, t in texts.items()}
    ids = sorted(texts)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and len(feats[a][0]) and N.weighted_jaccard(feats[a], feats[b]) >= N.SIMILAR:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {i: out[i].group_id for i in ids} == {i: find(i) for i in ids}
    assert out[2003].class_id == out[2004].class_id == 2003
    assert [out[i].group_size for i in (2000, 2001, 2002)] == [1, 1, 1]
    for group in {r.group_id for r in out.values()}:
        assert [r.doc_id for r in out.values() if r.group_id == group and r.kept] == [group]


def test_sampling_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a, b = np.sort(hashes[:600]), np.sort(hashes[150:])
    wa, wb = rng.uniform(0.5, 3, 600).astype(np.float32), rng.uniform(0.5, 3, 750).astype(np.float32)
    drawn = N.samples(np.concatenate((a, b)), np.concatenate((wa, wb)), np.array([0, 600]))
    exact = N.weighted_jaccard((a, wa), (b, wb))
    assert abs((drawn[0] == drawn[1]).mean() - exact) < 0.2


def test_drop_near_copies_keeps_whole_rows(rows):
    rng = random.Random(4)
    base = words(rng, 300)
    near = " ".join([*base[:-1], "changed"])
    table = rows([(5, " ".join(base), "a", "b"), (3, near, "a", "b"), (3, near, "a", "b"), (9, None, None, None), (None, "other", "c", None)], SCHEMA)
    out = N.drop_near_copies(table)
    assert out.columns == table.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 3, 9]
    assert N.drop_near_copies(rows([], SCHEMA)).count() == 0


def test_components_of_chains_stars_and_loops(rows):
    chain = [(i, i + 1) for i in range(60)]
    star = [(200, i) for i in range(201, 260)]
    pairs = [*chain, *star, (300, 301), (301, 300), (400, 400)]
    out = {r.node: r.root for r in components(rows(pairs, "a long, b long")).collect()}
    assert {out[i] for i in range(61)} == {0}
    assert {out[i] for i in range(200, 260)} == {200}
    assert out[301] == 300
    assert components(rows([], "a long, b long")).count() == 0


def test_close_pairs_inside_a_template_family_are_linked(rows):
    """Several hundred documents of one template, 0.7 to 0.8 to each other, and close copies of some of them."""
    rng = random.Random(29)
    base = words(rng, 170)
    family = [edited(rng, base, 0.0148) for _ in range(300)]
    family += [w[:40] + ["near"] + w[41:] for w in rng.sample(family, 150)]
    table = rows([(i, " ".join(w), "x", None) for i, w in enumerate(family)], SCHEMA)
    out = {r.doc_id: r for r in N.near_groups(table).collect()}
    idf = N.idf_table(table)
    feats = [N.weighted(" ".join(w).encode(), idf) for w in family]
    starts = np.concatenate(([0], np.cumsum([len(f) for f, _ in feats])[:-1]))
    drawn = N.samples(np.concatenate([f for f, _ in feats]), np.concatenate([w for _, w in feats]), starts)
    bands = np.stack([drawn[:, j :: N.ROWS] for j in range(N.ROWS)], axis=2)
    n_close, lost, similar = 0, [], []
    for a in range(len(family)):
        for b in range(a):
            value = N.weighted_jaccard(feats[a], feats[b])
            similar.append(value)
            if value >= N.SIMILAR and (bands[a] == bands[b]).all(axis=1).any():
                n_close += 1
                if out[a].group_id != out[b].group_id:
                    lost.append((a, b))
    assert 0.6 < np.mean(similar) < 0.79
    assert n_close > 150
    assert not lost


def test_texts_and_features_go_to_python_in_batches_of_bounded_bytes(spark, monkeypatch):
    from changeguard import session

    limits, plain = {}, N.written

    def noted(df, name):
        limits[name] = spark.conf.get(session.BATCH_SETTING, None)
        return plain(df, name)

    monkeypatch.setattr(N, "written", noted)
    docs = spark.createDataFrame([(i, f"{i % 2} " + " ".join(f"w{j}" for j in range(60))) for i in range(4)], "doc_id long, text string")
    assert {r.group_id for r in N.near_groups(docs).collect()} == {0}
    assert {limits[n] for n in ("signatures", "features", "links", "compared")} == {str(session.BATCH_BYTES)}
    assert spark.conf.get(session.BATCH_SETTING, None) is None

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    long = spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) as text")
    with session.small_batches(spark):
        found = [r.n for r in long.mapInArrow(sizes, "n long").collect()]
    assert len(found) > 1 and max(found) < session.BATCH_BYTES + 2_000_000
