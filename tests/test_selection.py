import random

import pytest

from changeguard.operators import selection as S

SCHEMA = "module string, at long, id string"


def data(seed, n=3000, hot=0.4):
    rng = random.Random(seed)
    at = lambda: 7 if rng.random() < hot else None if rng.random() < 0.1 else rng.randint(-50, 2000)
    out = [(rng.choice(["a", "a", "a", "b", None]), at(), f"id{i:05d}") for i in range(n)]
    rng.shuffle(out)
    return out


def order(rows, desc, nulls_first):
    by_id = sorted(rows, key=lambda r: r[2])
    known = sorted((r for r in by_id if r[1] is not None), key=lambda r: -r[1] if desc else r[1])
    nulls = [r for r in by_id if r[1] is None]
    return nulls + known if nulls_first else known + nulls


@pytest.mark.parametrize(("desc", "nulls_first"), [(True, False), (False, True)])
def test_pages_equal_a_full_sort(rows, desc, nulls_first):
    every = data(1)
    df, want = rows(every, SCHEMA).cache(), order(every, desc, nulls_first)
    for first, size in ((0, 50), (700, 50), (1500, 7), (2990, 50), (5000, 10)):
        found = S.rows_between(df, [("at", desc), ("id", False)], first, first + size, nulls_first, small=60)
        assert [tuple(r) for r in found.collect()] == want[first:first + size]


@pytest.mark.parametrize("n", [1, 40, 900, 5000])
def test_first_of_groups_equal_a_full_sort(rows, n):
    every = data(2)
    found, truncated = S.first_per_group(rows(every, SCHEMA), ["module"], [("at", False), ("id", False)], n, True, small=50)
    groups = {m: order([r for r in every if r[0] == m], False, True) for m in ("a", "b", None)}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(r) for g in groups.values() for r in g[:n])
    assert {r.module: r.truncated for r in truncated.collect()} == {m: len(g) > n for m, g in groups.items()}


def test_empty_and_null_keys(rows):
    assert S.rows_between(rows([], SCHEMA), [("at", False)], 0, 5).collect() == []
    found, truncated = S.first_per_group(rows([], SCHEMA), ["module"], [("at", False)], 5)
    assert found.collect() == truncated.collect() == []
    nulls = rows([("a", None, str(i)) for i in range(30)], SCHEMA)
    assert [r.id for r in S.rows_between(nulls, [("at", False), ("id", True)], 0, 2, small=5).collect()] == ["9", "8"]
    found, _ = S.first_per_group(nulls, ["module"], [("at", False), ("id", False)], 3, small=5)
    assert sorted(r.id for r in found.collect()) == ["0", "1", "10"]
