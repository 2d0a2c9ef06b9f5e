import dataclasses
import random

import pytest

from changeguard.operators import merkle as M

SCHEMA = "id string, stage string, amount double"
DATA = [(str(i), "new" if i % 3 else None, float(i % 7)) for i in range(400)]


def root(rows, data, depth=2):
    return {r.level: r.hash for r in M.merkle_tree(rows(data, SCHEMA), ["stage", "amount"], depth).collect()}[0]


def test_root_depends_on_rows_alone(rows):
    shuffled = DATA[:]
    random.Random(1).shuffle(shuffled)
    assert root(rows, DATA) == root(rows, shuffled)
    for other in (DATA[1:], DATA + [DATA[0]], DATA[:-1] + [("399", "", 0.0)], [("x", *DATA[0][1:])] + DATA[1:],
                  [(DATA[1][0], *DATA[0][1:]), (DATA[0][0], *DATA[1][1:])] + DATA[2:]):
        assert root(rows, other) != root(rows, DATA)


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_proofs_hold_and_forged_ones_do_not(rows, depth):
    leaves = M.leaves(rows(DATA, SCHEMA), ["stage", "amount"], depth).cache()
    nodes = M.tree(leaves, depth).cache()
    top = nodes.where("level = 0").head().hash
    proof = M.prove(leaves, nodes, depth, "17")
    assert M.holds(proof, top) and not M.holds(proof, "0" * 64)
    assert M.prove(leaves, nodes, depth, "no such id") is None
    forged = "f" * 64
    assert not M.holds(dataclasses.replace(proof, leaf=forged), top)
    assert not M.holds(dataclasses.replace(proof, leaf=forged, bucket=(*proof.bucket, f"{proof.place}:{forged}")), top)
    if depth:
        first = proof.siblings[0][0]
        assert not M.holds(dataclasses.replace(proof, siblings=(((first[0], first[1], forged), *proof.siblings[0][1:]), *proof.siblings[1:])), top)
        assert not M.holds(dataclasses.replace(proof, siblings=proof.siblings[:-1]), top)


def test_drift_is_located(rows):
    after = [r for r in DATA if r[0] != "5"] + [("new", None, None)]
    after = [("8", "other", 1.0) if r[0] == "8" else r for r in after] + [("9", *DATA[9][1:])]
    found = M.located_drift(rows(DATA, SCHEMA), rows(after, SCHEMA), ["stage", "amount"], 2).collect()
    assert {(r.id, r.drift) for r in found} == {("5", "removed"), ("new", "added"), ("8", "changed"), ("9", "changed")}
    one, two = (M.merkle_tree(rows(d, SCHEMA), ["stage", "amount"], 2) for d in (DATA, after))
    assert {r.node for r in M.differing(one, two, 2).collect()} == {r.bucket for r in found}
    assert M.located_drift(rows(DATA, SCHEMA), rows(DATA[::-1], SCHEMA), ["stage", "amount"], 2).collect() == []


def test_empty_tables_and_null_keys(rows):
    assert M.merkle_tree(rows([], SCHEMA), ["stage"]).collect() == []
    found = M.located_drift(rows([], SCHEMA), rows([(None, "a", 1.0), (None, "a", 1.0), ("", "a", 1.0)], SCHEMA), ["stage"], 1)
    assert [r.drift for r in found.collect()] == ["added"]
    assert [M.depth_for(n) for n in (0, 256, 257, 4096, 4097, 10**12)] == [0, 0, 1, 1, 2, 8]
