import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeguard.llm import decontaminate as D

SCHEMA = "doc_id long, text string, n_words string"


def brute(texts, items, window=10):
    phrases = {}
    for item, text in items:
        w = [x.lower() for x in D.WORD.findall((text or "").translate(D.UPPER_TO_LOWER))]
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = []
    for text in texts:
        w = D.WORD.findall((text or "").translate(D.UPPER_TO_LOWER))
        hit, found = set(), set()
        for length in {len(p) for p in phrases}:
            for i in range(len(w) - length + 1):
                if tuple(w[i : i + length]) in phrases:
                    hit |= set(range(i, i + length))
                    found |= phrases[tuple(w[i : i + length])]
        out.append((len(w), sorted(hit), sorted(found)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=0, max_size=200))
def test_suffix_array_and_search(symbols):
    text = np.array([*symbols, 0])
    order = D.suffix_array(text.astype(np.int64))
    whole = text.tolist()
    assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    index = D.FMIndex(text)
    phrases = [[1], [2, 1], [3, 3, 3], [6, 5, 4, 3], symbols[:4] or [1]]
    rows = np.zeros((len(phrases), 4), np.int64)
    for k, p in enumerate(phrases):
        rows[k, : len(p)] = p[::-1]
    low, high = index.search(rows, np.array([len(p) for p in phrases]))
    for k, p in enumerate(phrases):
        places = [i for i in range(len(whole)) if whole[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == places


@pytest.mark.parametrize("block", [1 << 20, 60])
@pytest.mark.parametrize("shard", [1 << 20, 40])
def test_hits_equal_brute_force(rows, monkeypatch, block, shard):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    monkeypatch.setattr(D, "SHARD_BYTES", shard)
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "c", "dé", "e1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 2, 4, 12, 15])))) for i in range(8)] + [(9, None)]
    texts = [". ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(30)]
    texts += [items[4][1].upper() + "!", None, "", "?!", " ".join(["a"] * 5000)]
    out = D.hits(rows(list(enumerate(texts, 100)) and [(i, t, "x") for i, t in enumerate(texts)], SCHEMA), rows(items, "item_id long, text string"))
    got = sorted((r.doc_id, r.n_words, sorted(k for s in r.spans for k in range(s.start, s.end)), r.items, r.n_hit) for r in out.collect())
    want = [(i, n, hit, found, len(hit)) for i, (n, hit, found) in enumerate(brute(texts, items))]
    assert got == want


def test_no_benchmark_and_no_documents(rows):
    none = rows([], "item_id long, text string")
    assert [r.n_hit for r in D.hits(rows([(1, "a b", "x")], SCHEMA), none).collect()] == [0]
    assert D.hits(rows([], SCHEMA), rows([(1, "a")], "item_id long, text string")).count() == 0


def test_drop_and_cut(rows):
    items = rows([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    passage = "One two, three four five six seven eight nine ten. Eleven"
    docs = rows([(1, f"Héad {passage} tail.", "x"), (2, "clean one two", "y"), (2, "clean one two", "y"), (3, None, None)], SCHEMA)
    assert sorted(r.doc_id for r in D.decontaminate(docs, items).collect()) == [2, 2, 3]
    cut = D.decontaminate(docs, items, action="cut")
    assert cut.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in cut.collect())[:2] == [(1, "Héad  tail."), (2, "clean one two")]
    with pytest.raises(ValueError):
        D.decontaminate(docs, items, action="hide")
