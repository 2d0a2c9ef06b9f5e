import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from changeguard.llm import packing as P

SCHEMA = "doc_id long, text string, ids string, place string"
ODD = [
    "It's we're I'LL don't 's", "Ünïcode ÉTÉ straße ΣΑΣ İstanbul ﬁ", "á é́ ñ", "x\x1cy\x1fz", "tab\tnl\n nb em",
    "<|endoftext|> a<|startoftext|>b", "123 4.5.6 ²½ a1b2", "...!!! ,, '' \"q\"", "日本語 한국어 😀👍🏽", "", "   ", "word, word. Word; WORD!", "a'b'c d'", "﻿bom",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_vocabulary())


@pytest.mark.parametrize("text", ODD)
def test_chunks_give_the_ids_of_the_tokenizer(tokenizer, text):
    ids = np.frombuffer(P.Chunks(P.default_vocabulary()).ids(text), P.ID_KIND).tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_hold_each_id_once_and_sequences_have_no_gap(rows, tokenizer):
    texts = [*ODD, None, "long word " * 6000, *(f"document {i} " + "lorem ipsum " * (i % 90) for i in range(120))]
    table = rows([(i, t, "x", None) for i, t in enumerate(texts)], SCHEMA)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in P.pack(table).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(texts)
    for i, text in enumerate(texts):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, P.END_ID]
        got = sorted(pieces[i], key=lambda r: r.start)
        assert [x for r in got for x in np.frombuffer(r.ids, P.OUT_KIND).tolist()] == want
        assert {r.doc_tokens for r in got} == {len(want)}
        assert all(zlib.crc32(bytes(r.ids)) == zlib.crc32(np.array(want[r.start : r.start + r.length], P.OUT_KIND).tobytes()) for r in got)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.LENGTH and at & (at - 1) == 0


def test_repeated_rows_null_keys_and_empty_table(rows):
    out = P.pack(rows([(1, "same", None, None)] * 3 + [(None, None, None, None)], SCHEMA)).collect()
    assert sum(r.length for r in out if r.doc_id == 1) == 6 and sum(r.length for r in out if r.doc_id is None) == 1
    assert P.pack(rows([], SCHEMA)).count() == 0


def test_the_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = P.place_on_curve(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_frequent_chunks_are_looked_up_once_and_case_makes_no_other_chunk(tokenizer, monkeypatch):
    monkeypatch.setattr(P.Chunks, "LIMIT", 20)
    known, asked = P.Chunks(P.default_vocabulary()), []
    look_up = known._looked_up
    monkeypatch.setattr(known, "_looked_up", lambda chunk: asked.append(chunk) or look_up(chunk))
    for i in range(200):
        text = f"often OFTEN x{chr(97 + i % 26)}{chr(97 + i // 26)}"
        assert np.frombuffer(known.ids(text), P.ID_KIND).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert asked.count("often") == 1 and "OFTEN" not in asked


@pytest.mark.parametrize("text", ["Ⱥb ȺC, 2Ⱦ", "<|EndOfText|> <|endoftext|>", "Kelvin K ſ Ω", "a\x85b\xa0c It'S 5's ('s ''s"])
def test_texts_are_lower_cased_first_only_where_no_id_changes(tokenizer, text):
    ids = np.frombuffer(P.Chunks(P.default_vocabulary()).ids(text), P.ID_KIND).tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_leave_in_bounded_batches(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 2)

    monkeypatch.setattr(P, "TaskContext", Task)
    sizes = [3 * P.OUT_TOKENS, 0, 5, 2043, 4096, 17]
    ids = pa.array([np.arange(n).astype(P.ID_KIND).tobytes() for n in sizes], pa.binary())
    table = pa.record_batch([pa.array(range(len(sizes))), ids], ["doc_id", "ids"])
    out = list(P._cut(iter([table.slice(0, 2), table.slice(2)])))
    assert max(sum(b.column("length").to_pylist()) for b in out) <= P.OUT_TOKENS
    rows = pa.Table.from_batches(out).to_pylist()
    for doc, n in enumerate(sizes):
        parts = [np.frombuffer(r["ids"], P.OUT_KIND) for r in rows if r["doc_id"] == doc]
        assert np.concatenate(parts).tolist() == [*np.arange(n).astype(P.ID_KIND).tolist(), P.END_ID]
    assert sum(r["length"] for r in rows) == sum(sizes) + len(sizes)
