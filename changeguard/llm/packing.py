"""Packing documents into sequences along a space-filling curve.

A document's bag of tokens is a vector with one hashed coordinate per token.
It is projected on a few Gaussian directions, placed on a Hilbert curve, and
the documents are range-sorted by their place.  Each range is cut into full
sequences, so neighbours on the curve share sequences.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.session import small_batches, written

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 12  # of the curve: 48 bits
RANGE_TOKENS = 1 << 22  # tokens in one sorted range
OUT_TOKENS = LENGTH << 9  # tokens of pieces handed to Spark at once
ID_KIND = np.dtype("<u2")  # ids of the vocabularies here are below 65,536
OUT_KIND = np.dtype("<u4")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


# Python takes these for white space, the vocabulary's pattern does not.
_SPLITS_ALIKE = "\x1c\x1d\x1e\x1f"
# Characters below U+0300 have nothing to compose, and one lower case; that of İ, Ⱥ and Ⱦ is not below.
_HIGH = re.compile("[^\x00-\u02ff]").search


class Chunks(dict):
    """Ids of texts without white space, for the chunks met last.

    The vocabulary drops white space and cuts texts at it, so the ids of a
    text are those of its chunks in order.  A chunk of Latin letters goes
    straight through the merges, one with ASCII marks after them is two such
    chunks; any other goes through the whole tokenizer.  When ``LIMIT`` chunks
    are new, those of the round before are let go, but for those met again.
    """

    MARKS = string.punctuation
    LIMIT = 300_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.whole.get_added_tokens_decoder().values()]
        self.tokenize, self.symbols = self.whole.model.tokenize, _byte_symbols()
        self.packed = [ID_KIND.type(i).tobytes() for i in range(1 << 16)]
        self.before = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self._looked_up(chunk)
        if len(self) >= self.LIMIT:
            self.before = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def _looked_up(self, chunk: str) -> bytes:
        low = chunk.lower()
        if low.isascii():  # a letter of ASCII is its own symbol
            core = mapped = low.rstrip(self.MARKS)
        elif not (_HIGH(chunk) or _HIGH(low)):
            core = low.rstrip(self.MARKS)
            mapped = core.encode().decode("latin-1").translate(self.symbols)
        else:
            return self._encoded(chunk)
        if not core.isalpha():
            return self._encoded(chunk)
        if len(core) < len(low):
            return self[core] + self[low[len(core) :]]
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(mapped)])

    def _encoded(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, ID_KIND).tobytes()

    def ids(self, text: str) -> bytes:
        if any(c in text for c in _SPLITS_ALIKE):
            return self._encoded(text)
        low = text.lower()
        if not (_HIGH(text) or _HIGH(low) or any(t in low for t in self.added)):
            text = low  # its chunks have the same ids, and fewer of them differ
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def chunks(path: str) -> Chunks:
    return Chunks(path)


@lru_cache(maxsize=1)
def directions() -> np.ndarray:
    return np.random.default_rng(41).standard_normal((1 << 16, DIMS)).astype(np.float32)


def place_on_curve(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (rows), by undoing the rotation of each level from the top down."""
    x = [c.astype(np.int64) for c in cells.T]
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(dims):
            turned = (x[i] & level) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        level >>= 1
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((x[-1] & level) > 0, turn ^ (level - 1), turn)
        level >>= 1
    out = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for axis in x:
            out = (out << 1) | (((axis ^ turn) >> bit) & 1)
    return out


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Each document's place on the curve.

    The unit vector of its token counts has standard normal coordinates on
    Gaussian directions; the normal distribution function makes them even.
    """
    table, points = directions(), np.zeros((len(ids), DIMS), np.float32)
    for k, one in enumerate(ids):
        if len(one):
            ordered = np.sort(one)
            new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            size = np.diff(np.append(new, len(ordered))).astype(np.float32)
            points[k] = size @ table[ordered[new]] / np.sqrt(float(size @ size))
    # tanh is the usual close form of the normal distribution function
    even = 0.5 * (1 + np.tanh(0.7978845608 * (points + 0.044715 * points**3)))
    return place_on_curve(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def _tokenised(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = chunks(path)
    for batch in batches:
        ids = [known.ids(t or "") for t in batch.column("text").to_pylist()]
        keys = curve_keys([np.frombuffer(x, ID_KIND) for x in ids])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(keys)], names=["doc_id", "ids", "place"]
        )


PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _pieces(ids: np.ndarray, docs: pa.Array, begins: np.ndarray, tokens: np.ndarray, at: np.ndarray, stop: int, first: int) -> pa.RecordBatch:
    """The pieces of a stream of ids from the first of ``at``, where its sequences begin, to ``stop``.

    ``begins`` is where each document begins, before the stream if that is under 0.
    """
    inside = begins[(begins > at[0]) & (begins < stop)]
    cuts = np.union1d(at, inside)
    doc = np.searchsorted(begins, cuts, "right") - 1
    sequence = np.searchsorted(at, cuts, "right") - 1
    ends = np.append(cuts, stop)
    data = pa.py_buffer(ids[at[0] : stop].astype(OUT_KIND))
    places = pa.py_buffer(((ends - at[0]) * OUT_KIND.itemsize).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            docs.take(pa.array(doc)),
            pa.array(cuts - begins[doc]),
            pa.array(np.diff(ends)),
            pa.Array.from_buffers(pa.binary(), len(cuts), [None, places, data]),
            pa.array(tokens[doc]),
            pa.array(first + sequence),
            pa.array(cuts - at[sequence]),
        ],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted range of (doc_id, ids) to pieces.

    The tokens that are left at its end become sequences of powers of two,
    so they need no padding either.
    """
    sequence = TaskContext.get().partitionId() << 32
    # the sequence that is not full yet: its ids, the documents in it, where they begin and their sizes
    ids, docs, begins, tokens = np.empty(0, ID_KIND), None, np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        packed = batch.column("ids").to_pylist()
        sizes = np.array([len(x) for x in packed], np.int64) // ID_KIND.itemsize + 1
        ends = np.cumsum(sizes)
        more = np.full(ends[-1], END_ID, ID_KIND)
        text = np.ones(len(more), bool)
        text[ends - 1] = False
        more[text] = np.frombuffer(b"".join(packed), ID_KIND)
        begins = np.append(begins, len(ids) + ends - sizes)
        ids, tokens = np.append(ids, more), np.append(tokens, sizes)
        docs = batch.column("doc_id") if docs is None else pa.concat_arrays([docs, batch.column("doc_id")])
        full = len(ids) // LENGTH * LENGTH
        for start in range(0, full, OUT_TOKENS):
            stop = min(full, start + OUT_TOKENS)
            at = np.arange(start, stop, LENGTH)
            yield _pieces(ids, docs, begins, tokens, at, stop, sequence)
            sequence += len(at)
        opened = begins + tokens > full
        ids, docs, begins, tokens = ids[full:], docs.filter(pa.array(opened)), begins[opened] - full, tokens[opened]
    if len(ids):
        sizes = [LENGTH >> i for i in range(1, LENGTH.bit_length()) if len(ids) & (LENGTH >> i)]
        yield _pieces(ids, docs, begins, tokens, np.cumsum([0, *sizes[:-1]]), len(ids), sequence)


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents: key, start, length, ids (little-endian unsigned 32 bits), doc_tokens, sequence_id, offset.

    A document is the ids of its text and then id 1; a null or empty text is
    that id alone.  Each id is in exactly one piece, pieces fill their
    sequence without a gap, sequences hold 2048 ids, and those at the end of a
    range smaller powers of two.  Repeated rows are packed each for itself;
    documents at the same place follow each other in the order of their rows.
    Other columns are not read.
    """
    path = vocabulary or default_vocabulary()
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    with small_batches(docs.sparkSession):
        tokens = written(
            rows.mapInArrow(lambda batches: _tokenised(batches, path), f"doc_id {kind}, ids binary, place long").withColumn(
                "row", F.monotonically_increasing_id()
            ),
            "tokens",
        )
    total = tokens.agg(F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()[0] // ID_KIND.itemsize
    ranges = max(1, -(-total // RANGE_TOKENS))
    return (
        tokens.repartitionByRange(ranges, "place", "row")
        .sortWithinPartitions("place", "row")
        .select("doc_id", "ids")
        .mapInArrow(_cut, f"doc_id {kind}, {PIECES}")
        .withColumnRenamed("doc_id", key)
    )
