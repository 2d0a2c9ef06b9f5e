"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character left alone; null stays null.

    ``lower`` is the quick way where a text has no other characters to touch.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _separators() -> bytes:
    """Byte table: A-Z to a-z; every ASCII byte that is no letter or digit to a space."""
    out = bytearray(range(256))
    for b in range(128):
        if not chr(b).isalnum():
            out[b] = 32
    for upper, lower in zip(UPPER, LOWER):
        out[ord(upper)] = ord(lower)
    return bytes(out)


# For UTF-8: bytes above 0x7F stay, so a word is a run of letters, digits and non-ASCII characters.
WORD_BYTES = _separators()


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text: A-Z lower-cased, cut at every ASCII character that is no letter or digit."""
    return text.translate(WORD_BYTES).split()


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1] or bytes(8), np.int64 if wide else np.int32)
    return offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)


class byte_texts(Sequence):
    """An Arrow text column as UTF-8 bytes; null as an empty text.  Texts are copied one at a time, when they are asked for."""

    def __init__(self, column: pa.Array):
        self.offsets = _offsets(column) if len(column) else np.zeros(1, np.int64)
        self.data = memoryview(column.buffers()[2] or b"")
        if column.null_count:  # a null may have bytes behind it
            self.ends = np.where(column.is_null().to_numpy(zero_copy_only=False), self.offsets[:-1], self.offsets[1:])
        else:
            self.ends = self.offsets[1:]

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, i: int) -> bytes:
        if not -len(self) <= i < len(self):
            raise IndexError(i)
        return bytes(self.data[self.offsets[i - (i < 0)] : self.ends[i]])


def array_views(column: pa.Array, kind: type) -> list[np.ndarray]:
    """A binary column of packed numbers as arrays over the column's own memory."""
    if not len(column):
        return []
    offsets = _offsets(column)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[a:b].view(kind) for a, b in zip(offsets[:-1], offsets[1:])]


def hashed(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process.

    A word is hashed each time it is met: keeping hashes costs more than that
    once the words of a corpus outgrow the processor's caches.
    """
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def word_hashes(text: bytes) -> np.ndarray:
    return hashed(words(text))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes over all bits (an invertible xor-shift and multiply step)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)


MULTIPLIER = 0x9E3779B97F4A7C15


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words in order; fewer words, but not none, are one shingle."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    # a run is two of half its length, the first one raised past the second, and a word more if its length is odd
    out, held = hashes, 1
    for bit in bin(size)[3:]:
        out = out[:-held] * np.uint64(pow(MULTIPLIER, held, 1 << 64)) + out[held:]
        held *= 2
        if bit == "1":
            out = out[:-1] * np.uint64(MULTIPLIER) + hashes[held:]
            held += 1
    return mixed(out + np.uint64(size))


def most_frequent(rows: DataFrame, size: str, most: int) -> DataFrame:
    """At most ``most`` of ``rows``: all above a frequency that keeps to that, found from a histogram.

    The histogram has 32 steps for each doubling, so about two thousand at any size.
    """
    step = F.floor(F.log2(F.col(size)) * 32)
    total, floor = 0, None
    for found in rows.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += found["count"]
        if total > most:
            break
        floor = found["step"]
    return rows.filter(step >= floor) if floor is not None else rows.limit(0)
