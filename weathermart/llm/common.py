"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words: the space and the control characters 0x09 to 0x0D.
BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null and for blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def utf8_crc32(text: Column) -> Column:
    return F.crc32(F.encode(text_or_empty(text), "UTF-8"))


class WordHashes(dict):
    """64-bit hash of each word, remembered for as many words as ``limit``."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_FOLD = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xD6E8FEB86659FD93)


def stir(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the whole word."""
    values = (values ^ (values >> np.uint64(32))) * _STIR
    values = (values ^ (values >> np.uint64(32))) * _STIR
    return values ^ (values >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, by position; of the whole if it is shorter."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, np.uint64(size))
    for i in range(size):
        out = out * _FOLD + hashes[i : i + n]
    return stir(out)


def as_long(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs, bit for bit."""
    return values.view(np.int64)


def lower_words(data: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; ``bytes`` methods touch ASCII only."""
    return data.lower().split() if data else []


def slices(batches: Iterable[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a batch expands to stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


_NAME = re.compile(r"\W+")


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, prolonged until no input column has it (names are compared without case)."""
    taken = {c.lower() for c in columns}
    name = _NAME.sub("_", name)
    while name.lower() in taken:
        name += "_"
    return name


# Longs of a key filter: 512 KB, whatever the number of keys.
FILTER_WORDS = 1 << 16
_SHIFTS = (0, 29)


def _slots(key: Column, longs: int) -> list[tuple[Column, Column]]:
    out = []
    for shift in _SHIFTS:
        bits = F.shiftrightunsigned(key, shift)
        word = F.pmod(F.shiftrightunsigned(bits, 6), F.lit(longs)).cast("int")
        out.append((word, bits.bitwiseAND(F.lit(63)).cast("int")))
    return out


def key_filter(keys: DataFrame, column: str, longs: int = FILTER_WORDS) -> Column:
    """A Bloom filter of a column of hashes: one array of ``longs``, evaluated once as a subquery.

    It saves shuffles before a join and has no false negatives. Its size is fixed; with
    very many keys it lets more rows pass, and the join decides as it would without it.
    """
    both = [F.struct(w.alias("word"), b.alias("bit")) for w, b in _slots(F.col(column), longs)]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    filled = keys.select(F.inline(F.array(*both))).groupBy("word").agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(longs).select(F.col("id").cast("int").alias("word"))
    dense = every.join(filled, "word", "left").select("word", F.coalesce("bits", F.lit(0)).alias("bits"))
    # As many rows as the filter has longs.
    return dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all")).select(
        F.col("all.bits")
    ).scalar()


def may_hold(key: Column, known: Column, longs: int = FILTER_WORDS) -> Column:
    first, second = [F.getbit(F.get(known, word), bit) == 1 for word, bit in _slots(key, longs)]
    return F.coalesce(first & second, F.lit(False))
