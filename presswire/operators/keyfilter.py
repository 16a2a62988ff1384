"""A bitmap of the keys a table holds, to leave out rows that cannot join before they move.

A key's hash is a number below the bitmap's size; ``bitmap_construct_agg`` gathers the
numbers into slices of 32,768 bits. The slices are a table of bounded size, which is
broadcast; a row stays if its bit is set. Rows without a partner pass by chance, about
one in sixteen; none with a partner is lost.

``phrase_filter`` is the same for phrases whose words are arrays in a Python task: a phrase's
number follows from its words' hashes, so those that are left out are never put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 15  # fixed value: bits of one result of bitmap_construct_agg
BITS_PER_KEY = 16
MOST_BITS = 1 << 29  # 64 MB; more keys make the filter weaker, not larger


def _number(on: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1  # slices count from 1


def bit_is_set(bits: Column, at: Column) -> Column:
    """Whether a result of ``bitmap_construct_agg`` has the bit of ``bitmap_bit_position``."""
    byte = F.ascii(F.decode(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1


@dataclass(frozen=True)
class KeyFilter:
    """Bits of the keys ``on`` of a table. The compared columns must have the same types."""

    slices: DataFrame
    on: tuple[str, ...]
    bits: int

    def admit(self, rows: DataFrame) -> DataFrame:
        """``rows`` without those whose key the table does not hold, by a narrow step."""
        number = _number(list(self.on), self.bits)
        sliced = rows.withColumn("_slice", F.bitmap_bucket_number(number)).join(F.broadcast(self.slices), "_slice")
        return sliced.filter(bit_is_set(F.col("_bits"), F.bitmap_bit_position(number))).select(*rows.columns)


def key_filter(table: DataFrame, on: list[str], bits: int | None = None) -> KeyFilter:
    """The filter of a table; ``bits`` follows the number of its rows unless given."""
    if bits is None:
        bits = min(MOST_BITS, BITS_PER_KEY * table.count())
    bits = max(1, -(-bits // SLICE)) * SLICE
    number = _number(on, bits)
    numbered = table.select(F.bitmap_bucket_number(number).alias("_slice"), F.bitmap_bit_position(number).alias("_at"))
    return KeyFilter(numbered.groupBy("_slice").agg(F.bitmap_construct_agg("_at").alias("_bits")), tuple(on), bits)


_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(27))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number of each word: its bytes as a polynomial, mixed."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words) or ends[0] == ends[-1]:
        return _mixed(np.zeros(len(words), dtype=np.uint64))
    sizes = np.diff(ends)
    powers = np.cumprod(np.full(int(sizes.max()), _BASE, dtype=np.uint64))
    place = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], sizes)
    terms = (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)) * powers[place]
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms)])
    return _mixed(total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]])


def joined_hashes(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The number of phrases from that of all but the last word, and of the last word."""
    return _mixed(head * _BASE + last)


def _first_hashes(by: pa.Array) -> np.ndarray:
    return word_hashes(pc.fill_null(by, ""))


@dataclass(frozen=True)
class PhraseFilter:
    """Bits of ``(by, phrase)`` of a table, at hand in every Python task."""

    held: Broadcast
    bits: int

    def starts(self, by: str | None) -> np.ndarray:
        return _first_hashes(pa.array([by], pa.string()))

    def admits(self, hashes: np.ndarray) -> np.ndarray:
        number = hashes % np.uint64(self.bits)
        byte = self.held.value[(number >> np.uint64(3)).astype(np.int64)]
        return (byte >> (number & np.uint64(7)).astype(np.uint8)) & 1 == 1


def phrase_filter(table: DataFrame, by: str, phrase: str, bits: int | None = None) -> PhraseFilter:
    """The filter of a table of phrases, words parted by blanks; its slices pass the driver, at most ``MOST_BITS`` in all."""
    if bits is None:
        bits = min(MOST_BITS, BITS_PER_KEY * table.count())
    bits = max(1, -(-bits // SLICE)) * SLICE

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pc.split_pattern(pc.fill_null(batch.column("phrase"), ""), " ")
            sizes = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            words = word_hashes(parts.flatten())
            begins = np.cumsum(sizes) - sizes
            hashes = _first_hashes(batch.column("by"))
            for k in range(int(sizes.max(initial=0))):
                some = np.flatnonzero(sizes > k)
                hashes[some] = joined_hashes(hashes[some], words[begins[some] + k])
            yield pa.RecordBatch.from_arrays([pa.array((hashes % np.uint64(bits)).astype(np.int64) + 1)], ["n"])

    numbers = table.select(F.col(by).cast("string").alias("by"), F.col(phrase).alias("phrase")).mapInArrow(number, "n bigint")
    sliced = numbers.select(F.bitmap_bucket_number("n").alias("slice"), F.bitmap_bit_position("n").alias("at"))
    held = np.zeros(bits // 8, dtype=np.uint8)
    for row in sliced.groupBy("slice").agg(F.bitmap_construct_agg("at").alias("bits")).collect():  # a row a slice
        first = (row["slice"] - 1) * (SLICE // 8)
        held[first : first + SLICE // 8] = np.frombuffer(row["bits"], np.uint8)
    return PhraseFilter(table.sparkSession.sparkContext.broadcast(held), bits)
