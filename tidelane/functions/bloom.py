"""Bloom filters as plain columns: an array of 64-bit words, built by an aggregate and tested by bit operations.

The array has a fixed length, so it can go to every task whatever the number of keys. A filter
with many keys lets more rows through than it should, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a filter, as a power of two: 128 KB, and under one row in 30 let through in vain at 100,000 keys.
LOG2_BITS = 20


def bloom(keys: DataFrame, log2_bits: int = LOG2_BITS) -> Column:
    """Filter of the rows of ``keys`` (all its columns), as a scalar subquery."""
    words = 1 << (log2_bits - 6)
    place = F.explode(F.array(*_places(keys.columns, log2_bits)))
    bits = (
        keys.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(_bit(F.col("place"))).alias("bits"))
    )
    # Every word in its place, those without a bit as zero.
    numbered = keys.sparkSession.range(0, words, 1, 1).withColumnRenamed("id", "word")
    filled = numbered.join(bits, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")).alias("entry"))
    return filled.agg(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e.bits).alias("words")).scalar()


def may_hold(words: Column, columns: list[str], log2_bits: int = LOG2_BITS) -> Column:
    """Whether the filter may hold a row's ``columns``; false only for rows that it surely lacks."""
    tests = [F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _places(columns, log2_bits)]
    return tests[0] & tests[1]


def _places(columns: list[str], log2_bits: int) -> list[Column]:
    hashed, mask = F.xxhash64(*columns), F.lit((1 << log2_bits) - 1)
    return [hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
