"""Helpers that several operators of this package share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import cache
from string import ascii_lowercase, ascii_uppercase
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of text that numpy works on at once; a longer text is worked on alone.
BLOCK_BYTES = 1 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder named by ``spark.checkpoint.dir``.

    Only where that setting is missing and all runs in one process (tests) is a folder made here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid4().hex}"


def stored(frame: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``frame`` written to the shared folder and read again, which also cuts its lineage.

    Once the table is written nothing reads the shuffle files of that job again, so Spark drops them then.
    With ``batch``, Python gets so many rows at a time.
    """
    spark = frame.sparkSession
    path = shared_path(spark, name)
    settings = {_CLEANUP: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        frame.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, UTF-8 bytes and offsets of runs of rows of about ``size`` bytes; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield at, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


_SPACE = np.zeros(256, bool)
_SPACE[[ord(x) for x in BLANKS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_usual_powers = cache(_powers)


def _power_table(base: int, n: int) -> np.ndarray:
    return _usual_powers(base, 2 * BLOCK_BYTES) if n <= 2 * BLOCK_BYTES else _powers(base, n)


def word_bounds(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every run of bytes outside ``space``; no word crosses a row's end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~space[data]
    starts = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cut = bounds[1:-1]
    joined = cut[inside[cut] & inside[cut + 1]]
    starts[joined] = True
    ends[joined] = True
    return np.flatnonzero(starts), np.flatnonzero(ends)


def word_hashes(
    data: np.ndarray, bounds: np.ndarray, space: np.ndarray = _SPACE, lower: np.ndarray = _LOWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word, its bytes taken by ``lower`` (A-Z to a-z), first word of each row, starts and ends.

    The hash is the word's polynomial modulo 2**64, taken from running sums, then mixed.
    """
    starts, ends = word_bounds(data, bounds, space)
    return hashes_of(data, starts, ends, lower), np.searchsorted(starts, bounds), starts, ends


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: np.ndarray = _LOWER) -> np.ndarray:
    """64-bit hash of each stretch of bytes, taken by ``lower``."""
    weights = _power_table(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower[data].astype(np.uint64) + np.uint64(1)) * weights[: len(data)], out=sums[1:])
    back = _power_table(_BASE_INVERSE, len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class Bits:
    """A set of hashes as a bit table of fixed size: no false negatives, whatever its load.

    Its size is a parameter and doesn't follow the data, so it may be sent to every task.
    """

    def __init__(self, words: np.ndarray, log2: int):
        self.words, self.log2 = words, log2

    @staticmethod
    def of(hashes: DataFrame, column: str, log2: int = 24) -> "Bits":
        """Bit table of a column of 64-bit hashes; at most ``2**(log2 - 6)`` words reach the driver."""
        place = F.shiftrightunsigned(F.col(column), 64 - log2)
        found = (
            hashes.select(
                F.shiftright(place, 6).alias("word"),
                F.call_function(
                    "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")
                ).alias("bit"),
            )
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .toArrow()
        )
        words = np.zeros(1 << (log2 - 6), np.uint64)
        words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return Bits(words, log2)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - self.log2)
        word = self.words[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) != 0
