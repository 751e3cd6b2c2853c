"""Benchmark decontamination: windows of words that a benchmark holds are found in documents and removed.

The distinct windows of the benchmark become sets of hashes that are broadcast. The bytes they take
are counted before; beyond ``SHARD_BYTES`` the windows are dealt to several sets, each of which
scans the documents apart. A task hashes every window of its documents, looks the hashes up and
compares the words of each hit, so that equal hashes alone never count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidelane.llm.common import ascii_lower, mixed, stored, text_blocks, word_hashes

#: Bytes of one broadcast set: the words of its windows, and 24 for each.
SHARD_BYTES = 32 << 20
#: Bytes of text that a task works on at once.
BLOCK_BYTES = 1 << 18

_STEP = np.uint64(0xD6E8FEB86659FD93)
_PLACES = 20

# Words are runs of digits, letters and all that isn't ASCII.
_SPACE = np.ones(256, bool)
_SPACE[48:58] = _SPACE[97:123] = _SPACE[65:91] = _SPACE[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = np.where(_SPACE, np.uint8(32), _LOWER)

_FOUND = "struct<spans:array<struct<first:int,last:int>>,items:array<string>>"
_MERGED = "struct<n_words:long,n_hit:long,text:string>"
_CLEAN = "struct<n_words:long,n_hit:long,items:array<string>,text:string>"


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive word hashes."""
    n = max(len(words) - width + 1, 0)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out *= _STEP
        out += words[k : k + n]
    return mixed(out)


class Windows:
    """Windows of a benchmark by hash: words, and the items that hold them."""

    def __init__(self, widths: list[int], texts: list[bytes], items: list[str]):
        self.widths = sorted(set(widths))
        hashes = np.empty(len(texts), np.uint64)
        for width in self.widths:
            these = [i for i, w in enumerate(widths) if w == width]
            joined = b" ".join(texts[i] for i in these)
            data = np.frombuffer(joined, np.uint8)
            words = word_hashes(data, np.array([0, len(data)]), _SPACE, _LOWER)[0]
            hashes[these] = window_hashes(words, width)[::width]
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.texts = [texts[i] for i in order]
        self.items = [items[i] for i in order]
        self.seen = np.zeros(1 << _PLACES, bool)
        self.seen[(self.hashes >> np.uint64(64 - _PLACES)).astype(np.int64)] = True

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, str]], tuple]:
        """First word of each row, hits as (word, width, item), and starts and ends of words."""
        words, first, starts, ends = word_hashes(data, bounds, _SPACE, _LOWER)
        found = []
        for width in self.widths:
            hashes = window_hashes(words, width)
            at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _PLACES)).astype(np.int64)])
            # A window stays in its row.
            at = at[np.searchsorted(first, at, "right") == np.searchsorted(first, at + width - 1, "right")]
            low, high = np.searchsorted(self.hashes, hashes[at], "left"), np.searchsorted(self.hashes, hashes[at], "right")
            some = high > low
            for i, lo, hi in zip(at[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
                text = b" ".join(_PLAIN[data[starts[i] : ends[i + width - 1]]].tobytes().split())
                found += [(i, width, self.items[k]) for k in range(lo, hi) if self.texts[k] == text]
        return first, found, (starts, ends)


def _rows_of(first: np.ndarray, found: list[tuple[int, int, str]]) -> dict[int, list[tuple[int, int, str]]]:
    """Hits by row, words numbered within the row."""
    out: dict[int, list] = {}
    if found:
        rows = np.searchsorted(first, [i for i, _, _ in found], "right") - 1
        for row, (i, width, item) in zip(rows.tolist(), found, strict=True):
            out.setdefault(row, []).append((i - int(first[row]), width, item))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches of words joined, in order; ends exclusive."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _without(data: np.ndarray, start: int, end: int, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    """Bytes from ``start`` to ``end`` less the stretches of words, what is between their words included."""
    kept, at = [], start
    for a, b in spans:
        kept.append(data[at : starts[a]].tobytes())
        at = int(ends[b - 1])
    return b"".join([*kept, data[at:end].tobytes()])


def _cleaner(windows: Broadcast):
    """Arrow function: a text's words, hit words, items and text without hits."""

    @F.arrow_udf(_CLEAN)
    def cleaned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            n_words, n_hit, items = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64), [[]] * len(column)
            changed: dict[int, str] = {}
            for at, data, bounds in text_blocks(column, BLOCK_BYTES):
                first, found, (starts, ends) = windows.value.hits(data, bounds)
                n_words[at : at + len(bounds) - 1] = np.diff(first)
                for row, hits in _rows_of(first, found).items():
                    spans = _merged([(i, i + width) for i, width, _ in hits])
                    n_hit[at + row] = sum(b - a for a, b in spans)
                    items[at + row] = sorted({item for _, _, item in hits})
                    own = slice(int(first[row]), int(first[row + 1]))
                    changed[at + row] = _without(data, bounds[row], bounds[row + 1], starts[own], ends[own], spans).decode()
            # Only changed texts travel back.
            text = [changed.get(i) for i in range(len(column))]
            yield pa.StructArray.from_arrays(
                [pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string())), pa.array(text, pa.string())],
                ["n_words", "n_hit", "items", "text"],
            )

    return cleaned.asNondeterministic()


def _finder(windows: Broadcast):
    """Arrow function: stretches of hit words, and items, for one of several sets of windows."""

    @F.arrow_udf(_FOUND)
    def found_in(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            spans, items = [[]] * len(column), [[]] * len(column)
            for at, data, bounds in text_blocks(column, BLOCK_BYTES):
                first, found, _ = windows.value.hits(data, bounds)
                for row, hits in _rows_of(first, found).items():
                    merged = _merged([(i, i + width) for i, width, _ in hits])
                    spans[at + row] = [{"first": a, "last": b} for a, b in merged]
                    items[at + row] = sorted({item for _, _, item in hits})
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.StructArray.from_arrays([pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))], ["spans", "items"])

    return found_in.asNondeterministic()


def _without_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Words, hit words and text without them, from stretches of words found by several sets."""
    n_words, n_hit, out = [], [], []
    for text, own in zip(texts, spans.to_pylist(), strict=True):
        data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
        _, _, starts, ends = word_hashes(data, np.array([0, len(data)]), _SPACE, _LOWER)
        merged = _merged([(s["first"], s["last"]) for s in own or []])
        n_words.append(len(starts))
        n_hit.append(sum(b - a for a, b in merged))
        out.append(_without(data, 0, len(data), starts, ends, merged).decode() if merged else None)
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(out, pa.string())], ["n_words", "n_hit", "text"])


def windows_of(benchmark: DataFrame, *, width: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item``, ``width``, ``words`` (bytes, one blank between) of the distinct windows of each item."""
    words = F.filter(F.split(ascii_lower(F.col(text_col)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: F.length(w) > 0)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words.alias("words"))
    items = items.filter(F.size("words") > 0).select("item", "words", F.least(F.size("words"), F.lit(width)).alias("width"))
    places = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    windows = F.transform(places, lambda i: F.array_join(F.slice("words", i, F.col("width")), " "))
    exploded = items.select("item", "width", F.explode(windows).alias("words"))
    return exploded.distinct().select("item", "width", F.encode("words", "UTF-8").alias("words"))


def _shards(windows: DataFrame, shard_bytes: int) -> list[DataFrame]:
    """The windows dealt to as many parts as it takes for each to be within ``shard_bytes``."""
    size = F.sum(F.octet_length("words") + F.octet_length("item") + 24).alias("size")
    total = windows.agg(size).first()["size"] or 0
    parts = max(1, -(-total // shard_bytes))
    while True:
        part = F.pmod(F.xxhash64("item", "width", "words"), F.lit(parts))
        largest = windows.groupBy(part.alias("part")).agg(size).agg(F.max("size")).first()[0] or 0
        rows = windows.groupBy(part).count().agg(F.max("count")).first()[0] or 0
        if parts == 1 or largest <= shard_bytes or rows <= 1:
            return [windows.filter(part == k) for k in range(parts)]
        parts *= 2


def _broadcast(windows: DataFrame) -> Broadcast:
    rows = windows.toArrow()
    found = Windows(rows["width"].to_pylist(), rows["words"].to_pylist(), rows["item"].to_pylist())
    return windows.sparkSession.sparkContext.broadcast(found)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, width: int = 10, drop: str | None = None, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside windows of the benchmark) and ``items`` (ids, as sorted strings).

    A window is ``width`` consecutive words of an item, or all words of a shorter one; words are
    lower-cased (A-Z) runs of digits, letters and what isn't ASCII. ``drop`` says what goes: None
    nothing, "spans" the hit words and all between them, "documents" rows with a hit. Without hits a
    text stays as it is. Null and empty texts have no words and stay; so do rows without an id,
    since rows are never told apart by one. Items with one id are one item, null ids are one item
    named by the empty string; items without words give no window, and an empty benchmark hits
    nothing. Rows that repeat are each returned. Columns of ``docs`` named like those added are
    replaced, all others stay.
    """
    if drop not in (None, "spans", "documents"):
        raise ValueError(f"unknown drop: {drop}")
    windows = stored(windows_of(benchmark, width=width, item_col=item_col, text_col=item_text_col), "windows")
    shards = _shards(windows, shard_bytes)
    fresh = _fresh(docs.columns)
    if len(shards) == 1:
        found = docs.withColumn(fresh, _cleaner(_broadcast(shards[0]))(F.col(text_col)))
    else:
        found = _by_shards(docs, shards, text_col, fresh)
    out = found.withColumns({name: F.col(f"{fresh}.{name}") for name in ("n_words", "n_hit", "items")})
    if drop == "spans":
        out = out.withColumn(text_col, F.coalesce(F.col(f"{fresh}.text"), F.col(text_col)))
    if drop == "documents":
        out = out.filter("n_hit = 0")
    return out.drop(fresh)


def _by_shards(docs: DataFrame, shards: list[DataFrame], text_col: str, fresh: str) -> DataFrame:
    """Hits by one scan per set of windows; only rows with hits are brought together, by a row number."""
    row, join = f"{fresh}_row", f"{fresh}_at"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")

    def scan(shard: DataFrame) -> DataFrame:
        hit = rows.select(F.col(row).alias(join), _finder(_broadcast(shard))(F.col(text_col)).alias("hit"))
        return hit.filter(F.size("hit.spans") > 0)

    hits = reduce(DataFrame.unionByName, [scan(shard) for shard in shards]).groupBy(join)
    merged = hits.agg(
        F.flatten(F.collect_list("hit.spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit.items")))).alias("items")
    )
    joined = rows.join(merged.withColumnsRenamed({"spans": f"{fresh}_spans", "items": f"{fresh}_items"}), F.col(row) == F.col(join), "left")
    joined = joined.withColumn(f"{fresh}_clean", F.arrow_udf(_without_spans, _MERGED).asNondeterministic()(F.col(text_col), F.col(f"{fresh}_spans")))
    items = F.coalesce(f"{fresh}_items", F.array().cast("array<string>"))
    clean = [F.col(f"{fresh}_clean.{name}").alias(name) for name in ("n_words", "n_hit", "text")]
    return joined.withColumn(fresh, F.struct(*clean, items.alias("items"))).drop(row, join, f"{fresh}_spans", f"{fresh}_items", f"{fresh}_clean")


def _fresh(columns: list[str]) -> str:
    """A column name that none of ``columns`` has."""
    name = "found"
    while any(c.lower().startswith(name) for c in columns):
        name += "_"
    return name
