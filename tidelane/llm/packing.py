"""Best-fit packing of token sequences by length patterns.

Lengths have a histogram of at most ``capacity`` entries, whatever the number of documents; so the
plan is made of lengths alone. *Patterns* of a few lengths that fill a sequence are enumerated,
their repeat counts are fitted to the histogram by non-negative least squares and rounded down,
and what remains is packed best-fit-decreasing, again by counts. Pieces get their places from their
rank among pieces of their length.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidelane.llm.common import hashes_of, stored, text_blocks, word_bounds

#: Texts, bytes of texts and words that are worked on at a time. A worker forgets words beyond ``WORDS_KEPT``.
BLOCK_BYTES, WORDS_KEPT = 1 << 18, 400_000

# Kinds of bytes: letters (A-Z and the two bytes of Latin-1 letters), marks that no tokenizer of the kind joins to letters, others.
_LETTER, _MARK, _OTHER = 0, 1, 2
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[65:91] = _KIND[97:123] = _KIND[0xC3] = _KIND[0x80:0xC0] = _LETTER
_KIND[[ord(c) for c in "!#$%&*,.:;?"]] = _MARK
#: Places of the table of words, as a power of two; at most a fifth of them are taken.
_LOG2 = 21

# Texts that show whether a tokenizer takes words one by one and marks apart from letters, and is blind to case.
_PROBES = [
    "The quick (brown) fox's 3.14 JUMPS, over; the l4zy-dog!?", "a b\tc\n\nd  e\x0bf\x0cg\rh", "Émile's naïve CAFÉ, señor; Übermaß... ¿qué?",
    "x\x1cy z\x1f w\u00a0v \u2003u", "https://a.example/b?c=d&e#f user@example.com +1 (555) 010-9999", "ǅ ﬁ İstanbul ΣΑΣ 漢字 かな 🙂!",
]


class WordEncoder:
    """Token ids of blocks of texts, each text's followed by a 0.

    A tokenizer that drops blanks and never joins what they part may be asked word by word. Words
    are looked up by their hashes, A-Z in lower case, of a plain word the letters and the marks by
    themselves; those not met before are encoded. Whether a tokenizer is of that kind is tried
    on loading; one that isn't gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.by_words = True
        column = pa.array(_PROBES)
        self.by_words = [x.tolist() for x in self.encode(column)] == [[*ids, 0] for ids in self._whole(_PROBES)]

    def _forget(self) -> None:
        # Place 0 is the closing 0, a word of its own; in the table it also stands for none.
        self.table = np.zeros(1 << _LOG2, np.int32)
        self.keys, self.starts, self.sizes = (np.zeros(WORDS_KEPT, t) for t in (np.uint64, np.int64, np.int64))
        self.sizes[0] = 1
        self.known = 1
        self.ids = np.zeros(1 << 16, np.uint32)
        self.filled = 1

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, as unsigned 32-bit numbers."""
        for at, data, bounds in text_blocks(texts, BLOCK_BYTES):
            if not self.by_words:
                for ids in self._whole([x or "" for x in texts.slice(at, len(bounds) - 1).to_pylist()]):
                    yield np.array([*ids, 0], np.uint32)
                continue
            words, first, starts, ends = _parts(data, bounds)
            places = np.insert(self._places(words, data, starts, ends), first[1:], 0)
            sizes = self.sizes[places]
            total = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.ids[np.repeat(self.starts[places] - total[:-1], sizes) + np.arange(total[-1])]
            cut = total[first + np.arange(len(first))]
            for low, high in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                yield ids[low:high]

    def _places(self, words: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where each word's ids are told, after learning those that are new."""
        places = self._found(words)
        new = np.flatnonzero(places == 0)
        if not len(new):
            return places
        fresh, at = np.unique(words[new], return_index=True)
        if self.known + len(fresh) > WORDS_KEPT and self.known > 1:
            self._forget()
            return self._places(words, data, starts, ends)
        at, raw = new[at], data.tobytes()
        found = self._whole([raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        while self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        own = np.arange(self.known, self.known + len(fresh))
        while own[-1] >= len(self.keys):  # one block may hold more words than are kept
            self.keys, self.starts, self.sizes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.keys, self.starts, self.sizes))
        self.keys[own], self.sizes[own], self.starts[own] = fresh, sizes, self.filled + np.cumsum(sizes) - sizes
        self.known, self.filled = self.known + len(fresh), self.filled + len(ids)
        slot = self._slots(fresh)
        while len(own):
            free = self.table[slot] == 0
            self.table[slot[free]] = own[free]
            out = self.table[slot] != own
            own, slot = own[out], (slot[out] + 1) & (len(self.table) - 1)
        return self._found(words)

    def _slots(self, words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - _LOG2)).astype(np.int64)

    def _found(self, words: np.ndarray) -> np.ndarray:
        """Places of known words, 0 for others; slots that others took are passed over."""
        slot = self._slots(words)
        places = self.table[slot]
        left = np.flatnonzero((places != 0) & (self.keys[places] != words))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.table) - 1)
            at = self.table[slot]
            places[left] = at
            more = (at != 0) & (self.keys[at] != words[left])
            left, slot = left[more], slot[more]
        return places


def _parts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words, the first of each row, starts and ends; marks after plain letters are a word of their own."""
    starts, ends = word_bounds(data, bounds)
    kind = _KIND[data]
    # Of the letters beyond ASCII only C3 and its followers are plain, but for the signs of times and division.
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    follows = (data >= 0x80) & (data < 0xC0)
    kind[follows & (~after | (data == 0x97) | (data == 0xB7))] = _OTHER
    counts = [np.concatenate([[0], np.cumsum(kind == k, dtype=np.int32)]) for k in (_LETTER, _OTHER)]
    letters = counts[0][ends] - counts[0][starts]
    turn = starts + letters
    plain = (counts[1][ends] == counts[1][starts]) & (counts[0][turn] - counts[0][starts] == letters) & (letters > 0) & (turn < ends)
    cut = np.flatnonzero(plain)
    # The stretch behind each cut word's letters is put in after it.
    all_starts = np.insert(starts, cut + 1, turn[cut])
    all_ends = np.insert(ends, cut, turn[cut])
    hashes = hashes_of(data, all_starts, all_ends) | np.uint64(1)
    return hashes, np.searchsorted(all_starts, bounds), all_starts, all_ends


@cache
def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks that a worker runs."""
    return WordEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every piece of every row.

    A row's ids are its text's and a closing 0 (null and empty texts: just that); rows of more than
    ``capacity`` ids are cut into pieces of that many, the last may be shorter.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            sums = []
            for k, ids in enumerate(encoder.encode(batch["text"])):
                sizes[k] = len(ids)
                if len(ids) <= capacity:
                    sums.append(zlib.crc32(ids))
                else:
                    sums += [zlib.crc32(ids[at : at + capacity]) for at in range(0, len(ids), capacity)]
            cut = -(-sizes // capacity)
            row = np.repeat(np.arange(batch.num_rows), cut)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(cut) - cut, cut)
            start = piece * capacity
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(np.minimum(capacity, sizes[row] - start)), pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, piece int, start long, length long, ids_crc32 long")


Plan = list[tuple[int, tuple[tuple[int, int], ...]]]


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """(repeats, ((length, copies), ...)) that pack ``counts[length]`` pieces, longest first, each into the fullest sequence with room."""
    open_: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    rooms = np.zeros(capacity + 1, bool)
    done: Plan = []

    def put(room: int, repeats: int, content: tuple) -> None:
        if not repeats:
            return
        if room == 0:
            done.append((repeats, content))
        else:
            open_[room].append((repeats, content))
            rooms[room] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fit = np.flatnonzero(rooms[length:])
            if not len(fit):
                each = capacity // length
                full, rest = divmod(left, each)
                put(capacity - each * length, full, ((length, each),))
                put(capacity - rest * length, int(rest > 0), ((length, rest),))
                break
            room = length + int(fit[0])
            repeats, content = open_[room].pop()
            rooms[room] = bool(open_[room])
            each = room // length
            full = min(repeats, left // each)
            rest = left - full * each if full < repeats else 0
            rest = min(rest, each - 1)
            put(room - each * length, full, (*content, (length, each)))
            if rest:
                put(room - rest * length, 1, (*content, (length, rest)))
            put(room, repeats - full - (rest > 0), content)
            left -= full * each + rest
    return done + [x for room in sorted(open_) for x in open_[room]]


def patterns(counts: np.ndarray, capacity: int, variants: int = 4, most: int = 6) -> Plan:
    """Few-document patterns: each length with others in stock that fill a sequence to the end."""
    stock = np.flatnonzero(counts[: capacity + 1])
    found: dict[tuple, None] = {}
    for length in stock[::-1].tolist():
        for v in range(variants):
            content, room = [length], capacity - length
            while room and len(content) < most:
                fit = stock[: np.searchsorted(stock, room, "right")]
                if not len(fit):
                    break
                if len(content) == most - 1 or v == 0:
                    pick = int(fit[-1])
                else:  # leave a rest that is in stock, with the v-th share of the room
                    pick = int(fit[np.searchsorted(fit, max(room * v // (v + 1), 1), "right") - 1] if fit[0] <= room * v // (v + 1) else fit[0])
                content.append(pick)
                room -= pick
            if room == 0:
                found[tuple(sorted(content, reverse=True))] = None
    return [(0, tuple((x, c.count(x)) for x in dict.fromkeys(c))) for c in found]


def fitted(choices: Plan, counts: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Repeat counts x >= 0 with least squares of ``choices @ x - counts``, by coordinate descent."""
    columns = [(np.array([a for a, _ in c]), np.array([b for _, b in c], float)) for _, c in choices]
    norms = [float(v @ v) for _, v in columns]
    x, left = np.zeros(len(choices)), counts.astype(float).copy()
    for _ in range(sweeps):
        moved = 0.0
        for k, (rows, v) in enumerate(columns):
            step = max(float(v @ left[rows]) / norms[k], -x[k])
            if step:
                x[k] += step
                left[rows] -= step * v
                moved = max(moved, abs(step))
        if moved < 0.01 * max(1.0, x.max(initial=0)):
            break
    return x


def plan(counts: np.ndarray, capacity: int) -> Plan:
    """Patterns with repeats that hold exactly ``counts[length]`` pieces of each length.

    Besides the enumerated patterns the fit may repeat those that best-fit packing of the whole
    histogram comes to. Counts are rounded down and kept within the stock; the rest is packed
    best-fit-decreasing. Of a few shares of the fitted counts, which leave more or less to that, the
    one with the fewest sequences is taken.
    """
    choices = dict.fromkeys(c for _, c in patterns(counts, capacity))
    choices |= dict.fromkeys(c for _, c in best_fit(counts, capacity) if sum(a * b for a, b in c) == capacity)
    choices = [(0, c) for c in choices]
    repeats = fitted(choices, counts)
    plans = [_rounded(choices, share * repeats, counts, capacity) for share in (1.0, 0.9, 0.75, 0.5, 0.25)]
    return min(plans, key=lambda made: sum(n for n, _ in made))


def _rounded(choices: Plan, repeats: np.ndarray, counts: np.ndarray, capacity: int) -> Plan:
    out, counts = [], counts.copy()
    for k in np.argsort(-repeats, kind="stable"):
        content = choices[k][1]
        n = min([int(repeats[k]), *(int(counts[a]) // b for a, b in content)])
        if n > 0:
            out.append((n, content))
            for a, b in content:
                counts[a] -= n * b
    return out + best_fit(counts, capacity)


def _slots(made: Plan) -> dict[str, np.ndarray]:
    """For each length in a pattern: its ranks from ``first`` on, the sequence and the offset they start at."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for repeats, content in made:
        offset = 0
        for length, copies in content:
            rows.append((length, used[length], sequence, copies, offset))
            used[length] += repeats * copies
            offset += length * copies
        sequence += repeats
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "copies", "offset"), table.T.copy(), strict=True))


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` of every piece.

    Null and empty texts are one piece of length 1. Null ids stay null; rows with equal ids (or equal
    rows) are packed each. No rows give no pieces. Other columns of ``docs`` are not looked at.
    At most ``capacity`` counts reach the driver. Ranks among pieces of one length are counted within what
    one task cut, and from the counts of the tasks before it.
    """
    cut = pieces(docs, tokenizer, capacity=capacity, id_col=id_col, text_col=text_col)
    cut = stored(cut.withColumn("part", F.spark_partition_id()), "pieces")
    counts = stored(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    found = counts.groupBy("length").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(capacity + 1, np.int64)
    table[found["length"].to_numpy()] = found["n"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(_slots(plan(table, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(order)).join(before, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rank") - 1).drop("before", "part")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = sent.value
        wide = np.int64(1) << np.int64(44)
        keys = slots["length"] * wide + slots["first"]
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            at = np.searchsorted(keys, length * wide + rank, "right") - 1
            inner, nth = np.divmod(rank - slots["first"][at], slots["copies"][at])
            columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(slots["sequence"][at] + inner), pa.array(slots["offset"][at] + nth * length)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
