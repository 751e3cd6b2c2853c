"""Periodic runs of words, found by internal pattern matching.

The words of a block of texts are ranked by their first 1, 2, 4, ... words (prefix doubling), which
orders their suffixes. A wavelet matrix over that order answers which occurrences of a word
sequence start in a given range. For every length of a power of two the text is cut into dyadic
blocks, and each block's occurrences in the window beside it are asked for: a run of period q holds
such a block that occurs again q words later. Occurrences in a window of the block's length are an
arithmetic progression, so its first two members, its last, and the shifts that lay the ends of its
periodic stretch on those of the block's are all that q can be. Each candidate is extended both
ways by comparing ranks, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidelane.llm.common import text_blocks, word_hashes

#: Bytes of text ranked together; a longer text is ranked alone.
BLOCK_BYTES = 1 << 18
#: Length of the smallest dyadic block, as a power of two.
SMALLEST = 3

_SAME = np.arange(256, dtype=np.uint8)
_RUNS = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,text:string>"


class Wavelet:
    """Wavelet matrix of numbers below 2**bits: counts and order statistics of any slice, for arrays of queries."""

    def __init__(self, numbers: np.ndarray, bits: int):
        self.bits, self.zeros, self.before = bits, [], []
        at = numbers
        for level in reversed(range(bits)):
            bit = (at >> level) & 1
            before = np.zeros(len(at) + 1, np.int32)
            np.cumsum(bit == 0, out=before[1:])
            self.before.append(before)
            self.zeros.append(int(before[-1]))
            at = np.concatenate([at[bit == 0], at[bit == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many numbers of ``[lo, hi)`` are below ``limit``."""
        lo, hi, out = lo.copy(), hi.copy(), np.zeros(len(lo), np.int64)
        whole = limit >= 1 << self.bits
        out[whole] = (hi - lo)[whole]
        for level, before, zeros in zip(reversed(range(self.bits)), self.before, self.zeros, strict=True):
            a, b = before[lo], before[hi]
            one = (limit >> level) & 1 == 1
            out += np.where(one & ~whole, b - a, 0)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of rank ``k`` (from 0) in ``[lo, hi)``."""
        lo, hi, k, out = lo.copy(), hi.copy(), k.copy(), np.zeros(len(lo), np.int64)
        for level, before, zeros in zip(reversed(range(self.bits)), self.before, self.zeros, strict=True):
            a, b = before[lo], before[hi]
            one = k >= b - a
            out += np.where(one, 1 << level, 0)
            k = np.where(one, k - (b - a), k)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return out


class Ranks:
    """Ranks of all suffixes by their first ``2**k`` symbols, for each ``k`` up to ``levels``.

    A rank is the number of suffixes that are smaller, so a suffix that is alone keeps its rank, and
    equal ranks mean equal first symbols. The last symbol must occur once.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        self.by_level = [self._ranked(symbols[order], order, np.arange(n), n)]
        active = self._shared(order, self.by_level[0])
        for k in range(levels):
            old = self.by_level[-1]
            if not len(active):
                self.by_level.append(old)
                continue
            key = old[active].astype(np.int64) * n + old[active + (1 << k)]
            inner = np.argsort(key, kind="stable")
            active, key = active[inner], key[inner]
            # Members of a group stay in its places of the order, so ranks count on from the group's own.
            new = old.copy()
            group = key // n
            within = np.arange(len(key)) - np.searchsorted(group, group)
            self._ranked(key, active, group + within, n, new)
            self.by_level.append(new)
            active = self._shared(active, new)

    @staticmethod
    def _ranked(key: np.ndarray, suffixes: np.ndarray, places: np.ndarray, n: int, out: np.ndarray | None = None) -> np.ndarray:
        out = np.empty(n, np.int32) if out is None else out
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        out[suffixes] = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        return out

    @staticmethod
    def _shared(ordered: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Those of suffixes in order that share their rank with another."""
        r = rank[ordered]
        same = r[1:] == r[:-1]
        return ordered[np.concatenate([same, [False]]) | np.concatenate([[False], same])]

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on are equal."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        last = len(self.by_level[0]) - 1
        top = len(self.by_level) - 1
        going = np.arange(len(a))
        # The longest step may be taken more than once, each shorter one at most once.
        while len(going):
            same = self.by_level[top][np.minimum(a[going], last)] == self.by_level[top][np.minimum(b[going], last)]
            going = going[same]
            a[going] += 1 << top
            b[going] += 1 << top
            out[going] += 1 << top
        for k in reversed(range(top)):
            same = self.by_level[k][np.minimum(a, last)] == self.by_level[k][np.minimum(b, last)]
            step = np.where(same, 1 << k, 0)
            a, b, out = a + step, b + step, out + step
        return out

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and before ``b`` are equal; ``a < b``."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        top = len(self.by_level) - 1

        def equal(k: int, these: np.ndarray) -> np.ndarray:
            fits = a[these] >= 1 << k
            x, y = np.where(fits, a[these] - (1 << k), 0), np.where(fits, b[these] - (1 << k), 0)
            return fits & (self.by_level[k][x] == self.by_level[k][y])

        going = np.arange(len(a))
        while len(going):
            going = going[equal(top, going)]
            a[going] -= 1 << top
            b[going] -= 1 << top
            out[going] += 1 << top
        everything = np.arange(len(a))
        for k in reversed(range(top)):
            step = np.where(equal(k, everything), 1 << k, 0)
            a, b, out = a - step, b - step, out + step
        return out


def _candidates(ranks: Ranks, wavelet: Wavelet, place: np.ndarray, level: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and shifts that may be periods, from the dyadic blocks of ``2**level`` words.

    ``place[r]`` is where suffixes of rank ``r`` or more begin in the wavelet matrix.
    """
    size = 1 << level
    rank = ranks.by_level[level]
    blocks = np.arange(0, n - size, size)
    lo = place[rank[blocks]]
    hi = lo + _group_sizes(rank)[rank[blocks]]
    some = hi - lo > 1
    blocks, lo, hi = blocks[some], lo[some], hi[some]
    found_at, found_q = [], []
    # A run of period q, size <= q < 2 * size, shows in the second window; the smallest blocks serve smaller periods, too.
    windows = [(1, size + 1), (size + 1, 2 * size)] if level == SMALLEST else [(size, 2 * size)]
    for near, far in windows:
        before = wavelet.below(lo, hi, blocks + near)
        count = wavelet.below(lo, hi, blocks + far) - before
        has = count > 0
        j, a, b, first, many = blocks[has], lo[has], hi[has], before[has], count[has]
        o1 = wavelet.smallest(a, b, first)
        o2 = wavelet.smallest(a, b, first + np.minimum(many, 2) - 1)
        o3 = wavelet.smallest(a, b, first + many - 1)
        found_at += [j, j, j]
        found_q += [o1 - j, o2 - j, o3 - j]
        # Three or more are a progression: both the block and they lie in stretches whose period is its step.
        more = many > 2
        if more.any():
            j, o1, step = j[more], o1[more], (o2 - o1)[more]
            found_at += [j, j]
            found_q += [o1 + ranks.right(o1, o1 + step) - j - ranks.right(j, j + step), o1 - ranks.left(o1, o1 + step) - j + ranks.left(j, j + step)]
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, q = np.concatenate(found_at), np.concatenate(found_q)
    keep = (q > 0) & (at + q < n)
    return at[keep], q[keep]


def _group_sizes(rank: np.ndarray) -> np.ndarray:
    return np.bincount(rank, minlength=len(rank))


def runs_of(symbols: np.ndarray, longest: int, *, least: int = 24, times: int = 3) -> np.ndarray:
    """Start, length and smallest period of every maximal run of ``max(least, times * period)`` symbols or more.

    ``symbols`` (int64) may be several sequences, each followed by a symbol that occurs once;
    ``longest`` is the length of the longest. ``times`` is 3 or more and ``least`` 24 or more.
    """
    n = len(symbols)
    if longest < least:
        return np.empty((0, 3), np.int64)
    # Only blocks up to a third of a sequence can lie in a run with a word beside them.
    levels = max(SMALLEST, (longest // times).bit_length() - 1)
    ranks = Ranks(symbols, levels)
    rank = ranks.by_level[SMALLEST]
    shared = np.flatnonzero(_group_sizes(rank)[rank] > 1)
    if not len(shared):
        return np.empty((0, 3), np.int64)
    # Suffixes whose first eight symbols occur once are in no group that is asked for, so the matrix leaves them out.
    order = shared[np.argsort(ranks.by_level[levels][shared], kind="stable")]
    wavelet = Wavelet(order, max(1, int(n).bit_length()))
    kept = np.zeros(n + 1, np.int64)
    kept[1:] = np.cumsum(np.bincount(ranks.by_level[levels][shared], minlength=n))
    found = [_candidates(ranks, wavelet, kept, level, n) for level in range(SMALLEST, levels + 1)]
    at, q = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack([q, at]), axis=1)
    q, at = pairs
    start = at - ranks.left(at, at + q)
    length = at + q + ranks.right(at, at + q) - start
    good = length >= np.maximum(least, times * q)
    # A stretch that a multiple of its period describes as well is the same stretch; its smallest period counts.
    order = np.lexsort((q[good], length[good], start[good]))
    start, length, q = start[good][order], length[good][order], q[good][order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    out = np.stack([start[new], length[new], q[new]], axis=1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _analysed(data: np.ndarray, bounds: np.ndarray, least: int, times: int) -> Iterator[tuple[int, list, list]]:
    """Number of words, runs and kept words (bytes) of each row of a block."""
    hashes, first, starts, ends = word_hashes(data, bounds, lower=_SAME)
    n_words = np.diff(first)
    own: dict[int, list] = {}
    long = np.flatnonzero(n_words >= least)
    if len(long):
        ids = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
        # Each row that may hold a run, then a symbol of its own.
        parts, origin, at = [], [], 0
        for k, row in enumerate(long.tolist()):
            parts += [ids[first[row] : first[row + 1]], np.array([len(ids) + k])]
            origin.append(at)
            at += int(n_words[row]) + 1
        found = runs_of(np.concatenate(parts), int(n_words[long].max()), least=least, times=times)
        owner = np.searchsorted(origin, found[:, 0], "right") - 1
        for k, (start, length, q) in zip(owner.tolist(), found.tolist(), strict=True):
            own.setdefault(int(long[k]), []).append((start - origin[k], length, q))
    for row in range(len(n_words)):
        runs = own.get(row, [])
        words = data[bounds[row] : bounds[row + 1]].tobytes().split()
        if runs:
            gone = np.zeros(len(words) + 1, np.int64)
            for start, length, q in runs:
                gone[start + q] += 1
                gone[start + length] -= 1
            words = [w for w, covered in zip(words, np.cumsum(gone).tolist(), strict=False) if not covered]
        yield int(n_words[row]), runs, words


def _finder(least: int, times: int):
    @F.arrow_udf(_RUNS)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for column in texts:
            n_words, sizes, flat, out = [], [0], [], []
            for _, data, bounds in text_blocks(column, BLOCK_BYTES):
                for n, runs, words in _analysed(data, bounds, least, times):
                    n_words.append(n)
                    flat += runs
                    sizes.append(len(flat))
                    out.append(b" ".join(words).decode())
            columns = np.array(flat, np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=list(kind))
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs)
            yield pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), lists, pa.array(out, pa.string())], ["n_words", "runs", "text"])

    return found.asNondeterministic()


def find_runs(docs: DataFrame, *, least: int = 24, times: int = 3, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``.

    Words are runs of anything but blanks, told apart by 64-bit hashes and numbered from 0. A run is
    a stretch of words that repeats with a smallest ``period``, is at least ``max(least, times *
    period)`` words long (``least`` 24, ``times`` 3 or more) and can't be extended. ``collapsed`` is
    the text, its words joined by one blank, without words that a run holds beyond its first
    ``period``. Null and empty texts have no words, no runs and an empty ``collapsed``. Rows stand
    alone: repeated rows and null ids are returned as they are. Memory follows the longest single
    text: about 4 bytes for each of its words and each power of two up to a third of their number.
    Columns of ``docs`` named like those added are replaced, all others stay.
    """
    if least < 24 or times < 3:
        raise ValueError("runs shorter than 24 words or three periods are not sought")
    fresh = "found"
    while fresh in {c.lower() for c in docs.columns}:
        fresh += "_"
    found = docs.withColumn(fresh, _finder(least, times)(F.col(text_col)))
    columns = {"n_words": F.col(f"{fresh}.n_words"), "runs": F.col(f"{fresh}.runs"), "collapsed": F.col(f"{fresh}.text")}
    return found.withColumns(columns).drop(fresh)
