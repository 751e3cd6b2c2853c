"""Periodic runs against a search of every shift."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_brute import WORD
from pyspark.sql import Row

from tidelane.llm import periodic
from tidelane.llm.queries import op13_periodic_runs


def brute(words, least=24, times=3):
    out = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, times * q):
                out.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def sequences():
    rng = random.Random(7)
    for _ in range(300):
        yield [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(0, 160))]
    for _ in range(300):  # repeats of repeats, with errors
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        for _ in range(rng.randrange(1, 3)):
            unit = unit * rng.randrange(1, 7) + [rng.randrange(3) for _ in range(rng.randrange(0, 6))]
        words = (unit * rng.randrange(1, 9))[:400]
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = 9
        yield words
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    yield b
    morse = [0]
    while len(morse) < 512:
        morse += [1 - x for x in morse]
    yield morse
    yield [0, 0, 1] * 40 + [0] * 30 + [0, 0, 1] * 40
    yield list(range(100)) * 3 + [5]


def test_runs_of_many_sequences_match_every_shift():
    for words in sequences():
        symbols = np.array([*words, 100], np.int64)
        found = periodic.runs_of(symbols, len(words))
        assert [tuple(x) for x in found.tolist()] == brute(words), words


def test_sequences_together_are_the_same_as_apart():
    some = list(sequences())[::7]
    parts, origin, at = [], [], 0
    for k, words in enumerate(some):
        parts += [*words, 1000 + k]
        origin.append(at)
        at += len(words) + 1
    found = periodic.runs_of(np.array(parts, np.int64), max(map(len, some)))
    expected = [(s + o, n, q) for o, words in zip(origin, some, strict=True) for s, n, q in brute(words)]
    assert [tuple(x) for x in found.tolist()] == sorted(expected)


@pytest.mark.parametrize("bits", [1, 5, 11])
def test_wavelet_counts_and_order(bits):
    rng = np.random.default_rng(bits)
    numbers = rng.integers(0, 1 << bits, 700)
    wavelet = periodic.Wavelet(numbers, bits)
    lo = rng.integers(0, 699, 200)
    hi = lo + 1 + (rng.random(200) * (700 - lo - 1)).astype(np.int64)
    limit = rng.integers(0, (1 << bits) + 2, 200)
    k = (rng.random(200) * (hi - lo)).astype(np.int64)
    assert wavelet.below(lo, hi, limit).tolist() == [int((numbers[a:b] < c).sum()) for a, b, c in zip(lo, hi, limit)]
    assert wavelet.smallest(lo, hi, k).tolist() == [int(np.sort(numbers[a:b])[c]) for a, b, c in zip(lo, hi, k)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_on_odd_rows(spark):
    texts = [
        None, "", " \t\n", "one two", "A b\x0bc d " * 8 + "end", "A a " * 12, "x " * 24, "x " * 23, "éè ü " * 30 + "tail " + "q w e " * 9,
        "x " * 24,
    ]
    rows = [Row(doc_id=None if i == 3 else i // 2, text=t, Found=i, runs="mine", FOUND_="kept") for i, t in enumerate(texts)]
    frame = periodic.find_runs(spark.createDataFrame(rows))
    assert set(frame.columns) == {"doc_id", "text", "Found", "FOUND_", "n_words", "runs", "collapsed"}
    got = {r.Found: r for r in frame.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = WORD.findall(text or "")
        runs = brute(words)
        assert got[i].FOUND_ == "kept" and got[i].text == text
        assert got[i].n_words == len(words)
        assert [tuple(r) for r in got[i].runs] == runs
        assert got[i].collapsed == collapsed(words, runs)
    assert periodic.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text_in_seconds(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(40000)) for _ in range(150_000)]
    words[20_000:80_000] = (words[20_000:35_000] * 4)[:60_000]
    words[100_000:130_000] = ["a", "a", "b"] * 10_000
    frame = periodic.find_runs(spark.createDataFrame([Row(text=" ".join(words))]))
    runs = [tuple(r) for r in frame.first().runs]
    assert runs == [(20_000, 60_000, 15_000), (100_000, 30_000, 3)] or [r[2] for r in runs] == [15_000, 3]


def edited(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_against_plain_version(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        words = [str(rng.randrange(30)) for _ in range(rng.randrange(0, 200))]
        rows.append((None if i == 9 else -i if i % 7 == 0 else i, None if i == 4 else rng.choice([" ", "\n", " \t"]).join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.asDict() for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        words = words if doc_id is None else edited(doc_id, words)
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        some += bool(best)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        start, length, period = best or (None,) * 3
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(runs), "start": start, "length": length, "period": period,
            "exponent_milli": 1000 * length // period if best else None,
            "runs_sha256": sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), "collapsed_sha256": sha(collapsed(words, runs)),
        }
    assert some > 5
