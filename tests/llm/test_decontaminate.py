"""Benchmark windows in documents against a search of every place."""

import random
import re

import pytest
from pyspark.sql import Row

from tidelane.llm import decontaminate
from tidelane.llm.decontaminate import decontaminate as clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def plain(text, items, width=10):
    """Words, hit word numbers and sorted items of a text."""
    own, hit, found = words(text), set(), set()
    for item, source in items:
        w = words(source)
        size = min(len(w), width)
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(own), hit, sorted(found)


def tables():
    rng = random.Random(1)
    word = lambda: rng.choice(["Ab", "cd", "É", "f9", "gh-i", "jk", "LM", "n_o", "pq", "r"])
    text = lambda n: rng.choice([" ", ", ", "\x00", "\n"]).join(word() for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 40]))) for i in range(3, 24)] + [(None, text(12)), (5, text(15)), (30, None), (31, "...")]
    items = [(i, t) for i, t in items if t is None or len(words(t)) != 1]
    docs = [None, "", " .-", text(5), text(3000)]
    for _ in range(60):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            source = rng.choice(items)[1] or ""
            cut = rng.randrange(0, 20)
            parts += [source[cut:].upper() if rng.random() < 0.5 else source, "; ", text(rng.randrange(0, 9))]
        docs.append(" ".join(parts))
    return docs, items


@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 4000])
def test_every_place(spark, shard_bytes):
    docs, items = tables()
    frame = spark.createDataFrame([Row(doc_id=None if i == 3 else i // 2, text=t, place=i, Items="x", found_row=i) for i, t in enumerate(docs)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = clean(frame, bench, shard_bytes=shard_bytes)
    assert set(out.columns) == {"doc_id", "text", "place", "n_words", "n_hit", "items", "found_row"}
    got = {r.place: r for r in out.collect()}
    assert len(got) == len(docs)
    some = 0
    for i, text in enumerate(docs):
        n, hit, found = plain(text, items)
        some += bool(hit)
        assert (got[i].n_words, got[i].n_hit, got[i]["items"], got[i].text, got[i].found_row) == (n, len(hit), found, text, i)
    assert 10 < some < len(docs)
    if shard_bytes == 4000:
        assert len(decontaminate._shards(decontaminate.windows_of(bench), shard_bytes)) > 1


@pytest.mark.parametrize("shard_bytes", [decontaminate.SHARD_BYTES, 40])
def test_removal(spark, shard_bytes):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "short, item")], "item_id long, text string")
    texts = [
        "Before. One two three four five six seven eight nine; ten! After", "one two three", "A short -- ITEM. End é",
        "x one two three four five six seven eight nine ten short item y", None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.text for r in clean(docs, bench, drop="spans", shard_bytes=shard_bytes).collect()}
    assert spans == {0: "Before. ! After", 1: "one two three", 2: "A . End é", 3: "x  y", 4: None}
    kept = {r.doc_id for r in clean(docs, bench, drop="documents", shard_bytes=shard_bytes).collect()}
    assert kept == {1, 4}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id string, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in clean(docs, none).collect()] == [(2, 0, [])] * 2
    assert clean(docs.limit(0), spark.createDataFrame([("q", "a b")], "item_id string, text string")).collect() == []
    with pytest.raises(ValueError):
        clean(docs, none, drop="all")


def test_a_hash_alone_is_no_hit(spark, monkeypatch):
    windows = decontaminate.Windows([2], [b"a b"], ["1"])
    windows.texts = [b"a c"]
    import numpy as np

    data = np.frombuffer(b"a b", np.uint8)
    assert windows.hits(data, np.array([0, 3]))[1] == []


def test_long_and_full_texts(spark):
    item = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, " ".join([item] * 500))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, item) for i in range(3)], "item_id long, text string")
    row = clean(docs, bench, drop="spans").first()
    assert (row.n_words, row.n_hit, row["items"]) == (100_000, 100_000, ["0", "1", "2"]) and row.text.strip() == ""
