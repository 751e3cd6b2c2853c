import zlib
from collections import defaultdict

import numpy as np
import pytest

import pyarrow as pa

from tidelane.llm import packing
from tidelane.llm.packing import best_fit, pack, plan

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(text, capacity):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]
    return [(k, at, ids[at : at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]


def check(rows, docs, capacity):
    wanted = sorted((i is None, i or 0, k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t, *_ in docs for k, at, ids in reference(t, capacity))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_round_trip(spark):
    words = ["Eau,", "thé", "don't", "x1y22", "...", "<|endoftext|>", "\x1c", "　", "ﬁ", "İ", "naïve!!", "é", "ΣΑΣ"]
    docs = [(i, " ".join(words[(i * k) % len(words)] for k in range(i % 50)), 1) for i in range(200)]
    docs += [(500, None, 1), (501, "", 1), (None, "a b", 1), (3, docs[3][1], 1), (502, "\n\t ", 1), (503, "w " * 5000, 1)]
    rows = pack(spark.createDataFrame(docs, "doc_id long, text string, part int"), PATH, capacity=64).collect()
    total = sum(r.length for r in rows)
    assert check(rows, docs, 64) <= -(-total // 64) + 1


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_all_lengths_in_few_sequences(seed):
    deal = np.random.default_rng(seed)
    capacity = int(deal.integers(8, 300))
    lengths = deal.integers(1, capacity + 1, int(deal.integers(0, 3000)))
    if seed % 2:
        lengths = np.minimum(lengths, capacity // 3 + 1)
    counts = np.bincount(lengths, minlength=capacity + 1)
    for made in (best_fit(counts, capacity), plan(counts, capacity)):
        held = np.zeros(capacity + 1, int)
        for repeats, content in made:
            assert sum(a * b for a, b in content) <= capacity
            for a, b in content:
                held[a] += repeats * b
        assert (held == counts).all()
    assert sum(n for n, _ in plan(counts, capacity)) <= sum(n for n, _ in best_fit(counts, capacity)) * 1.01 + 1


def test_encoder_equals_the_tokenizer_on_odd_words(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "WORDS_KEPT", 300)
    monkeypatch.setattr(packing, "BLOCK_BYTES", 2000)
    deal = np.random.default_rng(1)
    letters = list("aBcZéÉÃ×÷ßÿΣσİ漢🙂0_'-!?.,;:*&%$#\u00a0\u2003\x1c\x00<|>")
    texts = [None, "", *(" ".join("".join(deal.choice(letters, deal.integers(1, 7))) for _ in range(deal.integers(0, 40))) for _ in range(400))]
    encoder = packing.WordEncoder(PATH)
    assert encoder.by_words
    whole = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 0], text


def test_a_tokenizer_that_joins_words_gets_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"a b": 1, "a": 2, "b": 3, "?": 0}, unk_token="?"))
    tokenizer.pre_tokenizer = pre_tokenizers.Split("|", "removed")
    tokenizer.save(str(tmp_path / "t.json"))
    encoder = packing.WordEncoder(str(tmp_path / "t.json"))
    assert not encoder.by_words
    assert [x.tolist() for x in encoder.encode(pa.array(["a b|a", None]))] == [[1, 2, 0], [0]]
