import hashlib
import random

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

from tidelane.llm import fingerprints as module
from tidelane.llm.fingerprints import differing, digests, fingerprints, sketch, written

SCHEMA = "doc_id long, text string"


def texts(seed, count):
    deal = random.Random(seed)
    lines = [" ".join(f"w{deal.randrange(90)}" for _ in range(deal.randint(1, 40))) for _ in range(60)]
    return ["\n".join(deal.choices(lines, k=deal.randint(0, 12))) for _ in range(count)]


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_equals_sets(spark, ranges, monkeypatch):
    own = texts(1, 40)
    monkeypatch.setattr(module, "with_next", lambda f, i, c, into, _: module_with_next(f, i, c, into, ranges))
    rows = {r.doc_id: r for r in fingerprints(spark.createDataFrame([(7 * i, t) for i, t in enumerate(own)], SCHEMA)).collect()}
    assert len(rows) == len(own)
    new = brute.edited(own)
    for i, text in enumerate(own):
        row, other = rows[7 * i], own[(i + 1) % len(own)]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(new[i].encode()).hexdigest()
        a, b, c = (brute.units(t, module.PARAGRAPH_WORDS) for t in (text, new[i], other))
        assert row.near_edited == pytest.approx(brute.likeness(a, b))
        assert row.near_next == pytest.approx(brute.likeness(a, c))
        assert row.changed.ok and sorted(x.cnt for x in row.changed.found) == [-1] * len(b - a) + [1] * len(a - b)


from tidelane.llm.ranges import with_next as module_with_next  # noqa: E402


def test_peeling_recovers_digests_and_grows(spark):
    deal = random.Random(3)
    common = [deal.getrandbits(60) for _ in range(200)]
    only_a, only_b = ([deal.getrandbits(60) for _ in range(k)] for k in (150, 90))
    frame = spark.createDataFrame([(common + only_a, common + only_b)], "a array<long>, b array<long>")
    found = frame.select(differing(F.col("a"), F.col("b")).alias("d")).first().d
    assert found.ok
    assert {x.key for x in found.found if x.cnt == 1} == set(only_a)
    assert {x.key for x in found.found if x.cnt == -1} == set(only_b)


def test_a_sketch_too_small_is_built_again(spark, monkeypatch):
    monkeypatch.setattr(module, "ROUNDS", 1)  # peels only what is alone at once
    deal = random.Random(4)
    a = [deal.getrandbits(60) for _ in range(12)]
    frame = spark.createDataFrame([(a, [])], "a array<long>, b array<long>")
    found = frame.select(differing(F.col("a"), F.col("b")).alias("d")).first().d
    assert found.ok and {x.key for x in found.found} == set(a)


def test_equal_texts_have_equal_sketches(spark):
    frame = spark.createDataFrame([("a\nb c",), ("b c\na",), ("a\nb",)], "text string")
    x, y, z = (r[0] for r in frame.select(written(sketch(digests(F.col("text"))))).collect())
    assert x == y != z


def test_edges(spark):
    long = "\n".join(f"line {i} of many" for i in range(4000))
    rows = [(None, "x y"), (1, None), (1, None), (2, ""), (3, long), (4, "é" * 5), (5, "one")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, own int")
    got = fingerprints(frame).collect()
    assert len(got) == len(rows) and all(0 <= r.near_edited <= 1 and r.changed.ok for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].n_chars == 0 and by[1].fingerprint == "" and by[1].near_next == 1.0
    assert by[4].edited_sha256 == hashlib.sha256("éééon".encode()).hexdigest()
    assert by[5].edited_sha256 == hashlib.sha256(b"onx").hexdigest()  # the first row, of the null id, is next
    one = fingerprints(spark.createDataFrame([(9, "ab cd")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"ab ab").hexdigest() and one[0].near_next == 1.0
    assert fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_paragraphs_in_one_text(spark):
    lines = [f"line {i}" for i in range(3000)]
    frame = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(lines[:2000] + ["other"] * 5))], "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in fingerprints(frame).collect()}
    assert near[1] == near[2] == 2000 / 3001
