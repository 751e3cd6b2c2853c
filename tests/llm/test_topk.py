import random

import numpy as np
from pyspark.sql import functions as F

from tidelane.llm import topk as module
from tidelane.llm.topk import product, top_k, whole_numbers

SCHEMA = "vec_id long, vector array<long>"


def plain(rows, asked, k):
    out = []
    for q, x in asked:
        found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in rows if i != q and len(x) == len(y))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_equals_plain_search_with_ties(spark, monkeypatch):
    monkeypatch.setattr(module, "TILE", 16)
    monkeypatch.setattr(module, "BLOCK", 4)
    deal = random.Random(1)
    rows = [(i, [deal.randint(-3, 3) for _ in range(4 if i % 9 else 5)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    asked = [r for r in rows if r[0] % 10 == 0]
    got = top_k(frame, frame.filter("vec_id % 10 = 0"), k=7).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, asked, 7)


def test_tiles_and_blocks_meet_in_groups(spark, monkeypatch):
    for name, size in (("TILE", 16), ("BLOCK", 4), ("TILES", 1), ("BLOCKS", 2)):
        monkeypatch.setattr(module, name, size)
    deal = random.Random(2)
    rows = [(i, [deal.randint(-9, 9) for _ in range(3)]) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = top_k(frame, frame.filter("vec_id % 8 = 0"), k=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dim" in plan and "across" in plan and "down" in plan
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, [r for r in rows if r[0] % 8 == 0], 5)


def test_products_are_exact():
    a = np.array([[1 << 40, 3]]), np.array([[1 << 20, 5], [7, -2]])
    assert product(*a).tolist() == [[(1 << 60) + 15, (7 << 40) - 6]]


def test_edges(spark):
    rows = [(1, [1, 2], "a"), (1, [2, 2], "a"), (2, None, "a"), (3, [1, None], "a"), (None, [1, 1], "a"), (4, [], "a"), (5, [0, 1], "a"), (6, [], "b")]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>, score string")
    got = sorted(tuple(r) for r in top_k(frame, frame, k=3).collect())
    assert got == [(1, 1, 5, 2), (4, 1, 6, 0), (5, 1, 1, 2), (5, 2, 1, 2), (6, 1, 4, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert top_k(empty, empty).collect() == []


def test_repeated_rows_of_a_query_take_no_place(spark):
    rows = [(0, [9, 9])] * 6 + [(i, [i % 7, 1]) for i in range(1, 30)]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = top_k(frame, frame.filter("vec_id = 0"), k=10).collect()
    assert sorted(tuple(r) for r in got) == plain(rows, [rows[0]], 10)


def test_whole_numbers(spark):
    rows = [([0.5, -0.0001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)]
    got = spark.createDataFrame(rows, "x array<float>").select(whole_numbers(F.col("x"))).collect()
    assert [r[0] for r in got] == [[512, -1], None, None, None, None, []]
