import random
from collections import Counter

from tidelane.llm.common import shared_path
from tidelane.llm.line_runs import LineRuns, drop_frequent_lines

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def plain(rows, least, length):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= length and held[key(x)] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else t))
    return out


def test_equals_plain_count(spark):
    deal = random.Random(1)
    lines = [f" Line {i} " for i in range(30)] + ["", " ", "É", "é", "x\r", "X"]
    rows = [(i % 90, "\n".join(deal.choices(lines, k=deal.randint(0, 9)))) for i in range(100)]
    rows += [(None, rows[0][1]), (None, None), (200, None), (201, ""), (202, "\n" * 3000 + "Line 1"), rows[5], (203, "y\n" * 9)]
    frame = spark.createDataFrame([(i, t, 0, "h") for i, t in rows], "doc_id long, text string, n_lines int, hash string")
    for least, length, batches in ((10, 1, 4), (3, 0, 1), (2, 3, 5)):
        got = drop_frequent_lines(frame, least_docs=least, least_length=length, batches=batches)
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()]
        assert Counter(got) == Counter(plain(rows, least, length))


def test_empty(spark):
    assert drop_frequent_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_merge_by_levels_and_survive(spark):
    path = shared_path(spark, "runs")
    runs = LineRuns(spark, path)
    for i in range(5):
        runs.add(spark.createDataFrame([(1, 1), (10 + i, 2)], "hash long, n_docs long"))
    assert sorted(level for level, _ in runs.runs) == [0, 2]
    again = LineRuns.open(spark, path, 5)
    assert again.runs == runs.runs
    assert {tuple(r) for r in again.counts().collect()} == {(1, 5), *((10 + i, 2) for i in range(5))}
    assert [r.hash for r in again.known(5).collect()] == [1]
    assert LineRuns.open(spark, path, 4).counts().count() == 5


def test_columns_of_any_name_stay(spark):
    rows = [(i, "same\nown " + str(i), i, i, i) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _id long, Line_key long, hashes long")
    kept = drop_frequent_lines(frame)
    assert set(kept.columns) == {*frame.columns, "n_lines", "n_dropped"}
    assert sorted(tuple(r) for r in kept.select(*frame.columns).collect()) == [(i, f"own {i}", i, i, i) for i in range(12)]
