import zlib
from pathlib import Path

import numpy as np
import pytest

from tidelane.llm.queries import op10_quality
from tidelane.llm.quality import Network, classify

DATA = Path("/root/testdata/sf0.01")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_held_out_documents_are_told_apart(spark):
    rows = op10_quality(spark, str(DATA)).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.95
    assert np.mean([s >= 0.3 for s in good]) >= 0.97


def test_edges(spark):
    docs = [(None, "a b", 1), (1, None, 1), (2, "", 1), (3, "x " * 50_000, 1), (4, "same", 1), (5, "same", 1), (4, "same", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = classify(frame, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text == "same"}) == 1
    rows = classify(frame, labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.5}
    assert classify(frame.limit(0), labels).collect() == []


def test_temperature_calibrates():
    deal = np.random.default_rng(1)
    x = deal.normal(size=(4000, 6))
    y = (deal.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Network.fit(x[:400], y[:400], epochs=120)
    before = np.mean((net.scores(x[2000:]) - y[2000:]) ** 2)
    net.calibrate(x[400:2000], y[400:2000])
    assert net.temperature > 1 and np.mean((net.scores(x[2000:]) - y[2000:]) ** 2) < before
