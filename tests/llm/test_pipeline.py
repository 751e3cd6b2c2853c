from pathlib import Path

import llm_brute as brute
import pytest

import corpus_pipeline as pipeline

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    start = {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(DATA))
        assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and {r.doc_id for r in rows} <= start
        docs = spark.createDataFrame(rows, docs.schema)
        if name == "near copies":
            found = brute.components([(r.doc_id, r.text) for r in rows])
            assert all(i == c for i, (_, c) in found.items())
    packed = pipeline.STAGES[-1][1](spark, docs, str(DATA)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
    assert {(r.doc_id, r.piece) for r in pipeline.run(spark, str(DATA)).collect()} == {(r.doc_id, r.piece) for r in packed}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, str(DATA)).collect() == []
