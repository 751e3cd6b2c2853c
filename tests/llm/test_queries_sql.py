"""The registered queries that SQL can express, against it, on a small table."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tidelane.llm.queries import registry, statements

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_matches_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = registry()[name](spark, str(DATA))
    expected = database.sql(statements()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(c) for c in columns]
    wanted = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert Counter(tuple(row) for row in frame.select(*columns).collect()) == wanted
