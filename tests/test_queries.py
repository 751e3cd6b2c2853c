"""Every registered query against its SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from oracle.sql import statements
from tidelane.plans.queries import registry
from tidelane.sources.bindings import deal_tables, offer_tables

DATA = Path("/root/testdata/sf0.001")
TABLES = ["nation", "customer", "supplier", "orders", "lineitem"]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_matches_sql(spark, database, name):
    frame = registry()[name](spark, str(DATA))
    expected = database.sql(statements()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(column) for column in columns]
    wanted = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert Counter(tuple(row) for row in frame.select(*columns).collect()) == wanted


def test_every_query_has_sql():
    assert set(registry()) == set(statements())
    assert set(registry()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_line_is_cut_from_the_bindings(spark):
    tables, offers = deal_tables(spark, str(DATA)), offer_tables(spark, str(DATA))
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet")
    assert offers["FTR_OFER"].count() == lines.count()
    carriers = lines.selectExpr("l_orderkey", "l_suppkey % 12").distinct().count()
    assert tables["FTR_DEAL_CRYR"].count() == carriers
    suppliers = spark.read.parquet(f"{DATA}/supplier.parquet")
    ports = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    ports = ports.selectExpr("l_orderkey", "s_nationkey % 5").distinct().count()
    assert tables["FTR_DEAL_RTE"].filter("TRDE_LOC_TP_CD = '03'").count() == ports
