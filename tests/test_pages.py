"""Pages by rank make their rows once, and carriers of a version are read off its offer's lines."""

import datetime

import pytest
from pyspark.sql import Window, functions as F

from tests.frames import rows
from tidelane.operators.nest import nest_ranked, ranked
from tidelane.plans.queries import registry
from tidelane.sources.bindings import offer_tables

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["mw_bidask_pages", "offer_summary_pages"])
def test_counts_and_pages_read_rows_made_once(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    frame = registry()[name](spark, DATA)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    made = [line for line in plan.splitlines() if "Exchange hashpartitioning(__offer" in line and "REPARTITION" in line]
    assert len([line for line in made if "Reused" not in line]) == 1
    assert len([line for line in made if "Reused" in line]) == 2


def test_ranks_of_rows_without_a_number(spark):
    cells = spark.createDataFrame(
        [("k", None, 2), ("k", None, 1), (None, None, 3), ("k", "F2020010100000001", 1), (None, "F20200101000000012", 1), ("k", "F20200201", 5)],
        "key string, number string, cell int",
    )
    wanted = cells.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("number", "cell")) - 1)
    assert rows(ranked(cells, ["key"], ["number", "cell"], "number")) == rows(wanted)
    pages = nest_ranked(cells, ["key"], ["number", "cell"], "number", 2)
    assert pages.agg(F.sum(F.size("Cell"))).first()[0] == cells.count()


def test_versions_are_read_off_their_lines(spark, tmp_path):
    """What versions dealt and carried, also where quantities or suppliers are missing, against running windows."""
    day = datetime.datetime(1998, 2, 6)
    given = [
        (1, [(1, 5.0, 3), (2, 4.0, 15), (3, None, 4), (4, 70.0, None)]),
        (2, [(1, None, 2), (2, 3.0, 2)]),
        (3, [(1, None, None), (2, None, 1), (3, 60.0, 13), (4, 60.0, 7)]),
    ]
    frames = {
        "orders": spark.createDataFrame(
            [(key, 1, "O", 100.0, day) for key, _ in given],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
        ),
        "lineitem": spark.createDataFrame(
            [(key, 1, supplier, number, quantity) for key, lines in given for number, quantity, supplier in lines],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
        ),
        "customer": spark.createDataFrame([(1, 2)], "c_custkey long, c_nationkey int"),
        "supplier": spark.createDataFrame([(n, f"S{n}", n) for n in range(16)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": spark.createDataFrame([(n, f"N{n}") for n in range(25)], "n_nationkey int, n_name string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    tables = offer_tables(spark, str(tmp_path))
    running = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    versions = frames["lineitem"].select(
        F.format_string("F19980206%012d", "l_orderkey").alias("OFER_NR"),
        (F.col("l_linenumber") - 1).cast("long").alias("OFER_CHNG_SEQ"),
        F.greatest(100 - (F.sum(quantity).over(running) - F.first(quantity).over(running)), F.lit(0)).cast("decimal(18,2)").alias("left"),
        F.collect_set(F.concat(F.lit("C"), (F.col("l_suppkey") % 12).cast("string"))).over(running).alias("carriers"),
    )
    lines = tables["FTR_OFER_LINE_ITEM"].select("OFER_NR", "OFER_CHNG_SEQ", "OFER_REMN_QTY").distinct()
    assert rows(lines) == rows(versions.select("OFER_NR", "OFER_CHNG_SEQ", "left"))
    carriers = versions.select("OFER_NR", "OFER_CHNG_SEQ", F.explode("carriers"))
    assert rows(tables["FTR_OFER_CRYR"].select("OFER_NR", "OFER_CHNG_SEQ", "OFER_CRYR_CD")) == rows(carriers)
    assert "Window" not in tables["FTR_OFER_CRYR"]._jdf.queryExecution().executedPlan().toString()
