"""Properties of the physical plans that matter at scale."""

import pytest

from tests.frames import deal_tables, offer_tables, time
from tidelane.operators import market, offers
from tidelane.operators.fact import trade_fact
from tidelane.plans.queries import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def without_broadcast(spark):
    """Plans as they come out when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def executed(frame):
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_history_shuffles_its_rows_once(spark, without_broadcast):
    deals = [(f"D{n}", time("20200101", n), 1, 1) for n in range(4)]
    plan = executed(market.mw_hst_rows(trade_fact(deal_tables(spark, deals, ["C1"]))))
    runs = [line for line in plan.splitlines() if "Exchange hashpartitioning(__run" in line]
    assert len([line for line in runs if "ReusedExchange" in line]) == 1
    assert len([line for line in runs if "REPARTITION" in line and "Reused" not in line]) == 1


def test_weekly_ohlc_neither_sorts_nor_windows(spark, without_broadcast):
    deals = [("D1", time("20200101"), 1, 1)]
    plan = executed(market.mw_sum_rows(trade_fact(deal_tables(spark, deals)), "202010"))
    assert "SortAggregate" not in plan and "Window" not in plan


def test_latest_version_is_cut_before_the_shuffle(spark, without_broadcast):
    number = "F" + time("20200101")
    tables = offer_tables(
        spark, [{"OFER_NR": number}], [{"OFER_NR": number, "BSE_YW": "202010"}]
    )
    plan = offers.latest_version(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_query_pairs_rows_without_keys(spark, name):
    plan = registry()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = registry()["cdc_max_id"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders" in line]
    assert scans and all("o_totalprice" not in line for line in scans)


@pytest.mark.parametrize("name", ["offer_summary", "offer_raw", "offer_event_log", "offer_event_04"])
def test_tables_placed_by_offer_are_joined_where_they_lie(spark, without_broadcast, name):
    plan = registry()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert [line for line in moved if "hashpartitioning(OFER_NR#" in line]
    assert not [line for line in moved if "OFER_CHNG_SEQ" in line or "offerNumber" in line]


@pytest.mark.parametrize("name", ["offer_summary_pages", "mw_bidask_pages"])
def test_pages_by_rank_move_whole_rows_once(spark, without_broadcast, name):
    plan = registry()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # To their pages; what else moves are counts, by month and minute or back to the numbers.
    assert len([line for line in moved if "page#" in line]) == 1
    assert not [line for line in moved if "__run" in line]


@pytest.mark.parametrize(
    "name", ["offer_event_log_refresh", "offer_week_detail_refresh", "offer_latest_version", "offer_summary_cells"]
)
def test_offers_are_placed_once_whatever_is_read_of_them(spark, without_broadcast, name):
    plan = executed(registry()[name](spark, DATA))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "Reused" not in line]
    assert len([line for line in moved if "hashpartitioning(OFER_NR#" in line]) == 1
    assert not [line for line in moved if "offerNumber" in line or "OFER_CHNG_SEQ" in line or "struct" in line]
