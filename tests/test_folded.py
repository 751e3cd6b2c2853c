"""Folded facts: deals that move before their routes and weeks unfold."""

import re

import pytest
from pyspark.sql import functions as F

from tests.frames import deal_tables, rows, table, time
from tidelane.operators import changes, market
from tidelane.operators.fact import trade_fact, unfolded
from tidelane.plans.queries import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark):
    """Deals with several registrations, lines without week or quantity, and deals without lines or routes."""
    deals = [
        *[{"number": f"D{n}", "time": time(f"2020010{n % 3 + 1}", n), "price": n * 7 % 5, "quantity": n % 4, "week": ["202010", "202011"]}
          for n in range(1, 9)],
        {"number": "D9", "time": time("20200101", 9), "price": 3, "quantity": 2, "week": [None, "202010", "202010"]},
        {"number": "E1", "time": time("20200102", 1), "price": 3, "quantity": 2, "week": []},
        {"number": "E2", "time": None, "price": 4, "quantity": 2},
        {"number": "E3", "time": time("20200103", 2), "price": 4, "quantity": 0, "week": "202012", "pod": None},
        {"number": "E4", "time": time("20200103", 3), "price": 6, "quantity": 1, "pol": None, "pod": None},
    ]
    found = deal_tables(spark, deals, ["C1", "C2"])
    located = [
        ("D1", 2, "A", "02"), ("D1", 2, "C", "03"), ("D1", 2, "B", "03"), ("D2", 2, "B", "02"), ("D2", 2, None, "03"),
        ("D3", None, "A", "02"), ("D4", 2, "A", "02"), ("D5", 2, "C", "03"), ("D6", 1, None, "02"), ("D6", 1, "A", "09"),
    ]
    more = [{"ID": 20, "DEAL_NR": nr, "OFFER_REG_SEQ": reg, "TRDE_LOC_CD": code, "TRDE_LOC_TP_CD": kind} for nr, reg, code, kind in located]
    twice = [{"ID": 30, "DEAL_NR": "D2", "DEAL_DT": time("20200103", 2)}, {"ID": 31, "DEAL_NR": "D4", "DEAL_DT": time("20200102", 4)}]
    return {
        **found,
        "FTR_DEAL_RTE": found["FTR_DEAL_RTE"].unionByName(table(spark, "FTR_DEAL_RTE", more)),
        "FTR_DEAL": found["FTR_DEAL"].unionByName(table(spark, "FTR_DEAL", twice)),
    }


def flagged(spark, tables, folded):
    marks = spark.createDataFrame([(name, 11 if name == "FTR_DEAL" else 19) for name in changes.WATCHED], "tableName string, maxId long")
    return changes.fact_with_changes(tables, marks, folded=folded)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    return rows(left, *left.columns) == rows(right, *left.columns)


def test_folded_facts_unfold_to_the_fact(spark, tables):
    assert same(unfolded(trade_fact(tables, folded=True)), trade_fact(tables))
    assert same(unfolded(flagged(spark, tables, True)), flagged(spark, tables, False))


def test_histories_of_folded_facts(spark, tables):
    folded, flat = trade_fact(tables, folded=True), trade_fact(tables)
    for once in (False, True):
        assert same(market.mw_hst_rows(folded, once), market.mw_hst_rows(flat, once))
    assert same(market.mw_hst(folded, page_rows=3), market.mw_hst(flat, page_rows=3))
    changed = [flagged(spark, tables, kind) for kind in (True, False)]
    touched = [market.mw_hst_rows(fact, only_touched=True) for fact in changed]
    assert 0 < touched[1].count() < market.mw_hst_rows(flat).count()
    assert same(*touched)


def test_day_states_of_folded_facts(spark, tables):
    days = market.placed_days(flagged(spark, tables, True))
    wanted = market.day_states(trade_fact(tables))
    assert same(market.day_states(days), wanted)
    parts = [market.day_states(days.filter(condition)) for condition in (F.col("deal.changed"), ~F.col("deal.changed"))]
    assert same(market.merged_states(parts[0].unionByName(parts[1])), wanted)


@pytest.mark.parametrize("name", ["mw_hst_incr", "mw_hst_flat", "mw_hst_cells", "mw_wkdetail_merged"])
def test_deals_move_once_before_they_unfold(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    frame = registry()[name](spark, DATA)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "Reused" not in line]
    # Deals, whole, to their port and time; the last rows of runs follow them there.
    assert len([line for line in moved if "hashpartitioning(__place" in line and "REPARTITION_BY_NUM" in line]) == 1
    # Lines of all tables by one shuffle, which marks may read first, and no row of a route and week but the last of its run.
    collected = re.findall(r"Exchange hashpartitioning\(DEAL_NR#\d+, \d+\).*\n.*partial_collect_list\(line", plan)
    assert len(collected) <= 1
    assert not [line for line in moved if "__run" in line or "referenceEventNumber" in line]
