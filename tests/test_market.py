from decimal import Decimal as D

from pyspark.sql import Window, functions as F

from tests.frames import deal_tables, rows, time
from tidelane.operators import market
from tidelane.operators.fact import DEAL, stats_raw, stats_raw_carrier_set, trade_fact
from tidelane.operators.nest import flatten

NOW = "202010"
THREE = [
    ("D1", time("20200101", 1), 100, 1),
    ("D2", time("20200101", 2), 120, 2),
    ("D3", time("20200101", 3), 90, 3),
]


def test_weekly_ohlc(spark):
    out = market.mw_sum_rows(trade_fact(deal_tables(spark, THREE, ["C1"])), NOW)
    shown = rows(
        out, "open", "high", "low", "close", "volume", "changeValue", "changeRate", "status"
    )
    assert shown == [(D(100), D(120), D(90), D(90), D(6), D(90), 1.0, "on Market")]


def test_carrier_fan_out(spark):
    for fact in (trade_fact, stats_raw):
        built = fact(deal_tables(spark, THREE, ["C1", "C2"]))
        assert rows(market.mw_sum_rows(built, NOW), "volume") == [(D(12),)]
        once = market.mw_sum_rows(built, NOW, dedup_carriers=True)
        assert rows(once, "volume") == [(D(6),)]


def test_week_on_week(spark):
    deals = [
        {"number": "D1", "time": time("20200101"), "price": 90, "quantity": 1, "week": "202009"},
        {"number": "D2", "time": time("20200102"), "price": 100, "quantity": 1, "week": "202010"},
    ]
    out = market.mw_sum_wow(trade_fact(deal_tables(spark, deals)), NOW)
    assert rows(out, "baseYearWeek", "changeValue", "changeRate", "status") == [
        ("202009", D(90), 1.0, "Trade Closed"),
        ("202010", D(10), 0.1, "on Market"),
    ]


def test_missing_prices_show_as_zero_in_a_shared_week(spark):
    deals = [
        {"number": f"D{n}", "time": time("20200101", n), "price": 1, "quantity": 1, "week": []}
        for n in (1, 2)
    ]
    together = market.mw_sum_rows(trade_fact(deal_tables(spark, deals)), NOW)
    assert rows(together, "open", "close", "high", "changeRate") == [(D(0), D(0), None, None)]
    alone = market.mw_sum_rows(trade_fact(deal_tables(spark, deals[:1])), NOW)
    assert rows(alone, "open", "close", "baseYearWeek") == [(None, None, None)]


def test_history(spark):
    deals = [*THREE, ("D4", time("20200101", 4), 70, 0)]
    out = market.mw_hst_rows(trade_fact(deal_tables(spark, deals, ["C1"])))
    shown = rows(out.withColumn("r", F.round("priceRate", 6)), "idx", "priceChange", "r")
    assert shown == [(1, D(100), 1.0), (2, D(20), 0.166667), (3, D(-30), -0.333333)]


def test_history_zero_price_has_no_rate(spark):
    out = market.mw_hst_rows(trade_fact(deal_tables(spark, [("D1", time("20200101"), 0, 1)])))
    assert rows(out, "priceChange", "priceRate") == [(D(0), None)]


def test_history_repeats_deals_per_carrier_name(spark):
    tables = deal_tables(spark, THREE[:2], ["C1", "C2", "C9"])
    for fact in (trade_fact, stats_raw):
        out = market.mw_hst_rows(fact(tables))
        assert rows(out, "idx", "referenceEventNumber", "priceChange") == [
            (1, "D1", D(100)), (2, "D1", D(0)), (3, "D1", D(0)),
            (4, "D2", D(20)), (5, "D2", D(0)), (6, "D2", D(0)),
        ]


def test_history_over_many_runs_equals_one_window(spark):
    """Runs of a busy group join up to the plain window, missing keys included."""
    deals = [
        {"number": f"D{n:04d}", "time": time(f"202001{n % 28 + 1:02d}", n), "price": n % 17 + 1,
         "quantity": n % 5, "pol": None if n % 3 == 0 else "A", "week": ["202010", "202011"]}
        for n in range(300)
    ]
    fact = trade_fact(deal_tables(spark, deals, ["C1", "C2"]))
    plain = Window.partitionBy(*market.TERMS, "baseYearWeek").orderBy("timestamp", "copy")
    wanted = (
        fact.filter("dealQty <> 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("carrierNames"))))
        .withColumnsRenamed({"DEAL_DT": "timestamp", "DEAL_NR": "referenceEventNumber"})
        .withColumn("idx", F.row_number().over(plain).cast("long"))
        .withColumn("priceChange", F.col("dealPrice") - F.lag("dealPrice", 1, 0).over(plain))
    )
    columns = ["polCode", "baseYearWeek", "referenceEventNumber", "idx", "priceChange"]
    for digits in (4, 8, 20):
        assert rows(market.mw_hst_rows(fact, run_digits=digits), *columns) == rows(wanted, *columns)


def test_history_pages(spark):
    fact = trade_fact(deal_tables(spark, THREE))
    whole, paged = market.mw_hst(fact), market.mw_hst(fact, page_rows=2)
    assert rows(whole.select("page", F.size("Cell"))) == [(0, 3)]
    assert rows(paged.select("page", F.size("Cell"))) == [(0, 2), (1, 1)]
    assert rows(flatten(paged)) == rows(flatten(whole))


def test_resampling(spark):
    days = ("20200105", "20200106", "20200201")
    deals = [(f"D{n}", time(day), 10 + n, 1) for n, day in enumerate(days)]
    out = market.mw_wkdetail_rows(trade_fact(deal_tables(spark, deals)))
    labels = {}
    for interval, label in rows(out, "interval", "xAxis"):
        labels.setdefault(interval, []).append(label)
    assert labels == {
        "daily": ["20200105", "20200106", "20200201"],
        "weekly": ["20201", "20202", "20205"],
        "monthly": ["202001", "202002"],
    }
    monthly = out.filter("interval = 'monthly'")
    assert rows(monthly, "xAxis", "open", "close", "volume", "changeValue") == [
        ("202001", D(10), D(11), D(2), D(11)),
        ("202002", D(12), D(12), D(1), D(1)),
    ]


def test_documents_flatten_to_their_rows(spark):
    fact = trade_fact(deal_tables(spark, THREE, ["C1"]))
    for nested, flat in (
        (market.mw_sum(fact, NOW), market.mw_sum_rows(fact, NOW)),
        (market.mw_wkdetail(fact), market.mw_wkdetail_rows(fact)),
    ):
        assert rows(flatten(nested), *flat.columns) == rows(flat)
    assert market.mw_sum(fact, NOW).columns == [*market.ROUTE_KEYS, "Cell"]


def test_only_selling_deals(spark):
    deals = [{"number": "D1", "time": time("20200101"), "price": 1, "quantity": 1, "type": "B"}]
    assert stats_raw(deal_tables(spark, deals)).count() == 0


def test_route_fan_out_and_gaps(spark):
    tables = deal_tables(
        spark, [{"number": "D1", "time": time("20200101"), "price": 1, "quantity": 1, "pod": None}]
    )
    assert rows(stats_raw(tables), "polCode", "podCode") == [("A", None)]
    twice = {**tables, "FTR_DEAL_RTE": tables["FTR_DEAL_RTE"].unionAll(tables["FTR_DEAL_RTE"])}
    assert stats_raw(twice).count() == 2


def test_carrier_master_argument(spark):
    tables = deal_tables(spark, THREE[:1], ["C1"])
    del tables["MDM_CRYR"]
    master = spark.createDataFrame([("C1", "Given")], "carrierCode string, carrierName string")
    assert rows(stats_raw(tables, master), "carrierName") == [("Given",)]


def test_carrier_set(spark):
    tables = deal_tables(spark, THREE[:1], ["C2", "C1", "C9"])
    folded = stats_raw_carrier_set(tables)
    [(items,)] = rows(folded, "carrierItem")
    assert [tuple(i) for i in items] == [("C1", "One"), ("C2", "Two"), ("C9", None)]
    without = {**tables, "FTR_DEAL_CRYR": tables["FTR_DEAL_CRYR"].limit(0)}
    deals = tables["FTR_DEAL"].select(*DEAL)
    assert rows(stats_raw_carrier_set(without, deals), "carrierItem") == [(None,)]
    assert stats_raw_carrier_set(tables, deals.limit(0)).schema == folded.schema
    assert stats_raw_carrier_set(tables, deals.limit(0)).count() == 0


def test_history_documents_repeat_deals_only_within_their_arrays(spark):
    # Entries of a deal go on over pages; the look-back sees the deal before, then the deal itself.
    fact = trade_fact(deal_tables(spark, THREE, ["C1", "C2", "C3"]))
    documents = market.mw_hst(fact, page_rows=2)
    shown = ["idx", "timestamp", "dealPrice", "priceChange", "priceRate"]
    assert rows(flatten(documents), *shown) == rows(market.mw_hst_rows(fact), *shown)
    assert [len(cell) for (cell,) in documents.orderBy("page").select("Cell").collect()] == [2, 2, 2, 2, 1]
    # What is collected is a row per deal and page, not one per entry.
    plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (market.mw_hst_rows(fact), documents)]
    assert ["explode(sequence(1, carrierNames" in plan for plan in plans] == [True, False]
