from decimal import Decimal as D

from pyspark.sql import functions as F

from tests.frames import offer_tables, rows, time
from tidelane.operators import bidask, events, offers
from tidelane.operators.fact import offer_raw
from tidelane.operators.nest import flatten, nest_ranked, ranked

NOW = "202010"
NUMBER = "F" + time("20200101", 7)


def offer(seq=0, number=NUMBER, **more):
    return {"OFER_NR": number, "OFER_CHNG_SEQ": seq, **more}


def line(week, left, seq=0, number=NUMBER, price=10, deal_price=10):
    return {
        "OFER_NR": number, "OFER_CHNG_SEQ": seq, "BSE_YW": week, "OFER_PRCE": price,
        "OFER_QTY": 100, "OFER_REMN_QTY": left, "DEAL_PRCE": deal_price, "DEAL_QTY": 0,
        "DEAL_AMT": 0,
    }


def route(kind, code, seq=0, number=NUMBER, reg=1):
    return {
        "OFER_NR": number, "OFER_CHNG_SEQ": seq, "OFER_REG_SEQ": reg, "TRDE_LOC_CD": code,
        "TRDE_LOC_TP_CD": kind,
    }


def deal(number, on_seq, day, offer_number=NUMBER, n=0):
    return {
        "DEAL_NR": number, "DEAL_DT": time(day, n), "OFER_NR": offer_number,
        "OFER_CHNG_SEQ": on_seq,
    }


def versions(spark, left, week="202012", deals=()):
    """One offer whose versions 0.. leave the quantities ``left`` in one week."""
    return offer_tables(
        spark,
        [offer(seq) for seq in range(len(left))],
        [line(week, quantity, seq) for seq, quantity in enumerate(left)],
        deals=deals,
    )


def test_offer_deltas(spark):
    tables = versions(spark, [100, 70, 50])
    out = offers.week_detail_rows(tables)
    shown = rows(
        out, "offerChangeSeq", "dealQty", "aggDealQty", "aggDealAmt", "aggDealPrice",
        "aggLeftQty", "aggOfferQty", "tradeClosing",
    )
    assert shown == [(2, D(20), D(50), D(500), 10.0, D(50), D(300), "20200321010000000000")]


def test_offer_deltas_over_many_runs(spark, monkeypatch):
    left = [300 - 2 * n for n in range(60)]
    tables = versions(spark, left)
    whole = rows(offers.week_detail_rows(tables))
    monkeypatch.setattr(offers, "VERSIONS_PER_RUN", 7)
    assert rows(offers.week_detail_rows(tables)) == whole
    assert rows(offers.week_detail_rows(tables), "aggDealQty") == [(D(118),)]


def test_placed_week_detail_needs_no_runs(spark, monkeypatch):
    monkeypatch.setattr(offers, "VERSIONS_PER_RUN", 3)
    deals = [deal("D1", 4, "20200105"), deal("D2", 4, "20200106"), deal("D3", 2, "20200107")]
    for amounts in ([100, 90, 90, 70, 60], [100, None, 80], [100], [100, 100], [0]):
        tables = versions(spark, amounts, deals=deals)
        odd = spark.createDataFrame([(None, 0), (None, 1), (None, None)], "OFER_NR string, OFER_CHNG_SEQ long")
        lines = tables["FTR_OFER_LINE_ITEM"]
        extra = odd.join(lines.drop("OFER_NR", "OFER_CHNG_SEQ").limit(1), how="cross").select(lines.columns)
        tables = {**tables, "FTR_OFER_LINE_ITEM": lines.unionByName(extra)}
        assert rows(offers.week_detail_rows(tables, placed=True)) == rows(offers.week_detail_rows(tables))



def test_offer_without_deal_keeps_version_zero_only(spark):
    assert rows(offers.week_detail_rows(versions(spark, [100])), "dealQty", "aggDealPrice") == [
        (D(0), None)
    ]
    assert offers.week_detail_rows(versions(spark, [100, 100])).count() == 0


def test_status(spark):
    def status(weeks, all_yn="0", left=5):
        tables = offer_tables(
            spark, [offer(ALL_YN=all_yn)], [line(week, left) for week in weeks]
        )
        [(value,)] = rows(offers.summary_rows(tables, NOW), "offerStatus")
        return value

    assert status(["202009", "202012"]) == "0"
    assert status(["202009", "202012"], all_yn="1") == "1"
    assert status(["202011", "202012"], all_yn="1") == "0"
    assert status(["202011"], left=0) == "1"
    assert status(["202008", "202009"]) == "1"


def test_summary_refers_to_deal_or_offer(spark):
    tables = versions(spark, [100, 70], deals=[deal("D1", 0, "20200105")])
    assert rows(
        offers.summary_rows(tables, NOW), "eventTimestamp", "referenceEventNumber",
        "offerChangeSeq",
    ) == [(time("20200105"), "D1", 1)]
    assert rows(
        offers.summary_rows(versions(spark, [100]), NOW), "eventTimestamp",
        "referenceEventNumber", "polCount",
    ) == [(NUMBER[1:], NUMBER, 0)]


def test_summary_pages_lose_nothing(spark):
    numbers = ["F" + time(day, n) for day in ("20200101", "20200201") for n in range(20)]
    tables = offer_tables(
        spark, [offer(number=n) for n in numbers], [line("202012", 5, number=n) for n in numbers]
    )
    paged = offers.offer_summary(tables, NOW)
    assert rows(paged, "page") == [(202001,), (202002,)]
    assert rows(flatten(paged, "cell"), "offerNumber") == [(n,) for n in numbers]


def test_latest_version_per_week(spark):
    tables = offer_tables(
        spark,
        [offer(0), offer(1)],
        [line("202011", 9, 0), line("202012", 8, 0), line("202012", 7, 1)],
    )
    assert rows(offers.latest_version(tables), "BSE_YW", "OFER_CHNG_SEQ") == [
        ("202011", 0), ("202012", 1)
    ]


def test_raw(spark):
    tables = offer_tables(
        spark,
        [offer()],
        [line("202012", 5)],
        [route("02", "A"), route("03", "B")],
        [{"OFER_NR": NUMBER, "OFER_CHNG_SEQ": 0, "OFER_CRYR_CD": c} for c in ("C1", "C9")],
    )
    shown = rows(offer_raw(tables), "polName", "podCode", "podName", "carrierCount", "BSE_YW")
    assert shown == [("Alpha", "B", None, 2, "202012")]


def test_week_list_keeps_missing_ports_apart(spark):
    tables = offer_tables(spark, [offer()], [line("202012", 5)], [route("02", "A")])
    assert rows(offers.offer_week_list(tables), "polCode", "podCode", "baseYearWeek") == [
        ("A", "all", ["202012"]),
        ("A", None, ["202012"]),
        ("all", "all", ["202012"]),
        ("all", None, ["202012"]),
    ]


def test_week_list_needs_a_port_of_loading(spark):
    tables = offer_tables(spark, [offer()], [line("202012", 5)], [route("03", "B")])
    assert (None, None, ["202012"]) in rows(
        offers.offer_week_list(tables), "polCode", "podCode", "baseYearWeek"
    )


def test_week_list_uses_last_versions(spark):
    tables = offer_tables(
        spark,
        [offer(0), offer(1)],
        [line("202011", 9, 0), line("202012", 7, 1)],
        [route("02", "A", 0), route("03", "B", 0)],
    )
    whole = offers.offer_week_list(tables).filter("polCode = 'all' AND podCode = 'all'")
    assert rows(whole, "baseYearWeek") == [(["202012"],)]


def test_route_list_pairs_across_versions(spark):
    tables = offer_tables(
        spark,
        [offer(0), offer(1)],
        [],
        [route("02", "A", 0), route("03", "B", 1), route("02", "C", 1, reg=2)],
    )
    [(routes,)] = rows(offers.offer_route_list(tables), "rteList")
    assert [tuple(r) for r in routes] == [("A", "B", "Alpha", None), ("C", None, None, None)]


def codes(tables):
    return {
        code: log
        for code, log in rows(
            events.event_rows(tables, NOW).groupBy("eventCode").agg(F.count("*"))
        )
    }


def test_event_placed_only(spark):
    assert codes(versions(spark, [100])) == {"01": 1}


def test_events_of_an_offer_dealt_out(spark):
    tables = versions(spark, [100, 0], deals=[deal("D1", 1, "20200105")])
    assert codes(tables) == {"01": 1, "02": 1, "04": 1, "05": 1}
    closed = events.event_rows(tables, NOW, "05")
    assert rows(closed, "lastEventTimestamp", "tradeClosing", "eventName") == [
        (time("20200105"), "20200321010000000000", "offerClosed")
    ]


def test_events_of_an_expired_offer(spark):
    assert codes(versions(spark, [100], week="202009")) == {"01": 1, "03": 1, "05": 1}


def test_last_expiry_skips_weeks_the_calendar_lacks(spark):
    tables = offer_tables(spark, [offer()], [line("201901", 5), line("201953", 5)])
    expired = events.event_rows(tables, NOW, "03")
    assert rows(expired, "baseYearWeek", "eventTimestamp", "lastEventTimestamp") == [
        ("201901", "20190105010000000000", "20190105010000000000"),
        ("201953", None, "20190105010000000000"),
    ]


def test_offer_for_all_weeks_closes_by_the_same_rule(spark):
    """The rule that asks all weeks to lie both ahead and behind never applies."""
    tables = offer_tables(
        spark, [offer(ALL_YN="1")], [line("202009", 5), line("202012", 5)]
    )
    assert "05" not in codes(tables)


def test_late_deal_moves_the_closing(spark):
    tables = versions(spark, [0], deals=[deal("D1", 0, "20200501")])
    closed = events.event_rows(tables, NOW, "05")
    assert rows(closed, "tradeClosing") == [(time("20200501"),)]


def test_event_documents(spark):
    tables = versions(spark, [100, 0], deals=[deal("D1", 1, "20200105")])
    documents = events.offer_event_log(tables, NOW)
    [document] = documents.collect()
    assert [cell.eventCode for cell in document.eventCell] == ["01", "02", "04", "05"]
    assert document.eventCell[0].eventLog[0].referenceEventNumber == NUMBER
    paged = events.offer_event_log(tables, NOW, page_versions=1)
    assert rows(paged.select("page", F.size("eventCell"))) == [(0, 1), (1, 3)]
    assert rows(flatten(paged, "eventCell")) == rows(flatten(documents, "eventCell"))


def test_book_shows_the_last_version(spark):
    tables = offer_tables(
        spark,
        [offer(0), offer(1)],
        [line("202011", 9, 0), line("202012", 6, 1, price=4), line("202013", 8, 1, price=5)],
        [route("02", "A", 1), route("02", "C", 1), route("03", "B", 1), route("03", "D", 1),
         route("02", "X", 0)],
    )
    out = bidask.mw_bidask_rows(tables)
    assert rows(out, "polCode", "podCode", "baseYearWeek") == sorted(
        (pol, pod, week) for pol in "AC" for pod in "BD" for week in ("202012", "202013")
    )
    assert set(rows(out, "polCount", "podCount", "avgPrice", "avgQty", "minYearWeek")) == {
        (2, 2, 4.5, 7.0, "202012")
    }
    assert bidask.mw_bidask(tables).count() == 8


def test_restriction_to_users_and_offers(spark):
    other = "F" + time("20200101", 8)
    tables = offer_tables(
        spark,
        [offer(), offer(number=other, EMP_NR="U2")],
        [line("202012", 5), line("202012", 5, number=other)],
    )
    users = spark.createDataFrame([("U2",)], "EMP_NR string")
    picked = offers.summary_rows(offers.restricted(tables, users=users), NOW)
    assert rows(picked, "offerNumber") == [(other,)]
    lists = spark.createDataFrame([(f"{other}|{other}",)], "numbers string")
    numbers = offers.split_numbers(lists, "numbers")
    kept = events.event_rows(offers.restricted(tables, offers=numbers), NOW)
    assert rows(kept, "offerNumber", "offerTypeCode") == [(other, "S")]


def test_pages_by_rank_are_full_and_never_gather_a_group(spark):
    """A hot month of one route: pages of equal size in order, also for missing keys and odd numbers."""
    months = F.expr("case when id % 3 = 0 then '202002' else '202001' end")
    number = F.concat(F.lit("F"), months, F.lpad((F.col("id") * 7919 % 40000).cast("string"), 14, "0"))
    book = spark.range(20000).select(
        F.when(F.col("id") % 10 > 0, "hot").alias("route"),
        F.when(F.col("id") % 1000 == 1, None).when(F.col("id") % 1000 == 2, "X").otherwise(number).alias("number"),
        (F.col("id") % 50).alias("price"),
    )
    documents = nest_ranked(book, ["route"], ["price", "number"], "number", page_rows=100).collect()
    groups = {}
    for row in book.collect():
        groups.setdefault(row.route, []).append((row.number is not None, row.number or "", row.price))
    pages = {(row.route, row.page): row.Cell for row in documents}
    assert max(len(cells) for cells in pages.values()) == 100
    for route, members in groups.items():
        wanted = [(price, name if known else None) for known, name, price in sorted(members)]
        count = -(-len(wanted) // 100)
        shown = [tuple(cell) for page in range(count) for cell in pages.pop((route, page))]
        assert shown == wanted
    assert not pages


def test_ranks_use_no_window_over_a_whole_group(spark):
    rows_of = spark.range(10).select(F.lit("hot").alias("route"), F.concat(F.lit("F2020010100"), "id").alias("number"))
    plan = ranked(rows_of, ["route"], ["number"], "number")._jdf.queryExecution().optimizedPlan().toString()
    windows = [part for part in plan.splitlines() if "Window [" in part and "row_number" in part]
    assert windows and all("__run" in part for part in windows)


def test_owners_are_all_who_entered_a_version(spark):
    tables = versions(spark, [100, 70])
    entered = tables["FTR_OFER"].withColumn("EMP_NR", F.concat(F.lit("U"), "OFER_CHNG_SEQ"))
    numbers = entered.select("OFER_NR").limit(1)
    assert rows(offers.owners(entered, numbers)) == [("U0",), ("U1",)]
    assert rows(offers.owners(entered, numbers.filter("false"))) == []
