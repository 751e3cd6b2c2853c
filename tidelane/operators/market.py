"""Market-watch jobs: weekly OHLC, deal history, and OHLC per day, week and month.

Each job comes as flat rows (``*_rows``) and as nested documents.  The input is
either ``fact.trade_fact`` (carriers folded into counts) or ``fact.stats_raw``.
Histories and day states also take a folded fact, whose deals move before their
routes and weeks unfold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.functions.calendar import chart_week, day_of
from tidelane.functions.stamps import moment_time, stamp, stamp_moment, stamp_price
from tidelane.functions.values import TOTAL, null_safe_join, ratio
from tidelane.operators.blocks import PLACE, look_back
from tidelane.operators.nest import PAGE_ROWS, nest

DEAL_KEYS = ["DEAL_NR", "DEAL_CHNG_SEQ"]
TERMS = ["marketTypeCode", "rdTermCode", "paymentTermCode", "polCode", "podCode"]
ROUTE_KEYS = [
    "marketTypeCode", "rdTermCode", "containerTypeCode", "paymentTermCode", "polCode", "podCode",
    "qtyUnit",
]
WEEK_KEYS = [*ROUTE_KEYS, "baseYearWeek"]
SUM_CELL = [
    "baseYearWeek", "status", "open", "low", "high", "close", "volume", "changeValue",
    "changeRate", "latestEventDate",
]
HISTORY_CELL = [
    "idx", "timestamp", "referenceEventNumber", "referenceEventChangeNumber", "dealQty",
    "dealPrice", "dealAmt", "priceChange", "priceRate",
]
DETAIL_CELL = [
    "xAxis", "intervalTimestamp", "open", "low", "high", "close", "volume", "changeValue",
    "changeRate",
]

# Digits of a 20-digit time down to the minute, and to the day.
RUN_DIGITS = 12
DAY_DIGITS = 8
TOUCHED_WEEK = ["polCode", "podCode", "baseYearWeek"]
STATE = ["first", "last", "high", "low", "volume", "repeats"]

# The one container type and quantity unit of the market watch,
# and the two states of a week.
CONTAINER = "01"
UNIT = "T"
ON_MARKET = "on Market"
CLOSED = "Trade Closed"


def mw_sum_rows(
    fact: DataFrame, current_week: str, dedup_carriers: bool = False, only_touched: bool = False
) -> DataFrame:
    """Weekly OHLC, volume and latest deal per route; changes are against zero.

    ``changeValue`` equals ``close`` and ``changeRate`` is one: every week is
    its own partition of the look-back.  ``mw_sum_wow`` compares with the week
    before.  ``only_touched`` keeps the routes with a row that ``changed``
    (see ``fact.flagged_fact``), which the aggregate finds on its way.
    """
    return _weekly(fact, current_week, dedup_carriers, only_touched).select(
        *WEEK_KEYS, "status", "open", "low", "high", "close", "volume",
        F.col("close").alias("changeValue"),
        ratio(F.col("close"), F.col("close")).alias("changeRate"),
        "latestEventDate",
    )


def mw_sum_wow(fact: DataFrame, current_week: str, dedup_carriers: bool = False) -> DataFrame:
    """``mw_sum_rows`` with changes against the previous week of the same route."""
    weeks = Window.partitionBy(*TERMS).orderBy("baseYearWeek")
    weekly = _weekly(fact, current_week, dedup_carriers)
    return with_change(weekly, weeks, "close").select(*WEEK_KEYS, *SUM_CELL[1:])


def mw_sum(
    fact: DataFrame, current_week: str, dedup_carriers: bool = False, only_touched: bool = False
) -> DataFrame:
    """Documents of ``mw_sum_rows``: one per route, a cell per week."""
    return nest(mw_sum_rows(fact, current_week, dedup_carriers, only_touched), ROUTE_KEYS, SUM_CELL)


def mw_hst_rows(
    fact: DataFrame, dedup_carriers: bool = False, run_digits: int = RUN_DIGITS, only_touched: bool = False
) -> DataFrame:
    """Deals of a route and week in time order, each with its price change.

    A deal shows once per distinct carrier name.  The look-back runs before
    that repetition: within the copies of a deal the price does not change.
    However busy a route and week, one task sees no more of it than the deals
    that share the first ``run_digits`` digits of their time.  Of a folded fact
    these are the deals of one port of loading, with all its routes and weeks.

    ``only_touched`` keeps the routes and weeks with a row that ``changed``:
    both the deals and the count of changes per week read one shuffle.
    """
    traced = _traced_deals(fact, dedup_carriers, run_digits, only_touched)
    copies = traced.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("carrierNames"))))
    lagged = F.when(F.col("copy") > 1, F.col("dealPrice")).otherwise(F.col("previous"))
    return (
        market_keys(copies)
        .withColumn("idx", F.col("before") + F.col("copy"))
        .withColumn("priceChange", F.col("dealPrice") - lagged)
        .withColumn("priceRate", ratio(F.col("priceChange"), F.col("dealPrice")))
        .select(*WEEK_KEYS, *HISTORY_CELL)
    )


def _traced_deals(fact: DataFrame, dedup_carriers: bool, run_digits: int, only_touched: bool) -> DataFrame:
    """Deals with the price ``previous`` to theirs, the entries ``before`` and their own number of entries."""
    if "lines" in fact.columns:
        return _traced_placed(fact, dedup_carriers, run_digits, only_touched)
    flag = ["changed"] if only_touched else []
    deals = (
        weighted(fact, dedup_carriers)
        .filter(_traded() | F.col("changed") if only_touched else _traded())
        .select(
            *flag,
            *TERMS,
            "baseYearWeek",
            F.col("DEAL_DT").alias("timestamp"),
            F.col("DEAL_NR").alias("referenceEventNumber"),
            F.col("DEAL_CHNG_SEQ").alias("referenceEventChangeNumber"),
            "dealQty",
            "dealPrice",
            "dealAmt",
            "carrierName",
            "carrierNames",
            *(["offerTypeCode"] if only_touched else []),
        )
        .distinct()
    )
    if only_touched:
        # Counted, not just looked for, so that both sides keep the same distinct rows.
        weeks = deals.groupBy(*TOUCHED_WEEK).agg(F.count_if("changed").alias("n")).filter("n > 0")
        deals = null_safe_join(deals.filter(_traded()), weeks.drop("n"), TOUCHED_WEEK, "left_semi").drop("changed", "offerTypeCode")
    return look_back(
        deals,
        keys=[*TERMS, "baseYearWeek"],
        block=F.substring("timestamp", 1, run_digits),
        order=[
            "timestamp", "referenceEventNumber", "referenceEventChangeNumber", "dealPrice",
            "dealQty", "dealAmt", "carrierName",
        ],
        value="dealPrice",
        weight="carrierNames",
        default=F.lit(0),
    )


def _traded() -> Column:
    return (F.col("dealQty") != 0) & (F.col("offerTypeCode") == "S")


def _traced_placed(folded: DataFrame, dedup_carriers: bool, run_digits: int, only_touched: bool) -> DataFrame:
    """``_traced_deals`` of a folded fact: a deal moves once, and unfolds where its runs lie."""
    traded = F.filter("lines", lambda line: (line.dealQty != 0) & (F.col("offerTypeCode") == "S"))
    deals = (
        weighted(folded, dedup_carriers)
        .select(
            *DEAL_KEYS, "DEAL_DT", *TERMS[:3], "offerTypeCode", "carrierNames", *(["changed"] if only_touched else []),
            # Distinct routes and lines of distinct deals are distinct rows.
            F.array_distinct("routes").alias("routes"),
            F.array_distinct(F.when(F.col("changed"), F.col("lines")).otherwise(traded) if only_touched else traded).alias("lines"),
        )
        .filter(F.size("lines") > 0)
        .distinct()
    )
    placed = _placed(deals, run_digits)
    weeks = None
    if only_touched:
        weeks = _unfolded(placed.filter("deal.changed")).select(*TOUCHED_WEEK).distinct()
    rows = _unfolded(placed).filter(_traded()).select(
        PLACE,
        "podCode",
        "baseYearWeek",
        F.col("DEAL_DT").alias("timestamp"),
        F.col("DEAL_NR").alias("referenceEventNumber"),
        F.col("DEAL_CHNG_SEQ").alias("referenceEventChangeNumber"),
        "dealQty",
        "dealPrice",
        "dealAmt",
        "carrierNames",
    )
    return look_back(
        rows,
        keys=[*TERMS, "baseYearWeek"],
        block=F.substring("timestamp", 1, run_digits),
        order=["timestamp", "referenceEventNumber", "referenceEventChangeNumber", "dealPrice", "dealQty", "dealAmt"],
        value="dealPrice",
        weight="carrierNames",
        default=F.lit(0),
        kept=weeks,
    )


def _placed(deals: DataFrame, time_digits: int) -> DataFrame:
    """Rows of a folded fact, one per port of loading with its ports of discharge as ``pods``, in ``deal``.

    They lie by terms, port of loading and the first ``time_digits`` digits of the time: ``__place``.
    """
    pols = F.array_distinct(F.transform("routes", lambda route: F.struct(route.polCode.alias("code"))))
    located = deals.withColumn("pol", F.explode(pols))
    own = F.filter("routes", lambda route: route.polCode.eqNullSafe(F.col("pol.code")))
    place = F.struct(*TERMS[:3], F.col("pol.code").alias("polCode"), F.substring("DEAL_DT", 1, time_digits).alias("block"))
    kept = [name for name in deals.columns if name not in (*TERMS[:3], "routes")]
    # As many parts as any shuffle has, however few bytes come: rows unfold to many times their size behind it.
    parts = int(deals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moved = located.select(place.alias(PLACE), *kept, F.transform(own, lambda route: route.podCode).alias("pods")).repartition(parts, PLACE)
    # Its number keeps a deal whole: filters and columns stay behind the shuffle, which is then the same for all.
    return moved.select(PLACE, F.struct(*kept, "pods", F.monotonically_increasing_id().alias("number")).alias("deal"))


def _unfolded(placed: DataFrame) -> DataFrame:
    """A row per route and week line of placed deals."""
    lined = placed.select(PLACE, "deal.*", F.explode("deal.lines").alias("line")).drop("lines", "number")
    routed = lined.withColumn("podCode", F.explode("pods")).drop("pods")
    return routed.select("*", *[F.col(f"{PLACE}.{name}").alias(name) for name in TERMS[:4]], "line.*").drop("line")


def mw_hst(
    fact: DataFrame, dedup_carriers: bool = False, page_rows: int = PAGE_ROWS, only_touched: bool = False
) -> DataFrame:
    """Documents of ``mw_hst_rows``: one per route and week, a cell per deal.

    The history of a busy week continues on further pages of ``page_rows``
    deals, numbered by ``page``.
    """
    traced = _traced_deals(fact, dedup_carriers, RUN_DIGITS, only_touched)
    # A deal moves once per page it shows on, and is repeated only in the array it shows in.
    first, last = (F.floor(entry / page_rows).cast("int") for entry in (F.col("before"), F.col("before") + F.col("carrierNames") - 1))
    paged = traced.withColumn("page", F.explode(F.sequence(first, last)))
    opening, closing = F.col("page") * F.lit(page_rows).cast("long"), (F.col("page") + 1) * F.lit(page_rows).cast("long")
    shown = F.struct(
        (F.greatest("before", opening) + 1).alias("from"),
        F.least(F.col("before") + F.col("carrierNames"), closing).alias("to"),
        F.when(F.col("before") >= opening, F.col("previous")).otherwise(F.col("dealPrice")).alias("previous"),
        *HISTORY_CELL[1:-2],
    )
    folded = paged.groupBy(*TERMS, "baseYearWeek", "page").agg(F.sort_array(F.collect_list(shown)).alias("shown"))

    def repeated(deal: Column) -> Column:
        def entry(idx: Column) -> Column:
            change = deal.dealPrice - F.when(idx > deal["from"], deal.dealPrice).otherwise(deal.previous)
            fields = [deal[name].alias(name) for name in HISTORY_CELL[1:-2]]
            return F.struct(
                idx.alias("idx"), *fields, change.alias("priceChange"), ratio(change, deal.dealPrice).alias("priceRate")
            )

        return F.transform(F.sequence(deal["from"], deal["to"]), entry)

    documents = folded.withColumn("Cell", F.flatten(F.transform("shown", repeated)))
    return market_keys(documents).select(*WEEK_KEYS, "page", "Cell")


def mw_wkdetail_rows(fact: DataFrame, dedup_carriers: bool = False, only_touched: bool = False) -> DataFrame:
    """OHLC of a route and week resampled to days, weeks and months of the deal time.

    Deals collapse to days first; only those day rows are then repeated for
    the coarser intervals.  ``only_touched`` keeps the routes and weeks with a
    row that ``changed``.
    """
    days = day_states(fact, dedup_carriers, only_touched)
    return wkdetail_of_states(_touched(days, TOUCHED_WEEK) if only_touched else days)


def day_states(fact: DataFrame, dedup_carriers: bool = False, flagged: bool = False) -> DataFrame:
    """State of each route, week and day: first and last deal, high, low, volume and repeats.

    States of disjoint sets of rows merge (``merged_states``), so they can be
    stored and deals that come late be added without the others.  Deals of
    ``placed_days`` lie by day, and their states are made there.
    """
    if PLACE in fact.columns:
        states = _unfolded(fact).groupBy(PLACE, "podCode", "baseYearWeek").agg(*_first_and_last(), *_spread())
        terms = [F.col(f"{PLACE}.{name}") for name in TERMS[:4]]
        return states.select(*terms, "podCode", "baseYearWeek", F.col(f"{PLACE}.block").alias("day"), *STATE)
    # A row without a price opens no day, but its change counts.
    traded = F.col("dealPrice") != 0
    day = F.substring("DEAL_DT", 1, 8)
    rows = weighted(fact, dedup_carriers).filter(traded | F.col("changed") if flagged else traded)
    if flagged:
        rows = rows.withColumn("dealPrice", F.when(traded, F.col("dealPrice")))
        seen = F.when(F.col("dealPrice").isNotNull(), F.col("carrierRows"))
        deal = F.when(F.col("dealPrice").isNotNull(), stamp(F.col("DEAL_DT"), F.col("dealPrice")))
        aggregates = [
            F.min(deal).alias("first"), F.max(deal).alias("last"), F.max("dealPrice").alias("high"), F.min("dealPrice").alias("low"),
            F.sum(F.col("dealQty") * seen).alias("volume"), F.sum(seen).alias("repeats"), F.max("changed").alias("changed"),
        ]
    else:
        aggregates = [*_first_and_last(), *_spread()]
    return rows.groupBy(*TERMS, "baseYearWeek", day.alias("day")).agg(*aggregates)


def placed_days(folded: DataFrame, dedup_carriers: bool = False) -> DataFrame:
    """Deals of a folded fact for ``day_states``: with a price, placed by terms, port of loading and day.

    A deal moves once, in ``deal``, however many routes and weeks it has. A task sees no more than the
    deals of one port and day.
    """
    priced = F.filter("lines", lambda line: line.dealPrice != 0)
    deals = weighted(folded, dedup_carriers).withColumn("lines", priced).filter(F.size("lines") > 0)
    return _placed(deals.drop("carrierName", "carrierNames", "offerTypeCode"), DAY_DIGITS)


def merged_states(states: DataFrame) -> DataFrame:
    """One state per route, week and day from several, of disjoint rows, in any order."""
    return states.groupBy(*TERMS, "baseYearWeek", "day").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"), F.sum("repeats").alias("repeats"),
    )


def _touched(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the keys with a row that changed; nulls are a key of their own."""
    marked = rows.withColumn("touched", F.max("changed").over(Window.partitionBy(*keys)))
    return marked.filter("touched").drop("touched", "changed")


def wkdetail_of_states(states: DataFrame) -> DataFrame:
    """``mw_wkdetail_rows`` of day states."""
    days = states.filter(F.col("repeats").isNotNull()).select(
        *TERMS, "baseYearWeek", "day", "high", "low", "volume", "repeats",
        *[price.alias(name) for name, price in _ends().items()],
        stamp_moment(F.col("last")).alias("moment"),
    )
    buckets = F.array(
        F.struct(F.lit("daily").alias("interval"), F.col("day").alias("xAxis")),
        F.struct(F.lit("weekly").alias("interval"), chart_week(day_of(F.col("day"))).alias("xAxis")),
        F.struct(F.lit("monthly").alias("interval"), F.substring("day", 1, 6).alias("xAxis")),
    )
    bucketed = (
        days.withColumn("bucket", F.explode(buckets))
        .select("*", "bucket.*")
        .groupBy(*TERMS, "baseYearWeek", "interval", "xAxis")
        .agg(
            # Days of a bucket have different moments, so these have no ties.
            F.min_by("open", "moment").alias("open"),
            F.max_by("close", "moment").alias("close"),
            F.max("moment").alias("moment"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            F.sum("repeats").alias("repeats"),
        )
    )
    # A bucket of several rows shows no negative open or close.
    several = F.col("repeats") > 1
    ends = {
        name: F.when(several, F.greatest(F.col(name), F.lit(0))).otherwise(F.col(name))
        for name in ("open", "close")
    }
    along = Window.partitionBy(*TERMS, "baseYearWeek", "interval").orderBy("moment")
    priced = bucketed.withColumns({**ends, "intervalTimestamp": moment_time(F.col("moment"))})
    return market_keys(with_change(priced, along, "close")).select(
        *WEEK_KEYS, "interval", "xAxis", "intervalTimestamp", "open", "low", "high", "close",
        F.col("volume").cast(TOTAL).alias("volume"), "changeValue", "changeRate",
    )


def mw_wkdetail(fact: DataFrame, dedup_carriers: bool = False, only_touched: bool = False) -> DataFrame:
    """Documents of ``mw_wkdetail_rows``: one per route, week and interval."""
    return nest(mw_wkdetail_rows(fact, dedup_carriers, only_touched), [*WEEK_KEYS, "interval"], DETAIL_CELL)


def weighted(fact: DataFrame, dedup_carriers: bool) -> DataFrame:
    """Bring a fact to the columns ``carrierRows``, ``carrierNames`` and ``carrierName``."""
    once = {"carrierRows": F.lit(1), "carrierNames": F.lit(1)}
    if "carrierRows" in fact.columns:
        counted = fact.withColumns(once) if dedup_carriers else fact
        return counted.withColumn("carrierName", F.lit(None).cast("string"))
    if dedup_carriers:
        bare = fact.drop("carrierCode", "carrierName").distinct()
        return bare.withColumns({**once, "carrierName": F.lit(None).cast("string")})
    return fact.drop("carrierCode").withColumns(once)


def market_keys(rows: DataFrame) -> DataFrame:
    """Add the constant key columns, after aggregation so that they cost no grouping."""
    return rows.withColumns({"containerTypeCode": F.lit(CONTAINER), "qtyUnit": F.lit(UNIT)})


def with_change(rows: DataFrame, along: Window, price: str) -> DataFrame:
    """Difference to the previous ``price`` and its share of the current one."""
    lagged = F.lag(price, 1, 0).over(along)
    return rows.withColumn("changeValue", F.col(price) - lagged).withColumn(
        "changeRate", ratio(F.col("changeValue"), F.col(price))
    )


def _weekly(fact: DataFrame, current_week: str, dedup_carriers: bool, only_touched: bool = False) -> DataFrame:
    status = F.when(F.col("baseYearWeek") >= current_week, ON_MARKET).otherwise(CLOSED)
    weekly = (
        weighted(fact, dedup_carriers)
        .filter(F.col("offerTypeCode") == "S")
        .groupBy(*TERMS, "baseYearWeek")
        .agg(*_first_and_last(), *_spread(), *([F.max("changed").alias("changed")] if only_touched else []))
    )
    if only_touched:
        weekly = _touched(weekly, TOUCHED_WEEK[:2])
    # A missing open or close shows as zero once the week has several rows.
    several = F.col("repeats") > 1
    ends = {
        name: F.when(several, F.coalesce(price, F.lit(0))).otherwise(price)
        for name, price in _ends().items()
    }
    return market_keys(weekly).withColumns(
        {
            **ends,
            "status": status,
            "latestEventDate": moment_time(stamp_moment(F.col("last"))),
            "volume": F.col("volume").cast(TOTAL),
        }
    )


def _first_and_last() -> list[Column]:
    deal = stamp(F.col("DEAL_DT"), F.col("dealPrice"))
    return [F.min(deal).alias("first"), F.max(deal).alias("last")]


def _ends() -> dict[str, Column]:
    return {"open": stamp_price(F.col("first")), "close": stamp_price(F.col("last"))}


def _spread() -> list[Column]:
    return [
        F.max("dealPrice").alias("high"),
        F.min("dealPrice").alias("low"),
        F.sum(F.col("dealQty") * F.col("carrierRows")).alias("volume"),
        F.sum("carrierRows").alias("repeats"),
    ]
