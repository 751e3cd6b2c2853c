"""Life-cycle events of an offer: placed, dealt, week expired, all dealt, closed."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.functions.calendar import week_closing
from tidelane.operators.fact import OFFER, Tables
from tidelane.operators.nest import nest
from tidelane.operators.offers import placed_at

OFFER_KEYS = ["offerNumber", "allYn", "offerTypeCode"]
EVENT_CELL = ["eventCode", "eventName", "lastEventTimestamp", "lastEventHost", "eventLog"]
LOG_ENTRY = [
    "eventTimestamp", "referenceEventNumber", "referenceEventNumberChangeSeq", "baseYearWeek",
    "dealPrice", "dealQty", "dealAmt", "offerPrice", "offerQty", "offerAmt", "leftPrice",
    "leftQty", "leftAmt", "tradeClosing",
]

# What a log entry is made of.
LINE = [
    "baseYearWeek", "dealPrice", "dealQty", "dealAmt", "offerPrice", "offerQty", "leftQty",
    "DEAL_NR", "DEAL_CHNG_SEQ", "DEAL_DT", "closing",
]

# Versions of an offer in one document.
PAGE_VERSIONS = 10_000

# Event codes with their names, and the host every event carries.
EVENT_NAMES = {
    "01": "offerPlaced",
    "02": "offerDealt",
    "03": "weekExpired",
    "04": "allDealt",
    "05": "offerClosed",
}
EVENT_HOST = "F9_SYSTETM_ADMIN"


def events(
    tables: Tables,
    current_week: str,
    page_versions: int = PAGE_VERSIONS,
    codes: Iterable[str] = tuple(EVENT_NAMES),
) -> DataFrame:
    """One row per offer and event with its log.

    All five events come out of one aggregate over the offer lines: the lines
    of a version are collected once, and each event's log is made of those it
    applies to.  What an event asks of the whole offer (last version, last deal
    time) is told to the lines by a window, in the order that the joins leave
    them in.  A ``page`` is a run of ``page_versions`` versions.  Only the
    events in ``codes`` are computed.
    """
    codes = tuple(codes)
    page = F.floor(F.col("offerChangeSeq") / page_versions).cast("int").alias("page")
    expired = F.col("baseYearWeek") < current_week
    facts = {
        "lastDealOfOffer": F.col("DEAL_DT"),
        "lastExpiryOfOffer": F.when(expired, F.col("closing")),
        "lastExpiredVersion": F.when(expired, F.col("offerChangeSeq")),
        "lastVersion": F.col("offerChangeSeq"),
    }
    offer = Window.partitionBy("offerNumber")
    # An offer without a number has no events.
    lines = (
        _lines(tables)
        .filter(F.col("offerNumber").isNotNull())
        .select("*", page, *[F.max(value).over(offer).alias(name) for name, value in facts.items()])
    )
    versions = lines.groupBy(*OFFER_KEYS, "page", "offerChangeSeq").agg(
        F.collect_list(F.struct(*LINE)).alias("lines"),
        F.max("DEAL_DT").alias("lastDealOfVersion"),
        F.max(F.when(expired, F.col("offerChangeSeq"))).alias("expiredVersion"),
        F.sum("leftQty").alias("left"),
        F.max("baseYearWeek").alias("lastWeek"),
        *[F.max(name).alias(name) for name in facts],
    )
    placed, deal_time = placed_at(F.col("offerNumber")), lambda line: line.DEAL_DT
    later = F.col("offerChangeSeq") > 0

    def closing(line: Column) -> Column:
        return F.when(line.DEAL_DT > line.closing, line.DEAL_DT).otherwise(line.closing)

    logs = {
        "01": _log(lambda line: F.col("offerChangeSeq") == 0, lambda line: placed),
        "02": _log(lambda line: later & line.DEAL_NR.isNotNull(), deal_time, of_deal=True),
        "03": _log(lambda line: line.baseYearWeek < current_week, lambda line: line.closing),
        "04": _log(None, deal_time),
        "05": _log(None, deal_time, closing),
    }
    # Equal entries count once.
    logged = versions.withColumns({f"log{code}": logs[code] for code in codes}).drop("lines")
    known = logged.withColumns({f"log{code}": _distinct(f"log{code}") for code in codes})
    if "05" in codes:
        known = known.withColumn("closedLeft", _sum_of("log05", "leftQty"))
    current = F.col("offerChangeSeq") == F.col("lastVersion")
    closed = (F.col("closedLeft") == 0) | (F.col("lastWeek") < current_week)
    expired_last = F.col("expiredVersion") == F.col("lastExpiredVersion")
    rules = {
        "01": lambda: (F.size("log01") > 0, placed),
        "02": lambda: (F.size("log02") > 0, F.col("lastDealOfVersion")),
        "03": lambda: (expired_last, F.col("lastExpiryOfOffer")),
        "04": lambda: (F.col("left") == 0, F.col("lastDealOfOffer")),
        "05": lambda: (current & closed, F.col("lastDealOfOffer")),
    }
    cells = [_cell(code, *rules[code]()) for code in codes]
    return (
        known.select(*OFFER_KEYS, "page", F.explode(F.array_compact(F.array(*cells))).alias("event"))
        .select(*OFFER_KEYS, "page", "event.*")
    )


def event_rows(tables: Tables, current_week: str, code: str | None = None) -> DataFrame:
    """Log entries of all events, or of the one with ``code``, as flat rows."""
    codes = tuple(EVENT_NAMES) if code is None else (code,)
    wanted = events(tables, current_week, codes=codes)
    return wanted.select(*OFFER_KEYS, *EVENT_CELL[:4], F.explode("eventLog").alias("entry")).select(
        *OFFER_KEYS, *EVENT_CELL[:4], "entry.*"
    )


def offer_event_log(
    tables: Tables, current_week: str, page_versions: int = PAGE_VERSIONS
) -> DataFrame:
    """Documents of ``events``: one per offer, a cell per event, a log in each cell.

    An offer's versions from ``page_versions`` on continue on further pages.
    """
    rows = events(tables, current_week, page_versions)
    return nest(rows, [*OFFER_KEYS, "page"], EVENT_CELL, "eventCell", repeated=True)


def _lines(tables: Tables) -> DataFrame:
    deals = tables["FTR_DEAL"].select(*OFFER, "DEAL_NR", "DEAL_CHNG_SEQ", "DEAL_DT")
    offers = tables["FTR_OFER"].select(*OFFER, "OFER_TP_CD", "ALL_YN")
    return (
        tables["FTR_OFER_LINE_ITEM"]
        .join(deals, OFFER, "left")
        .join(offers, OFFER, "left")
        .select(
            F.col("OFER_NR").alias("offerNumber"),
            F.col("ALL_YN").alias("allYn"),
            F.col("OFER_TP_CD").alias("offerTypeCode"),
            F.col("OFER_CHNG_SEQ").alias("offerChangeSeq"),
            F.col("BSE_YW").alias("baseYearWeek"),
            F.col("DEAL_PRCE").alias("dealPrice"),
            F.col("DEAL_QTY").alias("dealQty"),
            F.col("DEAL_AMT").alias("dealAmt"),
            F.col("OFER_PRCE").alias("offerPrice"),
            F.col("OFER_QTY").alias("offerQty"),
            F.col("OFER_REMN_QTY").alias("leftQty"),
            "DEAL_NR",
            "DEAL_CHNG_SEQ",
            "DEAL_DT",
            week_closing(F.col("BSE_YW")).alias("closing"),
        )
    )


def _log(
    applies: Callable[[Column], Column] | None,
    time: Callable[[Column], Column],
    closing: Callable[[Column], Column] = lambda line: line.closing,
    of_deal: bool = False,
) -> Column:
    """Log entries, in order, of the ``lines`` an event applies to; they refer to the deal or to the offer."""

    def entry(line: Column) -> Column:
        number, version = (line.DEAL_NR, line.DEAL_CHNG_SEQ) if of_deal else (F.col("offerNumber"), F.col("offerChangeSeq"))
        values = [
            time(line), number, version, line.baseYearWeek,
            line.dealPrice, line.dealQty, line.dealAmt,
            line.offerPrice, line.offerQty, line.offerPrice * line.offerQty,
            line.offerPrice, line.leftQty, line.offerPrice * line.leftQty,
            closing(line),
        ]
        return F.struct(*[value.alias(name) for name, value in zip(LOG_ENTRY, values, strict=True)])

    return F.sort_array(F.transform("lines" if applies is None else F.filter("lines", applies), entry))


def _distinct(ordered: str) -> Column:
    """Items of an ordered array without repeats, which are neighbours there."""
    items = F.col(ordered)
    return F.filter(items, lambda item, nth: (nth == 0) | ~item.eqNullSafe(items[nth - 1]))


def _cell(code: str, happened: Column, last: Column) -> Column:
    return F.when(
        happened,
        F.struct(
            F.lit(code).alias("eventCode"),
            F.lit(EVENT_NAMES[code]).alias("eventName"),
            last.alias("lastEventTimestamp"),
            F.lit(EVENT_HOST).alias("lastEventHost"),
            F.col(f"log{code}").alias("eventLog"),
        ),
    )


def _sum_of(log: str, field: str) -> Column:
    """Sum of a field over a log; null when no entry has it."""
    values = F.array_compact(F.transform(log, lambda entry: entry[field].cast("decimal(38,2)")))
    total = F.aggregate(
        values,
        F.lit(0).cast("decimal(38,2)"),
        lambda sofar, value: (sofar + value).cast("decimal(38,2)"),
    )
    return F.when(F.size(values) > 0, total)
