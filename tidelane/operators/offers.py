"""Offer dashboards: summaries, remaining quantities, week lists and route lists.

Every job takes the offer tables; ``users`` or ``offers`` frames restrict it to
some users or offers for an incremental run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.functions.calendar import week_closing
from tidelane.functions.values import null_safe_join, ratio
from tidelane.operators.blocks import look_back
from tidelane.operators.fact import (
    OFFER,
    ROUTE,
    Tables,
    named_routes,
    offer_carriers,
    offer_headers,
    offer_routes,
    week_lines,
)
from tidelane.operators.nest import nest, nest_pages, nest_ranked

VERSION = ["offerNumber", "offerChangeSeq"]
USER = ["userId", "offerTypeCode"]
AMOUNTS = ["DEAL_AMT", "DEAL_PRCE", "DEAL_QTY", "OFER_PRCE", "OFER_QTY", "OFER_REMN_QTY"]
LINE_ITEM = [
    "baseYearWeek", "dealQty", "dealPrice", "dealAmt", "leftQty", "leftPrice", "leftAmt",
    "lineEventTimestamp", "lineReferenceEventNumber", "lineReferenceEventChangeSeq",
]
SUMMARY_CELL = [
    "polCount", "podCount", "offerNumber", "offerChangeSeq", "eventTimestamp",
    "referenceEventNumber", "referenceEventChangeSeq", "allYn", "offerStatus", "carrierCount",
    "lineItem", "routeItem", "carrierItem",
]
WEEK_DETAIL_KEYS = [
    "offerNumber", "baseYearWeek", "offerChangeSeq", "aggDealQty", "aggDealPrice", "aggDealAmt",
    "aggOfferQty", "aggLeftQty", "aggLeftPrice", "aggLeftAmt", "tradeClosing",
]
DEAL_LOG = [
    "eventTimestamp", "referenceEventNumber", "referenceEventChangeSeq", "dealQty", "dealPrice",
    "dealAmt", "offerQty", "leftQty", "leftPrice", "leftAmt",
]

# Versions of an offer and week that one task looks back over.
VERSIONS_PER_RUN = 1024

# Cells of one page where pages are cut by rank.
PAGE_CELLS = 100

# Filler of the week lists, and the status codes of an offer.
ALL = "all"
OPEN = "0"
SHUT = "1"


def restricted(
    tables: Tables, users: DataFrame | None = None, offers: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Offer tables cut to the offers of ``users`` (``EMP_NR``) or to ``offers`` (``OFER_NR``).

    An offer stays whole, with versions and deals that other users entered; keep the wanted users
    after the job.
    """
    cut = dict(tables)
    if users is not None:
        owned = cut["FTR_OFER"].join(users, "EMP_NR", "left_semi")
        offers = owned.select("OFER_NR").distinct()
    if offers is not None:
        for name, table in cut.items():
            if "OFER_NR" in table.columns:
                cut[name] = table.join(offers, "OFER_NR", "left_semi")
    return cut


def owners(offers: DataFrame, numbers: DataFrame) -> DataFrame:
    """Users (``EMP_NR``) who entered any version of the offers ``numbers`` (``OFER_NR``)."""
    return offers.join(numbers, "OFER_NR", "left_semi").select("EMP_NR").distinct()


def split_numbers(lists: DataFrame, column: str, name: str = "OFER_NR") -> DataFrame:
    """Distinct numbers from a column of pipe-separated lists."""
    return lists.select(F.explode(F.split(column, "\\|")).alias(name)).distinct()


def next_version_deals(deals: DataFrame) -> DataFrame:
    """Deals keyed by the offer version they produced: the one after the version dealt on."""
    return deals.select(
        "OFER_NR",
        (F.col("OFER_CHNG_SEQ") + 1).alias("OFER_CHNG_SEQ"),
        "DEAL_NR",
        "DEAL_CHNG_SEQ",
        "DEAL_DT",
    )


def latest_version(tables: Tables) -> DataFrame:
    """For each offer and week, the line of the highest version.

    The rank filter drops all but one row per offer and week in each map task,
    before the shuffle.
    """
    order = [F.col("OFER_CHNG_SEQ").desc(), *AMOUNTS, "EMP_NR", "OFER_TP_CD", "ALL_YN"]
    newest = Window.partitionBy("OFER_NR", "BSE_YW").orderBy(*order)
    return (
        offer_headers(tables["FTR_OFER"])
        .join(week_lines(tables["FTR_OFER_LINE_ITEM"], OFFER, AMOUNTS), OFFER, "left")
        .withColumn("nth", F.row_number().over(newest))
        .filter(F.col("nth") == 1)
        .drop("nth")
    )


def route_counts(tables: Tables) -> DataFrame:
    """Routes of an offer version with the number of distinct ports at either end."""
    routes = named_routes(offer_routes(tables["FTR_OFER_RTE"]), tables["MDM_PORT"])
    pairs = (
        tables["FTR_OFER"]
        .select(*OFFER)
        .distinct()
        .join(routes, OFFER, "left")
        .select(
            F.col("OFER_NR").alias("offerNumber"),
            F.col("OFER_CHNG_SEQ").alias("offerChangeSeq"),
            F.struct("polCode", "polName", "podCode", "podName").alias("route"),
        )
    )
    items = pairs.groupBy(*VERSION).agg(F.sort_array(F.collect_set("route")).alias("routeItem"))
    return items.select(
        *VERSION,
        _distinct_of("routeItem", "polCode").alias("polCount"),
        _distinct_of("routeItem", "podCode").alias("podCount"),
        "routeItem",
    )


def summary_rows(tables: Tables, current_week: str) -> DataFrame:
    """One row per offer version still current in some week: lines, status, routes, carriers."""
    return (
        _line_items(tables, current_week)
        .join(_named_versions(offer_carriers(tables)), VERSION, "left")
        .join(route_counts(tables), VERSION, "left")
        .select(*USER, *SUMMARY_CELL)
    )


def _line_items(tables: Tables, current_week: str) -> DataFrame:
    left_amount = F.when(
        F.col("OFER_REMN_QTY") != 0, F.col("OFER_REMN_QTY") * F.col("OFER_PRCE")
    ).otherwise(F.lit(0))
    lines = (
        latest_version(tables)
        .join(next_version_deals(tables["FTR_DEAL"]), OFFER, "left")
        .select(
            F.col("EMP_NR").alias("userId"),
            F.col("OFER_TP_CD").alias("offerTypeCode"),
            F.col("OFER_NR").alias("offerNumber"),
            F.col("OFER_CHNG_SEQ").alias("offerChangeSeq"),
            F.col("ALL_YN").alias("allYn"),
            F.col("BSE_YW").alias("baseYearWeek"),
            F.col("DEAL_QTY").alias("dealQty"),
            F.col("DEAL_PRCE").alias("dealPrice"),
            F.col("DEAL_AMT").alias("dealAmt"),
            F.col("OFER_REMN_QTY").alias("leftQty"),
            F.col("OFER_PRCE").alias("leftPrice"),
            left_amount.alias("leftAmt"),
            # Without a deal the line refers to the offer itself.
            F.coalesce("DEAL_DT", placed_at(F.col("OFER_NR"))).alias("lineEventTimestamp"),
            F.coalesce("DEAL_NR", "OFER_NR").alias("lineReferenceEventNumber"),
            F.coalesce("DEAL_CHNG_SEQ", "OFER_CHNG_SEQ").alias("lineReferenceEventChangeSeq"),
        )
    )
    items = lines.groupBy(*USER, *VERSION, "allYn").agg(
        F.sort_array(F.collect_set(F.struct(*LINE_ITEM))).alias("lineItem"),
        F.max("lineEventTimestamp").alias("eventTimestamp"),
        F.max("lineReferenceEventNumber").alias("referenceEventNumber"),
        F.max("lineReferenceEventChangeSeq").alias("referenceEventChangeSeq"),
        F.max("baseYearWeek").alias("lastWeek"),
        F.min("baseYearWeek").alias("firstWeek"),
        F.sum("leftAmt").alias("leftTotal"),
    )
    ahead = F.col("firstWeek") > current_week
    running = (F.col("lastWeek") > current_week) & (F.col("firstWeek") < current_week)
    open_now = (F.col("leftTotal") > 0) & (ahead | (running & (F.col("allYn") == "0")))
    return items.withColumn("offerStatus", F.when(open_now, OPEN).otherwise(SHUT))


def offer_summary(tables: Tables, current_week: str) -> DataFrame:
    """Documents of ``summary_rows``: per user, side and month of offer, a cell per offer version."""
    return nest_pages(summary_rows(tables, current_week), USER, SUMMARY_CELL, "offerNumber", "cell")


def offer_summary_pages(tables: Tables, current_week: str, page_rows: int = PAGE_CELLS) -> DataFrame:
    """Documents of ``summary_rows``: per user and side, pages of ``page_rows`` offers by number."""
    rows = summary_rows(tables, current_week)
    return nest_ranked(rows, USER, SUMMARY_CELL, "offerNumber", page_rows, "cell")


def week_detail_rows(tables: Tables, placed: bool = False) -> DataFrame:
    """Deal log of each offer and week at its last version, with totals over all versions.

    A version's deal quantity is what the remaining quantity fell by since the
    version before.  Say ``placed`` if the tables lie by offer: the rows then
    stay there, under windows of one order.  Otherwise they are cut into runs,
    so that not even the versions of one offer have to meet in one task.
    """
    lines = (
        tables["FTR_OFER_LINE_ITEM"]
        .join(next_version_deals(tables["FTR_DEAL"]), OFFER, "left")
        .select(
            F.col("OFER_NR").alias("offerNumber"),
            F.col("BSE_YW").alias("baseYearWeek"),
            F.col("OFER_CHNG_SEQ").alias("offerChangeSeq"),
            F.col("DEAL_DT").alias("eventTimestamp"),
            F.col("DEAL_NR").alias("referenceEventNumber"),
            F.col("DEAL_CHNG_SEQ").alias("referenceEventChangeSeq"),
            F.col("OFER_REMN_QTY").alias("leftQty"),
            F.col("OFER_PRCE").alias("leftPrice"),
            F.col("OFER_QTY").alias("offerQty"),
            F.col("DEAL_PRCE").alias("dealPrice"),
            F.lit(1).alias("one"),
        )
    )
    week = ["offerNumber", "baseYearWeek"]
    order = [
        "offerChangeSeq", "eventTimestamp", "referenceEventNumber", "referenceEventChangeSeq",
        "leftQty", "leftPrice", "offerQty", "dealPrice",
    ]
    of_week = Window.partitionBy(*week)
    if placed:
        traced = lines.withColumn("previous", F.lag("leftQty", 1, 0).over(of_week.orderBy(*order)))
    else:
        traced = look_back(
            lines,
            keys=week,
            block=F.floor(F.col("offerChangeSeq") / VERSIONS_PER_RUN),
            order=order,
            value="leftQty",
            weight="one",
            default=F.lit(0),
        )
    logged = (
        traced.withColumn(
            "dealQty",
            F.when(F.col("offerChangeSeq") == 0, F.lit(0)).otherwise(
                F.col("previous") - F.col("leftQty")
            ),
        )
        .withColumn("dealAmt", F.col("dealQty") * F.col("dealPrice"))
        .withColumn(
            "leftAmt",
            F.when(F.col("leftQty") != 0, F.col("leftQty") * F.col("leftPrice")).otherwise(
                F.lit(0)
            ),
        )
    )
    totals = {
        "aggDealQty": F.sum("dealQty"),
        "aggDealAmt": F.sum("dealAmt"),
        "aggOfferQty": F.sum("offerQty"),
        "aggLeftQty": F.min("leftQty"),
        "aggLeftAmt": F.min("leftAmt"),
    }
    kept = (F.col("offerChangeSeq") == 0) | (F.col("dealQty") > 0)
    if placed:
        windows = {**totals, "lastVersion": F.max("offerChangeSeq")}
        told = logged.select("*", *[total.over(of_week).alias(name) for name, total in windows.items()])
        detailed = told.filter(F.col("offerChangeSeq").eqNullSafe(F.col("lastVersion"))).filter(kept)
    else:
        # As a rank filter, "of the last version" drops the other versions before the shuffle.
        newest = of_week.orderBy(F.col("offerChangeSeq").desc())
        last = logged.withColumn("nth", F.rank().over(newest)).filter(F.col("nth") == 1)
        summed = logged.groupBy(*week).agg(*[total.alias(name) for name, total in totals.items()])
        detailed = null_safe_join(last.filter(kept), summed, week)
    return (
        detailed
        .withColumns(
            {
                "aggDealPrice": ratio(F.col("aggDealAmt"), F.col("aggDealQty")),
                "aggLeftPrice": F.col("leftPrice"),
                "tradeClosing": week_closing(F.col("baseYearWeek")),
            }
        )
        .select(*WEEK_DETAIL_KEYS, *DEAL_LOG)
    )


def offer_week_detail(tables: Tables) -> DataFrame:
    """Documents of ``week_detail_rows``: per offer and week, a log entry per deal."""
    return nest(
        week_detail_rows(tables), WEEK_DETAIL_KEYS, DEAL_LOG, "dealLog", repeated=True
    )


def offer_week_list(tables: Tables) -> DataFrame:
    """Weeks on offer per user and side: in all, per POL, per POD, and per pair.

    Only the latest version of an offer counts.  ``all`` marks a collapsed
    port, while a missing port stays null.
    """
    number, version = F.col("OFER_NR"), F.col("OFER_CHNG_SEQ")
    offers = (
        tables["FTR_OFER"]
        .groupBy("OFER_NR", F.col("OFER_TP_CD").alias("offerTypeCode"))
        .agg(F.max(version).alias("OFER_CHNG_SEQ"), F.min("EMP_NR").alias("userId"))
    )
    lines = (
        tables["FTR_OFER_LINE_ITEM"]
        .groupBy("OFER_NR", F.col("BSE_YW").alias("week"))
        .agg(F.max(version).alias("OFER_CHNG_SEQ"))
    )
    routes = (
        offer_routes(tables["FTR_OFER_RTE"], loaded_only=True)
        .groupBy(*ROUTE, number)
        .agg(F.max(version).alias("OFER_CHNG_SEQ"))
    )
    # The levels repeat each row four times, so duplicates go first.
    placed = (
        offers.join(lines, OFFER, "left")
        .join(routes, OFFER, "left")
        .select(*USER, *ROUTE, "week")
        .distinct()
    )
    user, side, pol, pod = (F.col(name) for name in [*USER, *ROUTE])
    levels = placed.groupingSets(
        [[user, side], [user, side, pol], [user, side, pod], [user, side, pol, pod]],
        user, side, pol, pod,
    )
    return (
        levels.agg(
            F.grouping("polCode").alias("anyPol"),
            F.grouping("podCode").alias("anyPod"),
            F.sort_array(F.collect_set("week")).alias("baseYearWeek"),
        )
        .select(
            *USER,
            F.when(F.col("anyPol") == 1, ALL).otherwise(pol).alias("polCode"),
            F.when(F.col("anyPod") == 1, ALL).otherwise(pod).alias("podCode"),
            "baseYearWeek",
        )
        .distinct()
    )


def route_list_rows(tables: Tables) -> DataFrame:
    """Distinct named routes per user and side, over all versions of their offers."""
    located = tables["FTR_OFER_RTE"].select(
        "OFER_NR", "OFER_REG_SEQ", F.col("TRDE_LOC_CD").alias("code"), "TRDE_LOC_TP_CD"
    )
    pols = (
        located.filter("TRDE_LOC_TP_CD = '02'")
        .select("OFER_NR", "OFER_REG_SEQ", F.col("code").alias("polCode"))
        .distinct()
    )
    pods = (
        located.filter("TRDE_LOC_TP_CD = '03'")
        .select("OFER_NR", "OFER_REG_SEQ", F.col("code").alias("podCode"))
        .distinct()
    )
    routes = pols.join(pods, ["OFER_NR", "OFER_REG_SEQ"], "left").select("OFER_NR", *ROUTE)
    owners = (
        tables["FTR_OFER"]
        .select(
            "OFER_NR",
            F.col("EMP_NR").alias("userId"),
            F.col("OFER_TP_CD").alias("offerTypeCode"),
        )
        .distinct()
    )
    routed = owners.join(routes, "OFER_NR", "left").select(*USER, *ROUTE).distinct()
    ports = tables["MDM_PORT"].select("locCd", "locNm").distinct()
    return named_routes(routed, ports).select(*USER, *ROUTE, "polName", "podName")


def offer_route_list(tables: Tables) -> DataFrame:
    """Documents of ``route_list_rows``: per user and side, an entry per route."""
    return nest(
        route_list_rows(tables), USER, ["polCode", "podCode", "polName", "podName"], "rteList"
    )


def placed_at(offer_number: Column) -> Column:
    """Time an offer was placed: the digits after the letter of its number."""
    return F.substring(offer_number, 2, 21)


def _distinct_of(items: str, field: str) -> Column:
    codes = F.array_compact(F.array_distinct(F.transform(items, lambda item: item[field])))
    return F.size(codes).cast("long")


def _named_versions(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(dict(zip(OFFER, VERSION)))
