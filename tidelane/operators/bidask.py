"""Order book: current offers per route, week and terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelane.functions.values import mean
from tidelane.operators.fact import DISCHARGE, LOADING, OFFER, Tables
from tidelane.operators.nest import nest_pages, nest_ranked

BOOK_KEYS = [
    "marketTypeCode", "offerTypeCode", "baseYearWeek", "paymentTermCode", "rdTermCode",
    "containerTypeCode", "polCode", "podCode",
]
BOOK_CELL = [
    "tradeOfferNumber", "tradeOfferChangeSeq", "carrierCode", "carrierCount", "headPolCode",
    "headPodCode", "headPolName", "headPodName", "polCount", "podCount", "avgQty", "avgPrice",
    "allYn", "minYearWeek", "maxYearWeek", "maxPrice", "minPrice",
]


def mw_bidask_rows(tables: Tables) -> DataFrame:
    """Latest version of every offer, one row per route end pair, week and price.

    Carriers, lines and both route ends are first folded to one row per offer
    version and joined at that grain; the offer's own combinations unfold last.
    """
    book = (
        _latest_offers(tables["FTR_OFER"])
        .join(_ports_of(tables, LOADING, "pol"), OFFER)
        .join(_ports_of(tables, DISCHARGE, "pod"), OFFER, "left")
        .join(_lines_of(tables), OFFER, "left")
        .join(_carriers_of(tables), OFFER, "left")
    )
    for items, item in (("lines", "line"), ("pols", "pol"), ("pods", "pod")):
        book = book.withColumn(item, F.explode_outer(items)).drop(items)
    return book.select(
        F.col("TRDE_MKT_TP_CD").alias("marketTypeCode"),
        F.col("OFER_TP_CD").alias("offerTypeCode"),
        F.col("line.week").alias("baseYearWeek"),
        F.col("OFER_PYMT_TRM_CD").alias("paymentTermCode"),
        F.col("OFER_RD_TRM_CD").alias("rdTermCode"),
        F.col("line.container").alias("containerTypeCode"),
        F.col("pol.code").alias("polCode"),
        F.col("pod.code").alias("podCode"),
        F.col("OFER_NR").alias("tradeOfferNumber"),
        F.col("OFER_CHNG_SEQ").alias("tradeOfferChangeSeq"),
        "carrierCode",
        F.coalesce("carrierCount", F.lit(0)).cast("long").alias("carrierCount"),
        F.col("pol.code").alias("headPolCode"),
        F.col("pod.code").alias("headPodCode"),
        F.col("pol.name").alias("headPolName"),
        F.col("pod.name").alias("headPodName"),
        "polCount",
        "podCount",
        "avgQty",
        "avgPrice",
        F.col("ALL_YN").alias("allYn"),
        "minYearWeek",
        "maxYearWeek",
        "maxPrice",
        "minPrice",
    )


def mw_bidask(tables: Tables) -> DataFrame:
    """Documents of ``mw_bidask_rows``: per route, week, terms and month of offer, a cell per offer."""
    return nest_pages(mw_bidask_rows(tables), BOOK_KEYS, BOOK_CELL, "tradeOfferNumber")


def mw_bidask_ranked(tables: Tables, page_rows: int) -> DataFrame:
    """Documents of ``mw_bidask_rows``: per route, week and terms, pages of ``page_rows`` cells."""
    return nest_ranked(mw_bidask_rows(tables), BOOK_KEYS, BOOK_CELL, "tradeOfferNumber", page_rows)


def _latest_offers(offers: DataFrame) -> DataFrame:
    terms = ["TRDE_MKT_TP_CD", "OFER_TP_CD", "OFER_PYMT_TRM_CD", "OFER_RD_TRM_CD", "ALL_YN"]
    last = offers.groupBy("OFER_NR").agg(F.max("OFER_CHNG_SEQ").alias("OFER_CHNG_SEQ"))
    return last.join(offers.select(*OFFER, *terms).distinct(), OFFER, "left")


def _ports_of(tables: Tables, kind: str, end: str) -> DataFrame:
    """Distinct ports at one end of a version's routes, and how many route rows name one."""
    names = tables["MDM_PORT"].select(
        F.col("locCd").alias("TRDE_LOC_CD"), F.col("locNm").alias("name")
    )
    port = F.struct(F.col("TRDE_LOC_CD").alias("code"), "name")
    return (
        tables["FTR_OFER_RTE"]
        .filter(F.col("TRDE_LOC_TP_CD") == kind)
        .join(names.distinct(), "TRDE_LOC_CD", "left")
        .groupBy(*OFFER)
        .agg(F.collect_set(port).alias(f"{end}s"), F.count("TRDE_LOC_CD").alias(f"{end}Count"))
    )


def _lines_of(tables: Tables) -> DataFrame:
    # The price is part of the row identity though the cell does not show it.
    line = F.struct(
        F.col("BSE_YW").alias("week"),
        F.col("TRDE_CONT_TP_CD").alias("container"),
        F.col("OFER_PRCE").alias("price"),
    )
    return (
        tables["FTR_OFER_LINE_ITEM"]
        .groupBy(*OFFER)
        .agg(
            F.collect_set(line).alias("lines"),
            mean(F.col("OFER_PRCE")).alias("avgPrice"),
            mean(F.col("OFER_REMN_QTY")).alias("avgQty"),
            F.max("BSE_YW").alias("maxYearWeek"),
            F.min("BSE_YW").alias("minYearWeek"),
            F.max("OFER_PRCE").alias("maxPrice"),
            F.min("OFER_PRCE").alias("minPrice"),
        )
    )


def _carriers_of(tables: Tables) -> DataFrame:
    code: Column = F.col("OFER_CRYR_CD")
    return (
        tables["FTR_OFER_CRYR"]
        .groupBy(*OFFER)
        .agg(F.min(code).alias("carrierCode"), F.count(code).alias("carrierCount"))
    )
