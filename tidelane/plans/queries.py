"""The query registry: every job over a folder of star-schema parquet files.

Each query takes ``(spark, sf_dir)``.  Flat queries show a job before nesting;
``*_cells`` queries show the size of each nested array and one of its fields.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelane.functions.values import MONEY, TOTAL, null_safe_join, sampled, topic_name
from tidelane.operators import bidask, changes, events, fact, index, market, offers
from tidelane.operators.nest import joined_field
from tidelane.operators.offers import PAGE_CELLS
from tidelane.sources.bindings import deal_tables, index_rows, offer_tables
from tidelane.sources.sinks import json_documents

Query = Callable[[SparkSession, str], DataFrame]

CURRENT_WEEK = "199826"

# The day until which refresh queries take what is stored to have been built.
BUILT_ON = "1998-06-01"


def registry() -> dict[str, Query]:
    return {
        "stats_raw": stats_raw,
        "stats_raw_carrier_set": stats_raw_carrier_set,
        "mw_sum_flat": mw_sum_flat,
        "mw_sum_cells": mw_sum_cells,
        "mw_sum_wow": mw_sum_wow,
        "mw_hst_flat": mw_hst_flat,
        "mw_hst_cells": mw_hst_cells,
        "mw_wkdetail_flat": mw_wkdetail_flat,
        "mw_wkdetail_cells": mw_wkdetail_cells,
        "mw_sum_incr": mw_sum_incr,
        "mw_hst_incr": mw_hst_incr,
        "mw_wkdetail_incr": mw_wkdetail_incr,
        "mw_wkdetail_merged": mw_wkdetail_merged,
        "mi_sum_flat": mi_sum_flat,
        "mi_sum_chrono": mi_sum_chrono,
        "mi_sum_cells": mi_sum_cells,
        "mi_sum_incr": mi_sum_incr,
        "mi_sum_refresh": mi_sum_refresh,
        "idx_lst": idx_lst,
        "offer_raw": offer_raw,
        "offer_latest_version": offer_latest_version,
        "offer_route_counts": offer_route_counts,
        "offer_summary": offer_summary,
        "offer_summary_cells": offer_summary_cells,
        "offer_summary_pages": offer_summary_pages,
        "offer_summary_refresh": offer_summary_refresh,
        "offer_week_list_refresh": offer_week_list_refresh,
        "offer_route_list_refresh": offer_route_list_refresh,
        "offer_week_detail_refresh": offer_week_detail_refresh,
        "offer_event_log_refresh": offer_event_log_refresh,
        "offer_raw_append": offer_raw_append,
        "offer_week_detail": offer_week_detail,
        "offer_week_list": offer_week_list,
        "offer_route_list": offer_route_list,
        **{f"offer_event_{code}": partial(offer_event, code) for code in events.EVENT_NAMES},
        "offer_event_log": offer_event_log,
        "mw_bidask_flat": mw_bidask_flat,
        "mw_bidask_cells": mw_bidask_cells,
        "mw_bidask_pages": mw_bidask_pages,
        "cdc_max_id": cdc_max_id,
        "cdc_lag": cdc_lag,
        "cdc_gate": cdc_gate,
        "cdc_delta": cdc_delta,
        "cdc_marks": cdc_marks,
        "cdc_topics_mw": cdc_topics_mw,
        "cdc_topics_week": cdc_topics_week,
        "cdc_metrics": cdc_metrics,
        "upsert_by_key": upsert_by_key,
        "json_payload": json_payload,
        "topic_name": topic_names,
        "sample_json": sample_json,
    }


def rounded(name: str) -> Column:
    """Six decimals, halves up, in plain double arithmetic that any engine repeats exactly."""
    return (F.floor(F.col(name) * 1e6 + 0.5) / 1e6).alias(name)


def whole(name: str) -> Column:
    return F.col(name).cast(TOTAL).alias(name)


def amount(name: str) -> Column:
    return F.col(name).cast(MONEY).alias(name)


def listed(items: str, *fields: str) -> Column:
    """Elements of an array as ``a:b`` texts; a missing field shows as ``-``."""

    def shown(item: Column) -> Column:
        return F.concat_ws(":", *[F.coalesce(item[f].cast("string"), F.lit("-")) for f in fields])

    return F.array_join(F.transform(items, shown), ",")


# -- deal side ---------------------------------------------------------------


def stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.stats_raw(deal_tables(spark, sf_dir))


def stats_raw_carrier_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals of the top hundredth of the ids of any table."""
    tables, changed = _delta(spark, sf_dir)
    folded = fact.stats_raw_carrier_set(tables, changes.changed_deals(changed))
    return folded.withColumn("carrierItem", listed("carrierItem", "carrierCode", "carrierName"))


def mw_sum_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sum_output(market.mw_sum_rows(_fact(spark, sf_dir), CURRENT_WEEK))


def mw_sum_wow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sum_output(market.mw_sum_wow(_fact(spark, sf_dir), CURRENT_WEEK))


def mw_sum_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_sum(_fact(spark, sf_dir), CURRENT_WEEK)
    return _cells(documents, market.ROUTE_KEYS, "latestEventDate")


def mw_hst_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.mw_hst_rows(_fact(spark, sf_dir, folded=True)).select(
        *market.WEEK_KEYS, "idx", "timestamp", "referenceEventNumber",
        "referenceEventChangeNumber", amount("dealQty"), amount("dealPrice"), amount("dealAmt"),
        amount("priceChange"), rounded("priceRate"),
    )


def mw_hst_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_hst(_fact(spark, sf_dir, folded=True))
    return _cells(documents, [*market.WEEK_KEYS, "page"], "timestamp")


def mw_wkdetail_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail_output(market.mw_wkdetail_rows(_fact(spark, sf_dir)))


def mw_wkdetail_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_wkdetail(_fact(spark, sf_dir))
    return _cells(documents, [*market.WEEK_KEYS, "interval"], "intervalTimestamp")


# -- index side --------------------------------------------------------------


def mi_sum_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_output(index.mi_sum_rows(index_rows(spark, sf_dir)))


def mi_sum_chrono(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_output(index.mi_sum_rows(index_rows(spark, sf_dir), chronological=True))


def mi_sum_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series without the quotes of the last tenth of the days, brought up to date with them: equals a full build."""
    quotes = index_rows(spark, sf_dir)
    old, new = _last_tenth(quotes)
    stored = index.mi_sum_rows(old)
    updated = index.mi_sum_updated(stored, quotes, new)
    series = updated.select(*index.LOOK_BACK).distinct()
    return _index_output(changes.upsert_by_key(stored, updated, series, null_keys=True))


def mi_sum_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series without the quotes of the last tenth of the days; series with new quotes built again and replaced."""
    quotes = index_rows(spark, sf_dir)
    old, new = _last_tenth(quotes)
    # A change looks back over the rows of a name, so a name is built again as a whole.
    named = [name for name in index.LOOK_BACK if name in quotes.columns]
    replaced = new.select(*named).distinct()
    fresh = index.mi_sum_rows(null_safe_join(quotes, replaced, named, "left_semi"))
    return _index_output(changes.upsert_by_key(index.mi_sum_rows(old), fresh, replaced, null_keys=True))


def mi_sum_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = index.mi_sum(index_rows(spark, sf_dir))
    return _cells(documents, [*index.SERIES, "interval"], "xAxis")


def idx_lst(spark: SparkSession, sf_dir: str) -> DataFrame:
    indices = index.mi_sum_rows(index_rows(spark, sf_dir))
    detail = market.mw_wkdetail_rows(_fact(spark, sf_dir))
    catalogue = index.idx_lst(indices, detail)
    return catalogue.withColumn("intervalItem", listed("intervalItem", "intervalSeq", "interval"))


# -- offer side --------------------------------------------------------------


def offer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_output(fact.offer_raw(offer_tables(spark, sf_dir)))


def offer_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers.latest_version(offer_tables(spark, sf_dir))


def offer_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = offers.route_counts(offer_tables(spark, sf_dir))
    return counts.withColumn(
        "routeItem", listed("routeItem", "polCode", "polName", "podCode", "podName")
    )


def offer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary_output(offers.summary_rows(offer_tables(spark, sf_dir), CURRENT_WEEK))


def offer_summary_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = offers.offer_summary(offer_tables(spark, sf_dir), CURRENT_WEEK)
    open_offers = F.filter("cell", lambda item: item.offerStatus == offers.OPEN)
    lines = F.aggregate("cell", F.lit(0), lambda n, item: n + F.size(item.lineItem))
    last = F.array_max(F.transform("cell", lambda item: item.eventTimestamp))
    return documents.select(
        *offers.USER,
        "page",
        F.size("cell").alias("cells"),
        F.size(open_offers).alias("openCells"),
        lines.alias("lineItems"),
        last.alias("lastEvent"),
    )


def offer_summary_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, as JSON."""
    return json_documents(offers.offer_summary_pages(offer_tables(spark, sf_dir), CURRENT_WEEK, PAGE_CELLS))


def offer_week_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_detail_output(offers.week_detail_rows(offer_tables(spark, sf_dir), placed=True))


def offer_week_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_list_output(offers.offer_week_list(offer_tables(spark, sf_dir)))


def offer_route_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _route_list_output(offers.offer_route_list(offer_tables(spark, sf_dir)))


def offer_raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offer fact of the versions stored, with the rows of new versions added: equals a full build."""
    tables = offer_tables(spark, sf_dir)
    parts = [fact.offer_raw(_versions(tables, new)) for new in (False, True)]
    return _raw_output(parts[0].unionByName(parts[1]))


def offer_summary_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary_output(_refreshed_users(spark, sf_dir, lambda tables: offers.summary_rows(tables, CURRENT_WEEK)))


def offer_week_list_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_list_output(_refreshed_users(spark, sf_dir, offers.offer_week_list))


def offer_route_list_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _route_list_output(_refreshed_users(spark, sf_dir, offers.offer_route_list))


def offer_week_detail_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_detail_output(_refreshed_offers(spark, sf_dir, partial(offers.week_detail_rows, placed=True)))


def offer_event_log_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_log_output(
        _refreshed_offers(spark, sf_dir, lambda tables: events.offer_event_log(tables, CURRENT_WEEK))
    )


def offer_event(code: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.event_rows(offer_tables(spark, sf_dir), CURRENT_WEEK, code)
    money = ["dealPrice", "dealQty", "dealAmt", "offerPrice", "offerQty", "leftPrice", "leftQty"]
    return rows.withColumns(
        {
            **{name: F.col(name).cast(MONEY) for name in money},
            **{name: F.col(name).cast(TOTAL) for name in ("offerAmt", "leftAmt")},
        }
    )


def offer_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_log_output(events.offer_event_log(offer_tables(spark, sf_dir), CURRENT_WEEK))


def mw_bidask_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bidask.mw_bidask_rows(offer_tables(spark, sf_dir))
    return rows.withColumns(
        {"avgQty": rounded("avgQty"), "avgPrice": rounded("avgPrice")}
    )


def mw_bidask_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = bidask.mw_bidask(offer_tables(spark, sf_dir))
    return _cells(documents, [*bidask.BOOK_KEYS, "page"], "tradeOfferNumber")


def mw_bidask_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, as JSON, with averages of six decimals."""
    documents = bidask.mw_bidask_ranked(offer_tables(spark, sf_dir), PAGE_CELLS)

    def shown(cell: Column) -> Column:
        averages = [(F.floor(cell[name] * 1e6 + 0.5) / 1e6).alias(name) for name in ("avgQty", "avgPrice")]
        return cell.withField("avgQty", averages[0]).withField("avgPrice", averages[1])

    return json_documents(documents.withColumn("Cell", F.transform("Cell", shown)))


# -- incremental layer -------------------------------------------------------


def cdc_max_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.max_id(deal_tables(spark, sf_dir))


def cdc_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = deal_tables(spark, sf_dir)
    return changes.lag_behind(changes.max_id(tables), _processed(tables))


def cdc_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.gate(cdc_lag(spark, sf_dir), require_all=True)


def cdc_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changed = _delta(spark, sf_dir)
    rows = None
    for name, table in changed.items():
        part = table.select(F.lit(name).alias("tableName"), "ID", *fact.DEAL)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def cdc_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.next_marks(cdc_lag(spark, sf_dir))


def cdc_topics_mw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.route_topics(_delta_fact(spark, sf_dir))


def cdc_topics_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.week_topics(_delta_fact(spark, sf_dir))


def cdc_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, changed = _delta(spark, sf_dir)
    return changes.update_metrics(changed["FTR_DEAL"], changes.delta_fact(tables, changed))


def mw_sum_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    recomputed = market.mw_sum_rows(_flagged(spark, sf_dir), CURRENT_WEEK, only_touched=True)
    return _sum_output(recomputed)


def mw_hst_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_hst(_flagged(spark, sf_dir, folded=True), only_touched=True)
    return _cells(documents, [*market.WEEK_KEYS, "page"], "priceChange")


def mw_wkdetail_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_wkdetail(_flagged(spark, sf_dir), only_touched=True)
    return _cells(documents, [*market.WEEK_KEYS, "interval"], "close")


def mw_wkdetail_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail from the day states of unchanged deals and of changed ones, merged: equals a full build."""
    days = market.placed_days(_flagged(spark, sf_dir, folded=True))
    changed = F.col("deal.changed")
    parts = [market.day_states(days.filter(condition)) for condition in (~changed, changed)]
    return _detail_output(market.wkdetail_of_states(market.merged_states(parts[0].unionByName(parts[1]))))


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of the old deals with the touched routes replaced: equals a full rebuild."""
    flagged = _flagged(spark, sf_dir)
    stored = market.mw_sum_rows(flagged.filter(~F.col("changed")), CURRENT_WEEK)
    fresh = market.mw_sum_rows(flagged, CURRENT_WEEK, only_touched=True)
    # Every touched route has a week, so its own rows name it.
    topics = fresh.select(*fact.ROUTE).distinct()
    return _sum_output(changes.upsert_by_key(stored, fresh, topics, null_keys=True))


# -- messages ----------------------------------------------------------------


def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_documents(market.mw_sum(_fact(spark, sf_dir), CURRENT_WEEK))


def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = F.to_json(F.struct("polCode", "podCode"))
    routes = fact.deal_routes(deal_tables(spark, sf_dir)["FTR_DEAL_RTE"]).distinct()
    return routes.select("DEAL_NR", topic_name(document).alias("topic"))


def sample_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = market.mw_sum(_fact(spark, sf_dir), CURRENT_WEEK)
    return json_documents(sampled(documents, market.ROUTE_KEYS, 0.1))


# -- shared ------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str, folded: bool = False) -> DataFrame:
    return fact.trade_fact(deal_tables(spark, sf_dir, shared=folded), folded=folded)


def _last_tenth(quotes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes of the first nine tenths of the days, and of the last."""
    days = F.datediff(F.max("date"), F.min("date"))
    cut = quotes.agg(F.date_add(F.min("date"), (days * 9 / 10).cast("int")).alias("cut")).scalar()
    return quotes.filter(F.col("date") <= cut), quotes.filter(F.col("date") > cut)


def _versions(tables: fact.Tables, new: bool) -> dict[str, DataFrame]:
    """Offer tables with the versions entered until ``BUILT_ON``, or with those after it.

    A version is entered as many days after its offer as its number says, and the deal that made
    it goes with it.
    """
    parts = [F.substring("OFER_NR", start, size).cast("int") for start, size in ((2, 4), (6, 2), (8, 2))]
    placed = F.make_date(*parts)
    cut = dict(tables)
    for name, table in tables.items():
        if "OFER_NR" in table.columns:
            # A deal names the version it was struck on, and made the next.
            version = F.col("OFER_CHNG_SEQ").cast("int") + (1 if name == "FTR_DEAL" else 0)
            after = F.date_add(placed, version) > F.lit(BUILT_ON).cast("date")
            cut[name] = table.filter(after if new else ~after)
    return cut


def _refreshed_users(
    spark: SparkSession, sf_dir: str, job: Callable[[fact.Tables], DataFrame]
) -> DataFrame:
    """What was stored, with the rows of users of new versions replaced: equals a full build."""
    tables = offer_tables(spark, sf_dir)
    numbers = _versions(tables, new=True)["FTR_OFER"].select("OFER_NR").distinct()
    users = offers.owners(tables["FTR_OFER"], numbers)
    replaced = users.select(F.col("EMP_NR").alias("userId"))
    fresh = job(offers.restricted(tables, users=users)).join(replaced, "userId", "left_semi")
    return changes.upsert_by_key(job(_versions(tables, new=False)), fresh, replaced)


def _refreshed_offers(
    spark: SparkSession, sf_dir: str, job: Callable[[fact.Tables], DataFrame]
) -> DataFrame:
    """What was stored, with the rows of offers with new versions replaced: equals a full build."""
    tables = offer_tables(spark, sf_dir)
    numbers = _versions(tables, new=True)["FTR_OFER"].select("OFER_NR").distinct()
    replaced = numbers.select(F.col("OFER_NR").alias("offerNumber"))
    fresh = job(offers.restricted(tables, offers=numbers))
    return changes.upsert_by_key(job(_versions(tables, new=False)), fresh, replaced)


def _raw_output(raw: DataFrame) -> DataFrame:
    return raw.withColumn("carrierItem", listed("carrierItem", "carrierCode", "carrierName"))


def _summary_output(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "lineItem": listed(
                "lineItem", "baseYearWeek", "dealQty", "leftQty", "lineEventTimestamp",
                "lineReferenceEventNumber", "lineReferenceEventChangeSeq",
            ),
            "routeItem": listed("routeItem", "polCode", "podCode"),
            "carrierItem": listed("carrierItem", "carrierCode"),
        }
    )


def _week_detail_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        "offerNumber", "baseYearWeek", "offerChangeSeq", whole("aggDealQty"),
        rounded("aggDealPrice"), whole("aggDealAmt"), whole("aggOfferQty"), whole("aggLeftQty"),
        amount("aggLeftPrice"), whole("aggLeftAmt"), "tradeClosing", "eventTimestamp",
        "referenceEventNumber", "referenceEventChangeSeq", amount("dealQty"), amount("dealPrice"),
        whole("dealAmt"), amount("offerQty"), amount("leftQty"), amount("leftPrice"),
        whole("leftAmt"),
    )


def _week_list_output(weeks: DataFrame) -> DataFrame:
    return weeks.withColumn("baseYearWeek", F.array_join("baseYearWeek", ","))


def _route_list_output(routes: DataFrame) -> DataFrame:
    return routes.withColumn(
        "rteList", listed("rteList", "polCode", "podCode", "polName", "podName")
    )


def _event_log_output(documents: DataFrame) -> DataFrame:
    entries = F.aggregate("eventCell", F.lit(0), lambda n, cell: n + F.size(cell.eventLog))
    return documents.select(
        *events.OFFER_KEYS,
        "page",
        F.size("eventCell").alias("cells"),
        joined_field("eventCell", "eventCode").alias("eventCodes"),
        entries.alias("logEntries"),
    )


def _sum_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        *market.WEEK_KEYS, "status", amount("open"), amount("low"), amount("high"),
        amount("close"), "volume", amount("changeValue"), rounded("changeRate"),
        "latestEventDate",
    )


def _detail_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        *market.WEEK_KEYS, "interval", "xAxis", "intervalTimestamp", amount("open"),
        amount("low"), amount("high"), amount("close"), "volume", amount("changeValue"),
        rounded("changeRate"),
    )


def _index_output(rows: DataFrame) -> DataFrame:
    return rows.select(
        *index.SERIES, "interval", "xAxis", "intervalTimestamp", rounded("value"),
        rounded("changeValue"), rounded("changeRate"), "volume",
    )


def _cells(documents: DataFrame, keys: list[str], field: str) -> DataFrame:
    return documents.select(
        *keys, F.size("Cell").alias("cells"), joined_field("Cell", field).alias("items")
    )


def _processed(tables: fact.Tables) -> DataFrame:
    """Marks that leave the top hundredth of the ids unprocessed."""
    return changes.max_id(tables).withColumn("maxId", F.expr("maxId - maxId div 100"))


def _delta(spark: SparkSession, sf_dir: str) -> tuple[fact.Tables, dict[str, DataFrame]]:
    tables = deal_tables(spark, sf_dir)
    return tables, changes.delta(tables, _processed(tables))


def _flagged(spark: SparkSession, sf_dir: str, folded: bool = False) -> DataFrame:
    tables = deal_tables(spark, sf_dir, shared=folded)
    return changes.fact_with_changes(tables, _processed(tables), folded=folded)


def _delta_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.delta_fact(*_delta(spark, sf_dir))
