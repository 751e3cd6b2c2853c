"""Denormalised facts: one row per deal (or offer) version, route, week and carrier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelane.functions.bloom import bloom, may_hold
from tidelane.functions.values import null_safe_join, sized

Tables = Mapping[str, DataFrame]

DEAL = ["DEAL_NR", "DEAL_CHNG_SEQ"]
OFFER = ["OFER_NR", "OFER_CHNG_SEQ"]
ROUTE = ["polCode", "podCode"]
ROUTE_WEEK = [*ROUTE, "baseYearWeek"]

# Location type codes of the two ends of a route, and the selling side.
LOADING = "02"
DISCHARGE = "03"
SELL = "S"


def stats_raw(tables: Tables, mdm_cryr: DataFrame | None = None) -> DataFrame:
    """Selling deals joined to routes, week lines and named carriers.

    The grain is deal version x route x week line x carrier.  ``mdm_cryr``
    (``carrierCode``, ``carrierName``) stands in when the tables carry no
    carrier master.
    """
    return (
        deal_headers(tables["FTR_DEAL"])
        .join(deal_routes(tables["FTR_DEAL_RTE"]), DEAL, "left")
        .join(deal_lines(tables["FTR_DEAL_LINE_ITEM"]), DEAL, "left")
        .join(deal_carriers(tables, mdm_cryr), DEAL, "left")
        .select(
            "carrierCode", *DEAL, "DEAL_DT", "marketTypeCode", "rdTermCode", "paymentTermCode",
            "offerTypeCode", *ROUTE, "baseYearWeek", "dealAmt", "dealPrice", "dealQty",
            "carrierName",
        )
    )


def trade_fact(
    tables: Tables,
    mdm_cryr: DataFrame | None = None,
    topics: DataFrame | None = None,
    deals: DataFrame | None = None,
    null_keys: bool = False,
    folded: bool = False,
) -> DataFrame:
    """``stats_raw`` with its carriers folded into two counts per row.

    ``carrierRows`` is how often ``stats_raw`` repeats the row and
    ``carrierNames`` how many distinct carrier names those repeats show (no
    name counts as one).  The market jobs need only these counts, so the
    carrier fan-out never reaches a shuffle.

    ``topics`` keeps only the routes (and weeks, if it has them) it lists and
    ``deals`` only the deal versions it lists; both cut the inputs before the
    joins.  A missing port or week matches no topic, unless ``null_keys`` lets
    it match a missing one.

    ``folded`` leaves a row per deal version, with its ``routes`` and its
    ``lines`` as arrays (see ``unfolded``), for jobs that move deals before
    they need each route and week apart.
    """
    if folded and topics is not None:
        raise ValueError("a folded fact takes deals, not topics")
    if deals is not None:
        tables = of_deals(tables, deals)
    headers = deal_headers(tables["FTR_DEAL"])
    routes = deal_routes(tables["FTR_DEAL_RTE"])
    lines = deal_lines(tables["FTR_DEAL_LINE_ITEM"])
    if deals is not None:
        headers = headers.join(deals, DEAL, "left_semi")
    if folded:
        fact = _folded(headers, route_lists(tables["FTR_DEAL_RTE"], DEAL, "OFFER_REG_SEQ"), lines)
    elif topics is None:
        fact = headers.join(routes, DEAL, "left").join(lines, DEAL, "left")
    else:
        ends = topics.select(*ROUTE).distinct()
        if null_keys:
            located = restrict(headers.join(routes, DEAL, "left"), ends, null_keys=True)
        else:
            located = headers.join(restrict(routes, ends), DEAL)
        fact = located.join(lines, DEAL, "left")
        if "baseYearWeek" in topics.columns:
            fact = restrict(fact, topics, null_keys)
    return fact.join(_carrier_counts(tables, mdm_cryr), DEAL, "left").withColumns(
        {
            "carrierRows": F.coalesce("carrierRows", F.lit(1)),
            "carrierNames": F.coalesce("carrierNames", F.lit(1)),
        }
    )


def flagged_fact(
    tables: Tables, fresh: Mapping[str, Column], mdm_cryr: DataFrame | None = None, folded: bool = False
) -> DataFrame:
    """``trade_fact`` with ``changed``: whether any table has a row of the deal version that is new.

    ``fresh`` tells new rows by a condition per table. The flags ride along the joins, each table
    is read once, and nothing is joined twice.
    """
    of_deal = Window.partitionBy(*DEAL)
    new = {name: F.coalesce(condition, F.lit(False)) for name, condition in fresh.items()}
    headers = tables["FTR_DEAL"].withColumn("headerNew", new["FTR_DEAL"])
    lines = tables["FTR_DEAL_LINE_ITEM"].withColumn("lineNew", new["FTR_DEAL_LINE_ITEM"])
    routes = tables["FTR_DEAL_RTE"].withColumn("routeNew", new["FTR_DEAL_RTE"])
    carriers = {**tables, "FTR_DEAL_CRYR": tables["FTR_DEAL_CRYR"].withColumn("carrierNew", new["FTR_DEAL_CRYR"])}
    # A version's header rows, too, are flagged by each other.
    own = deal_headers(headers, "headerNew").withColumn("headerNew", F.max("headerNew").over(of_deal))
    if folded:
        located = route_lists(routes, DEAL, "OFFER_REG_SEQ", flag="routeNew")
        joined = _folded(own, located, deal_lines(lines, "lineNew"), "lineNew")
    else:
        located = own.join(route_pairs(routes, DEAL, "OFFER_REG_SEQ", flag="routeNew"), DEAL, "left")
        joined = located.join(deal_lines(lines, "lineNew").withColumn("lineNew", F.max("lineNew").over(of_deal)), DEAL, "left")
    flagged = joined.join(_carrier_counts(carriers, mdm_cryr, "carrierNew"), DEAL, "left")
    flags = ["headerNew", "routeNew", "lineNew", "carrierNew"]
    changed = F.greatest(*[F.coalesce(flag, F.lit(False)) for flag in flags])
    return flagged.withColumns(
        {
            "carrierRows": F.coalesce("carrierRows", F.lit(1)),
            "carrierNames": F.coalesce("carrierNames", F.lit(1)),
            "changed": changed,
        }
    ).drop(*flags)


def _folded(headers: DataFrame, routes: DataFrame, lines: DataFrame, *flags: str) -> DataFrame:
    """Deal versions with ``routes`` and ``lines`` as arrays; one without any has an entry of nulls there."""
    line = F.struct("baseYearWeek", "dealAmt", "dealPrice", "dealQty")
    listed = lines.groupBy(*DEAL).agg(F.collect_list(line).alias("lines"), *[F.max(flag).alias(flag) for flag in flags])
    fact = headers.join(routes, DEAL, "left").join(listed, DEAL, "left")
    for name in ("routes", "lines"):
        kind = fact.schema[name].dataType
        none = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.elementType.fields]))
        fact = fact.withColumn(name, F.coalesce(name, none))
    return fact


def unfolded(folded: DataFrame) -> DataFrame:
    """A folded fact with a row per route and week line, as ``trade_fact`` has them."""
    rows = folded.withColumn("route", F.explode("routes")).withColumn("line", F.explode("lines"))
    return rows.select("*", "route.*", "line.*").drop("routes", "lines", "route", "line")


def of_deals(tables: Tables, deals: DataFrame) -> dict[str, DataFrame]:
    """The deal tables without most rows of other deal versions than ``deals``.

    A Bloom filter drops them before anything is aggregated or shuffled; what it lets through in
    vain goes in the joins that follow.
    """
    words = bloom(deals.select(*DEAL))
    parts = ["FTR_DEAL_LINE_ITEM", "FTR_DEAL_CRYR", "FTR_DEAL_RTE"]
    return {**tables, **{name: tables[name].filter(may_hold(words, DEAL)) for name in parts}}


def restrict(rows: DataFrame, topics: DataFrame, null_keys: bool = False) -> DataFrame:
    """Rows whose route (and week) is among ``topics``."""
    if null_keys:
        return null_safe_join(rows, topics, topics.columns, "left_semi")
    return rows.join(topics, topics.columns, "left_semi")


def stats_raw_carrier_set(tables: Tables, deals: DataFrame | None = None) -> DataFrame:
    """Selling deals with their routes and week lines, carriers as one sorted set.

    ``deals`` keeps only the deal versions it lists, such as those with a
    changed row in some table; they are joined with the current tables.
    """
    headers = tables["FTR_DEAL"].filter(F.col("OFER_TP_CD") == SELL)
    if deals is not None:
        tables = of_deals(tables, deals)
        headers = headers.join(deals, DEAL, "left_semi")
    amounts = ["DEAL_AMT", "DEAL_PRCE", "DEAL_QTY", "OFER_PRCE", "OFER_QTY", "OFER_REMN_QTY"]
    names = carrier_names(tables["MDM_CRYR"])
    return (
        headers.select(*DEAL, "DEAL_DT", "OFER_TP_CD")
        .distinct()
        .join(week_lines(tables["FTR_DEAL_LINE_ITEM"], DEAL, amounts), DEAL, "left")
        .join(deal_routes(tables["FTR_DEAL_RTE"]), DEAL, "left")
        .join(carrier_sets(tables["FTR_DEAL_CRYR"], names, DEAL), DEAL, "left")
        .select(*DEAL, "BSE_YW", "DEAL_DT", "OFER_TP_CD", "carrierItem", *ROUTE, *amounts)
    )


def offer_raw(tables: Tables) -> DataFrame:
    """Offer-side fact: offer version x week x route, carriers as a set with its size."""
    amounts = ["DEAL_AMT", "DEAL_PRCE", "DEAL_QTY", "OFER_PRCE", "OFER_QTY", "OFER_REMN_QTY"]
    return (
        offer_headers(tables["FTR_OFER"])
        .join(offer_carriers(tables), OFFER, "left")
        .join(named_routes(offer_routes(tables["FTR_OFER_RTE"]), tables["MDM_PORT"]), OFFER, "left")
        .join(week_lines(tables["FTR_OFER_LINE_ITEM"], OFFER, amounts), OFFER, "left")
        .select(
            *OFFER, "BSE_YW", "OFER_TP_CD", "EMP_NR", "ALL_YN", "carrierCount", "carrierItem",
            *ROUTE, "polName", "podName", *amounts,
        )
    )


def deal_headers(deals: DataFrame, *more: str) -> DataFrame:
    return deals.filter(F.col("OFER_TP_CD") == SELL).select(
        *DEAL,
        "DEAL_DT",
        F.col("TRDE_MKT_TP_CD").alias("marketTypeCode"),
        F.col("OFER_RD_TRM_CD").alias("rdTermCode"),
        F.col("OFER_PYMT_TRM_CD").alias("paymentTermCode"),
        F.col("OFER_TP_CD").alias("offerTypeCode"),
        *more,
    )


def deal_lines(lines: DataFrame, *more: str) -> DataFrame:
    return lines.select(
        *DEAL,
        F.col("BSE_YW").alias("baseYearWeek"),
        F.col("DEAL_AMT").alias("dealAmt"),
        F.col("DEAL_PRCE").alias("dealPrice"),
        F.col("DEAL_QTY").alias("dealQty"),
        *more,
    )


def deal_routes(routes: DataFrame) -> DataFrame:
    return route_pairs(routes, DEAL, "OFFER_REG_SEQ")


def offer_routes(routes: DataFrame, loaded_only: bool = False) -> DataFrame:
    return route_pairs(routes, OFFER, "OFER_REG_SEQ", loaded_only)


def route_pairs(
    routes: DataFrame, version: list[str], registration: str, loaded_only: bool = False, flag: str | None = None
) -> DataFrame:
    """Pivot typed location rows into ``polCode``/``podCode`` rows.

    One aggregate replaces two self-joins.  A registration names a port of
    loading and one of discharge; should it list several, each pairs with
    each, and a missing end stays null, as the joins would have it.
    ``loaded_only`` starts from the ports of loading, so a registration
    without one gives no row.  ``flag`` names a condition; each row then tells
    whether any row of its version meets it.
    """
    unfold = F.explode if loaded_only else F.explode_outer
    kept = [flag] if flag else []
    versions, registrations = _registered(routes, version, registration, kept)

    def places(kind: str, listed: Column) -> Column:
        def belongs(e: Column) -> Column:
            return e.registration.eqNullSafe(F.col("registered.of")) & (e.type == kind) & listed

        return F.transform(F.filter("entries", belongs), lambda e: e.place)

    registered = F.col("registered.of").isNotNull()
    return (
        versions.select(*version, *kept, "entries", F.explode(registrations).alias("registered"))
        .select(
            *version,
            *kept,
            places(LOADING, F.lit(True) if loaded_only else registered).alias("pols"),
            places(DISCHARGE, registered).alias("pods"),
        )
        .select(*version, *kept, "pods", unfold("pols").alias("pol"))
        .select(*version, *kept, "pol", F.explode_outer("pods").alias("pod"))
        .select(*version, *kept, F.col("pol.code").alias("polCode"), F.col("pod.code").alias("podCode"))
    )


def _registered(routes: DataFrame, version: list[str], registration: str, kept: list[str]) -> tuple[DataFrame, Column]:
    """Location rows of each version as ``entries``, and its distinct registrations."""
    # Inside a struct a null code still counts as a row of its type.
    entry = F.struct(
        F.col(registration).alias("registration"),
        F.col("TRDE_LOC_TP_CD").alias("type"),
        F.struct(F.col("TRDE_LOC_CD").alias("code")).alias("place"),
    )
    # Grouped by version alone, the rows stay in place for the join on the version that follows.
    versions = routes.groupBy(*version).agg(
        F.collect_list(entry).alias("entries"), *[F.max(name).alias(name) for name in kept]
    )
    return versions, F.array_distinct(F.transform("entries", lambda e: F.struct(e.registration.alias("of"))))


def route_lists(routes: DataFrame, version: list[str], registration: str, flag: str | None = None) -> DataFrame:
    """``route_pairs`` with a row per version, its pairs as the array ``routes``."""
    kept = [flag] if flag else []
    versions, registrations = _registered(routes, version, registration, kept)

    def codes(kind: str, registered: Column) -> Column:
        def belongs(e: Column) -> Column:
            return e.registration.eqNullSafe(registered["of"]) & (e.type == kind) & registered["of"].isNotNull()

        found = F.transform(F.filter("entries", belongs), lambda e: e["place"]["code"])
        return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(None).cast("string")))

    def pairs(registered: Column) -> Column:
        def with_pods(pol: Column) -> Column:
            return F.transform(codes(DISCHARGE, registered), lambda pod: F.struct(pol.alias("polCode"), pod.alias("podCode")))

        return F.flatten(F.transform(codes(LOADING, registered), with_pods))

    return versions.select(*version, *kept, F.flatten(F.transform(registrations, pairs)).alias("routes"))


def named_routes(pairs: DataFrame, ports: DataFrame) -> DataFrame:
    """Add port names to both ends of the routes."""
    for end in ("pol", "pod"):
        names = ports.select(
            F.col("locCd").alias(f"{end}Code"), F.col("locNm").alias(f"{end}Name")
        )
        pairs = pairs.join(sized(names), f"{end}Code", "left")
    return pairs


def week_lines(lines: DataFrame, version: list[str], amounts: list[str]) -> DataFrame:
    """Distinct week lines; a line without a week carries no amounts."""
    dated = F.col("BSE_YW").isNotNull()
    return lines.select(
        *version, "BSE_YW", *[F.when(dated, F.col(name)).alias(name) for name in amounts]
    ).distinct()


def carrier_names(master: DataFrame) -> DataFrame:
    """Code and name of each carrier; joins send a small master to every task and shuffle a large one."""
    return master.select(
        F.col("CRYR_CD").alias("carrierCode"), F.col("CRYR_NM").alias("carrierName")
    )


def deal_carriers(tables: Tables, mdm_cryr: DataFrame | None = None, *more: str) -> DataFrame:
    names = carrier_names(tables["MDM_CRYR"]) if "MDM_CRYR" in tables else mdm_cryr
    return (
        tables["FTR_DEAL_CRYR"]
        .select(*DEAL, F.col("OFER_CRYR_CD").alias("carrierCode"), *more)
        .join(sized(names), "carrierCode", "left")
    )


def _carrier_counts(tables: Tables, mdm_cryr: DataFrame | None, *flags: str) -> DataFrame:
    return (
        deal_carriers(tables, mdm_cryr, *flags)
        .groupBy(*DEAL)
        .agg(
            F.count(F.lit(1)).alias("carrierRows"),
            (
                F.count_distinct("carrierName")
                + F.max(F.when(F.col("carrierName").isNull(), 1).otherwise(0))
            ).alias("carrierNames"),
            *[F.max(flag).alias(flag) for flag in flags],
        )
    )


def carrier_sets(carriers: DataFrame, names: DataFrame, version: list[str]) -> DataFrame:
    """Carriers of a version as ``carrierItem``, with ``carrierCount`` distinct codes."""
    items = F.sort_array(F.collect_set(F.struct("carrierCode", "carrierName")))
    codes = F.array_compact(F.array_distinct(F.transform("carrierItem", lambda c: c.carrierCode)))
    return (
        carriers.select(*version, F.col("OFER_CRYR_CD").alias("carrierCode"))
        .join(sized(names), "carrierCode", "left")
        .groupBy(*version)
        .agg(items.alias("carrierItem"))
        .withColumn("carrierCount", F.size(codes).cast("long"))
    )


def offer_headers(offers: DataFrame) -> DataFrame:
    return offers.select(*OFFER, "OFER_TP_CD", "EMP_NR", "ALL_YN").distinct()


def offer_carriers(tables: Tables) -> DataFrame:
    return carrier_sets(tables["FTR_OFER_CRYR"], carrier_names(tables["MDM_CRYR"]), OFFER)
