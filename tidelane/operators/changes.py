"""Incremental layer: high-water marks, changed rows, touched keys, keyed replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelane.functions.values import null_safe_join
from tidelane.operators import market
from tidelane.operators.fact import DEAL, ROUTE, ROUTE_WEEK, Tables, flagged_fact, trade_fact

# The tables whose growth triggers an update.
WATCHED = [
    "FTR_DEAL",
    "FTR_DEAL_LINE_ITEM",
    "FTR_DEAL_CRYR",
    "FTR_DEAL_RTE",
    "FTR_DEAL_RSLT",
]
# The watched tables that feed the fact.
FEEDING = WATCHED[:4]


def max_id(tables: Tables, names: list[str] = WATCHED) -> DataFrame:
    """Highest ``ID`` per table, as one frame: ``tableName``, ``maxId``."""
    marks = [
        tables[name].agg(F.max("ID").cast("long").alias("maxId"))
        .select(F.lit(name).alias("tableName"), "maxId")
        for name in names
    ]
    return reduce(DataFrame.unionByName, marks)


def lag_behind(source: DataFrame, processed: DataFrame) -> DataFrame:
    """Source mark beside processed mark per table, and whether the table advanced."""
    done = processed.select("tableName", F.col("maxId").alias("processedId"))
    return source.join(done, "tableName", "left").select(
        "tableName",
        "maxId",
        "processedId",
        F.coalesce(F.col("maxId") > F.col("processedId"), F.col("maxId").isNotNull()).alias("advanced"),
    )


def gate(lag: DataFrame, require_all: bool = False, watched: int = len(WATCHED)) -> DataFrame:
    """One row: how many tables advanced, and whether an update should run."""
    needed = watched if require_all else 1
    return lag.agg(F.count_if("advanced").alias("advancedTables")).withColumn(
        "fire", F.col("advancedTables") >= needed
    )


def delta(tables: Tables, processed: DataFrame, names: list[str] = FEEDING) -> dict[str, DataFrame]:
    """Rows of each table above its processed mark."""
    return {name: tables[name].filter(above) for name, above in above_marks(processed, names).items()}


def above_marks(processed: DataFrame, names: list[str] = FEEDING) -> dict[str, Column]:
    """Per table, whether a row's ``ID`` is above its processed mark."""

    def above(name: str) -> Column:
        mark = processed.filter(F.col("tableName") == name).select("maxId").scalar()
        return F.col("ID").isNotNull() & (mark.isNull() | (F.col("ID") > mark))

    return {name: above(name) for name in names}


def fact_with_changes(
    tables: Tables, processed: DataFrame, mdm_cryr: DataFrame | None = None, folded: bool = False
) -> DataFrame:
    """The whole fact, each row telling whether its deal has ``changed`` since the marks; one pass over each table."""
    return flagged_fact(tables, above_marks(processed), mdm_cryr, folded)


def next_marks(lag: DataFrame) -> DataFrame:
    """Marks after an update: they only ever move up."""
    return lag.select("tableName", F.greatest("maxId", "processedId").alias("maxId"))


def changed_deals(changed: Tables) -> DataFrame:
    """Deal versions with a changed row in any feeding table."""
    keys = [changed[name].select(*DEAL) for name in FEEDING if name in changed]
    return reduce(DataFrame.unionByName, keys).distinct()


def delta_fact(tables: Tables, changed: Tables, mdm_cryr: DataFrame | None = None) -> DataFrame:
    """Fact of the changed deals, joined with the current tables.

    Resolving changed rows to deals first means that a new line of an old deal
    finds its parent.
    """
    return trade_fact(tables, mdm_cryr, deals=changed_deals(changed))


def route_topics(fact: DataFrame) -> DataFrame:
    """Routes touched by ``fact``."""
    return fact.select(*ROUTE).distinct()


def week_topics(fact: DataFrame) -> DataFrame:
    """Routes and weeks touched by ``fact``."""
    return fact.select(*ROUTE_WEEK).distinct()


def update_metrics(changed_deal_rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Counts of one update: new deals, fact rows, touched keys."""
    intervals = 3
    deals = changed_deal_rows.agg(F.count_distinct("DEAL_NR").alias("newDeals"))
    weeks = fact.groupBy(*ROUTE_WEEK).agg(F.sum("carrierRows").alias("rows"))
    found = weeks.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("updatedRows"),
        # A route with a missing port is one, too.
        F.count_distinct(F.struct(*ROUTE)).alias("marketWatchTopics"),
        (F.count(F.lit(1)) * intervals).alias("weekDetailTopics"),
        F.count(F.lit(1)).alias("dealHistoryTopics"),
    )
    return _listed(deals).unionByName(_listed(found))


def _listed(counts: DataFrame) -> DataFrame:
    """One row of counts as rows ``metric``, ``n``."""
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("n")) for name in counts.columns])
    return counts.select(F.inline(pairs))


def mw_sum_incr(tables: Tables, topics: DataFrame, current_week: str) -> DataFrame:
    """Weekly summary of the touched routes, from the current tables."""
    return market.mw_sum(trade_fact(tables, topics=topics, null_keys=True), current_week)


def mw_hst_incr(tables: Tables, topics: DataFrame) -> DataFrame:
    """Deal history of the touched routes and weeks, from the current tables."""
    return market.mw_hst(trade_fact(tables, topics=topics, null_keys=True))


def mw_wkdetail_incr(tables: Tables, topics: DataFrame) -> DataFrame:
    """Resampled OHLC of the touched routes and weeks, from the current tables."""
    return market.mw_wkdetail(trade_fact(tables, topics=topics, null_keys=True))


def upsert_by_key(
    stored: DataFrame, fresh: DataFrame, replaced: DataFrame, null_keys: bool = False
) -> DataFrame:
    """``stored`` without the keys in ``replaced``, plus ``fresh``.

    The keys are the columns of ``replaced``.  They match exactly and as a
    whole, so a week that was not touched stays.  With ``null_keys`` a null
    key replaces a null key.
    """
    keys = replaced.columns
    if null_keys:
        kept = null_safe_join(stored, replaced, keys, "left_anti")
    else:
        kept = stored.join(replaced, keys, "left_anti")
    return kept.unionByName(fresh)
