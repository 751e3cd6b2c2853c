"""Market-watch runs: a full build, and a round that updates what changed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidelane.operators import changes, market
from tidelane.operators.fact import DEAL, ROUTE, ROUTE_WEEK, Tables, restrict, trade_fact
from tidelane.plans.session import workspace
from tidelane.sources.outbox import NumberedSender, deliver, enqueue, forget
from tidelane.sources.sinks import (
    BUCKETS,
    overwrite,
    read_keyed,
    replace_keyed,
    state_of,
    write_keyed,
)

TOPIC = "/topic/marketWatch"
DOCUMENTS = ["MW_SUM", "MW_HST", "MW_WKDETAIL"]


@dataclass(frozen=True)
class Store:
    """Result collections and marks under one root folder."""

    root: str
    buckets: int = BUCKETS

    # Collection names with the columns they are replaced by.
    keys = {"MW_SUM": ROUTE, "MW_HST": ROUTE_WEEK, "MW_WKDETAIL": ROUTE_WEEK, "FACT": ROUTE, "DEAL_KEYS": DEAL}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_keyed(spark, self.path(name))


def documents(fact: DataFrame, current_week: str) -> dict[str, DataFrame]:
    return {
        "MW_SUM": market.mw_sum(fact, current_week),
        "MW_HST": market.mw_hst(fact),
        "MW_WKDETAIL": market.mw_wkdetail(fact),
    }


def full_build(
    spark: SparkSession, tables: Tables, store: Store, current_week: str
) -> None:
    """Build all collections from all deals, and set the marks.

    The marks are read first: a row that arrives meanwhile is at worst
    processed again.  The fact is stored by route, and the three jobs read it
    from there; the keys of each deal's rows are stored by deal.
    """
    marks = _fixed(spark, changes.max_id(tables))
    write_keyed(trade_fact(tables), store.path("FACT"), ROUTE, store.buckets)
    fact = store.read(spark, "FACT")
    for name, frame in documents(fact, current_week).items():
        write_keyed(frame, store.path(name), Store.keys[name], store.buckets)
    write_keyed(fact.select(*DEAL, *ROUTE_WEEK).distinct(), store.path("DEAL_KEYS"), DEAL, store.buckets)
    overwrite(marks, store.path("marks"))


def update_round(
    spark: SparkSession,
    tables: Tables,
    store: Store,
    current_week: str,
    require_all: bool = False,
    send: NumberedSender | None = None,
) -> bool:
    """Process the rows above the marks; false when there was nothing to do.

    The marks move last, and every step before can be repeated, so a round
    that fails is simply run again. Its messages are numbered by the marks it
    starts and ends at, and those that were sent are not sent again.
    """
    lag = _fixed(spark, changes.lag_behind(changes.max_id(tables), read_marks(spark, store)))
    if not changes.gate(lag, require_all).first().fire:
        return False
    processed = lag.select("tableName", F.col("processedId").alias("maxId"))
    changed = changes.delta(tables, processed)
    marks = [(r.processedId, r.maxId) for r in lag.orderBy("tableName").collect()]
    batch = "round-" + "-".join(f"{'' if a is None else a}.{'' if b is None else b}" for a, b in marks)
    update_deals(spark, tables, changes.changed_deals(changed), store, current_week, send, batch)
    overwrite(changes.next_marks(lag), store.path("marks"))
    if send is not None:
        forget_messages(spark, store, batch)
    return True


def update_deals(
    spark: SparkSession,
    tables: Tables,
    deals: DataFrame,
    store: Store,
    current_week: str,
    send: NumberedSender | None = None,
    batch: str = "",
) -> None:
    """Recompute, replace and publish every document that ``deals`` touch.

    Only the rows of ``deals`` are joined from the tables. All others come from
    the stored fact, of which only the buckets of touched routes are read: those
    that the deals are on now and those that they were on before. What tells the
    latter is replaced last, so a run that dies is repeated with the same keys.
    ``batch`` names the run's messages; a run repeated under the same name sends
    only those that were not sent.
    """
    with workspace(spark, "round") as kept:
        deals = kept(deals.select(*DEAL).distinct(), "deals")
        new = kept(trade_fact(tables, deals=deals), "new")
        now = kept(new.select(*DEAL, *ROUTE_WEEK).distinct(), "keys")
        before = _stored(spark, store, "DEAL_KEYS", deals, now)
        weeks = kept(now.unionByName(before).select(*ROUTE_WEEK).distinct(), "weeks")
        routes = weeks.select(*ROUTE).distinct()
        unchanged = _stored(spark, store, "FACT", routes, new).join(deals, DEAL, "left_anti")
        touched = kept(unchanged.unionByName(new), "touched")
        in_weeks = restrict(touched, weeks, null_keys=True)
        fresh = {
            "MW_SUM": (market.mw_sum(touched, current_week), routes),
            "MW_HST": (market.mw_hst(in_weeks), weeks),
            "MW_WKDETAIL": (market.mw_wkdetail(in_weeks), weeks),
        }
        for name, (frame, replaced) in fresh.items():
            replace_keyed(spark, store.path(name), frame, replaced, store.buckets)
            if send is not None:
                plain = [f.name for f in frame.schema if f.dataType.typeName() != "array"]
                enqueue(frame, store.path("outbox"), f"{batch}-{name}", TOPIC, plain)
                deliver(spark, store.path("outbox"), f"{batch}-{name}", send)
        replace_keyed(spark, store.path("FACT"), touched, routes, store.buckets)
        replace_keyed(spark, store.path("DEAL_KEYS"), now, deals, store.buckets)


def forget_messages(spark: SparkSession, store: Store, batch: str) -> None:
    """Delete the messages of a run that will not be repeated."""
    for name in DOCUMENTS:
        forget(spark, store.path("outbox"), f"{batch}-{name}")


def _stored(spark: SparkSession, store: Store, name: str, keys: DataFrame, like: DataFrame) -> DataFrame:
    """Stored rows of some keys; none, with the columns of ``like``, where nothing is stored yet."""
    if state_of(spark, store.path(name)) is None:
        return like.limit(0)
    return read_keyed(spark, store.path(name), keys)


def read_marks(spark: SparkSession, store: Store) -> DataFrame:
    """Processed marks, or none yet."""
    try:
        return _fixed(spark, spark.read.parquet(store.path("marks")))
    except AnalysisException:
        return spark.createDataFrame([], "tableName string, maxId long")


def _fixed(spark: SparkSession, marks: DataFrame) -> DataFrame:
    """Marks held by value: one row per watched table."""
    return spark.createDataFrame(marks.collect(), marks.schema)
