"""Offer dashboards: a full build, and refreshes for some users or offers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelane.operators import bidask, events, fact, offers
from tidelane.operators.fact import Tables
from tidelane.operators.offers import USER, restricted
from tidelane.sources.sinks import append, overwrite, replace_keyed, write_keyed

OFFER_KEY = ["offerNumber"]


def write_offer_raw(tables: Tables, root: str, add: bool = False) -> None:
    """Hand the offer fact over as parquet; ``add`` appends the rows of new versions."""
    (append if add else overwrite)(fact.offer_raw(tables), f"{root}/OFFER_RAW")


def by_user(tables: Tables, current_week: str) -> dict[str, DataFrame]:
    return {
        "OFFER_SUM": offers.offer_summary(tables, current_week),
        "OFFER_WKLIST": offers.offer_week_list(tables),
        "OFFER_RTELIST": offers.offer_route_list(tables),
    }


def by_offer(tables: Tables, current_week: str) -> dict[str, DataFrame]:
    return {
        "OFFER_WKDETAIL": offers.offer_week_detail(tables),
        "OFFER_EVNTLOG": events.offer_event_log(tables, current_week),
    }


def full_build(tables: Tables, root: str, current_week: str, buckets: int) -> None:
    for name, frame in by_user(tables, current_week).items():
        write_keyed(frame, f"{root}/{name}", USER[:1], buckets)
    for name, frame in by_offer(tables, current_week).items():
        write_keyed(frame, f"{root}/{name}", OFFER_KEY, buckets)
    overwrite(bidask.mw_bidask(tables), f"{root}/MW_BIDASK")


def refresh_users(
    spark: SparkSession,
    tables: Tables,
    users: DataFrame,
    root: str,
    current_week: str,
    buckets: int,
) -> None:
    """Recompute and replace the documents of ``users`` (``EMP_NR``)."""
    replaced = users.withColumnRenamed("EMP_NR", "userId").select("userId").distinct()
    for name, frame in by_user(restricted(tables, users=users), current_week).items():
        wanted = frame.join(replaced, "userId", "left_semi")
        replace_keyed(spark, f"{root}/{name}", wanted, replaced, buckets)


def refresh_offers(
    spark: SparkSession,
    tables: Tables,
    numbers: DataFrame,
    root: str,
    current_week: str,
    buckets: int,
) -> None:
    """Recompute and replace the documents of some offers (``OFER_NR``)."""
    replaced = numbers.withColumnRenamed("OFER_NR", "offerNumber").select("offerNumber").distinct()
    for name, frame in by_offer(restricted(tables, offers=numbers), current_week).items():
        replace_keyed(spark, f"{root}/{name}", frame, replaced, buckets)
