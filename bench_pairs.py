"""Times some jobs against a plainer way of writing them, on the same tables.

Same environment variables as ``bench.py``.  Prints one JSON line with seconds
per variant; each pair is checked to give equally many rows.
"""

from __future__ import annotations

import json
import os
import time
from functools import reduce
from statistics import median

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidelane.functions.calendar import chart_week, day_of
from tidelane.operators import events, market
from tidelane.operators.fact import stats_raw, trade_fact
from tidelane.operators.market import TERMS
from tidelane.sources.bindings import deal_tables, offer_tables

WEEK = "199826"


def numbered_ohlc(deals: DataFrame, keys: list[str]) -> DataFrame:
    """First and last price by two row numbers in opposite order."""
    group = Window.partitionBy(*keys)
    flagged = deals.withColumns(
        {
            "up": F.row_number().over(group.orderBy("DEAL_DT")),
            "down": F.row_number().over(group.orderBy(F.desc("DEAL_DT"))),
        }
    )
    return flagged.groupBy(*keys).agg(
        F.max("dealPrice").alias("high"),
        F.min("dealPrice").alias("low"),
        F.sum("dealQty").alias("volume"),
        F.max("DEAL_DT").alias("latest"),
        F.max(F.when(F.col("up") == 1, F.col("dealPrice"))).alias("open"),
        F.max(F.when(F.col("down") == 1, F.col("dealPrice"))).alias("close"),
    )


def three_resamples(deals: DataFrame) -> DataFrame:
    """One pass over the deals per interval, put together by union."""
    labels: dict[str, Column] = {
        "daily": F.substring("DEAL_DT", 1, 8),
        "weekly": chart_week(day_of(F.col("DEAL_DT"))),
        "monthly": F.substring("DEAL_DT", 1, 6),
    }
    priced = deals.filter(F.col("dealPrice") != 0)
    keys = [*TERMS, "baseYearWeek"]
    passes = [
        market.with_change(
            numbered_ohlc(priced.withColumn("xAxis", label), [*keys, "xAxis"]),
            Window.partitionBy(*keys).orderBy("latest"),
            "close",
        ).withColumn("interval", F.lit(interval))
        for interval, label in labels.items()
    ]
    return reduce(DataFrame.unionByName, passes)


def five_event_passes(tables) -> DataFrame:
    """Each event code in a pass of its own."""
    passes = [events.event_rows(tables, WEEK, code) for code in events.EVENT_NAMES]
    return reduce(DataFrame.unionByName, passes)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench-pairs")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    deals, made_offers = deal_tables(spark, folder), offer_tables(spark, folder)
    whole = [*TERMS, "baseYearWeek"]
    pairs = {
        "weekly_ohlc": (
            lambda: numbered_ohlc(stats_raw(deals), whole),
            lambda: market.mw_sum_rows(trade_fact(deals), WEEK),
        ),
        "resample": (
            lambda: three_resamples(stats_raw(deals)),
            lambda: market.mw_wkdetail_rows(trade_fact(deals)),
        ),
        "history": (
            lambda: market.mw_hst_rows(stats_raw(deals)),
            lambda: market.mw_hst_rows(trade_fact(deals)),
        ),
        "events": (
            lambda: five_event_passes(made_offers),
            lambda: events.event_rows(made_offers, WEEK),
        ),
    }
    result = {}
    for name, variants in pairs.items():
        if len({variant().count() for variant in variants}) != 1:
            raise AssertionError(f"{name}: the variants differ in rows")
        plain, ours = (_timed(variant, runs) for variant in variants)
        result[name] = {"plain": plain, "ours": ours}
    spark.stop()
    print(json.dumps(result))


def _timed(variant, runs: int) -> float:
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        variant().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return round(median(times), 3)


if __name__ == "__main__":
    main()
