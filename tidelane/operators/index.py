"""Market-index series and the catalogue of what can be charted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidelane.functions.calendar import (
    MONTH_END_SUFFIX,
    YEAR_END_SUFFIX,
    chart_week,
    interval_table,
    week_closing,
)
from tidelane.functions.values import mean, null_safe_join, ratio
from tidelane.operators.nest import nest

SERIES = ["idxSubject", "idxCategory", "idxCd", "idxNm"]
BUCKET = [*SERIES, "interval", "xAxis"]
# Rows of one look-back.
LOOK_BACK = ["idxNm", "interval"]
INDEX_CELL = ["xAxis", "intervalTimestamp", "value", "changeValue", "changeRate", "volume"]

# The catalogue entry of the week-detail charts.
WEEK_DETAIL_ENTRY = {
    "idxSubject": "marketWatch",
    "idxCategory": "weekDetail",
    "idxCd": "MWWD",
    "idxNm": "market watch weekdetail frequencies",
}


def mi_sum_rows(quotes: DataFrame, chronological: bool = False) -> DataFrame:
    """Average of each index per week, month and year, with its change.

    Equal values of a series within a week count once.  Weekly labels are
    unpadded, and by default the previous bucket is the one before in *label*
    order (``202010`` before ``20202``); ``chronological`` goes by time.
    """
    return _shown(bucket_means(quotes), chronological)


def bucket_means(quotes: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``value`` of each index, interval and ``xAxis``; ``only`` lists the buckets that are wanted."""
    exploded = _labelled(quotes).select(*SERIES, "value", F.explode(_buckets()).alias("bucket")).select(*SERIES, "value", "bucket.*")
    if only is not None:
        exploded = null_safe_join(exploded, only, BUCKET, "left_semi")
    return exploded.groupBy(*BUCKET).agg(mean(F.col("value")).alias("value"))


def touched_buckets(quotes: DataFrame) -> DataFrame:
    """Buckets that ``quotes`` fall into."""
    return _labelled(quotes).select(*SERIES, F.explode(_buckets()).alias("bucket")).select(*SERIES, "bucket.*").distinct()


def mi_sum_updated(stored: DataFrame, quotes: DataFrame, new: DataFrame, chronological: bool = False) -> DataFrame:
    """``mi_sum_rows`` of ``quotes``, for the series (``LOOK_BACK``) that the ``new`` ones among them touch.

    ``stored`` are the rows of those series without the new quotes (others are left out). Only
    touched buckets are averaged again, and only they and their successors get a new change; all
    other rows stay as they are.
    """
    touched = touched_buckets(new)
    series = touched.select(*LOOK_BACK).distinct()
    kept = null_safe_join(null_safe_join(stored, series, LOOK_BACK, "left_semi"), touched, BUCKET, "left_anti")
    fresh = bucket_means(quotes, touched).withColumn("fresh", F.lit(True))
    rows = kept.withColumn("fresh", F.lit(False)).unionByName(fresh, allowMissingColumns=True)
    along = _along(chronological)
    # A stored row knows its change still fits unless the row before it is new.
    stale = F.col("fresh") | F.lag("fresh", 1, False).over(along)
    change = F.col("value") - F.lag("value", 1, 0.0).over(along)
    marked = rows.withColumns({"stale": stale, "change": change})
    found = marked.withColumn("changeValue", F.when(F.col("stale"), F.col("change")).otherwise(F.col("changeValue")))
    return _finished(found)


def _labelled(quotes: DataFrame) -> DataFrame:
    year, month = F.year("date"), F.month("date")
    return quotes.select(
        *SERIES,
        "value",
        year.cast("string").alias("yearly"),
        (year * 100 + month).cast("string").alias("monthly"),
        chart_week(F.col("date")).alias("weekly"),
    ).distinct()


def _buckets() -> Column:
    return F.array(
        *[
            F.struct(F.lit(interval).alias("interval"), F.col(interval).alias("xAxis"))
            for interval in ("weekly", "monthly", "yearly")
        ]
    )


def _along(chronological: bool) -> WindowSpec:
    """Order of a series: few rows, one per calendar bucket."""
    if chronological:
        position = [F.substring("xAxis", 1, 4), F.substring("xAxis", 5, 2).try_cast("int")]
    else:
        position = [F.col("xAxis")]
    return Window.partitionBy(*LOOK_BACK).orderBy(*position, *SERIES[:3])


def _shown(averaged: DataFrame, chronological: bool) -> DataFrame:
    previous = F.lag("value", 1, 0.0).over(_along(chronological))
    return _finished(averaged.withColumn("changeValue", F.col("value") - previous))


def _finished(rows: DataFrame) -> DataFrame:
    ends = (
        F.when(F.col("interval") == "weekly", week_closing(F.col("xAxis")))
        .when(F.col("interval") == "monthly", F.concat("xAxis", F.lit(MONTH_END_SUFFIX)))
        .otherwise(F.concat("xAxis", F.lit(YEAR_END_SUFFIX)))
    )
    return (
        rows.withColumn("changeRate", ratio(F.col("changeValue"), F.col("value")))
        .withColumn("intervalTimestamp", ends)
        .withColumn("volume", F.lit(0.0))
        .select(*SERIES, "interval", *INDEX_CELL)
    )


def mi_sum(quotes: DataFrame, chronological: bool = False) -> DataFrame:
    """Documents of ``mi_sum_rows``: one per index and interval."""
    return nest(mi_sum_rows(quotes, chronological), [*SERIES, "interval"], INDEX_CELL)


def idx_lst(indices: DataFrame, week_detail: DataFrame) -> DataFrame:
    """Intervals available per index, and one entry for the week-detail charts."""
    offered = indices.select(*SERIES, "interval").distinct()
    charted = (
        week_detail.select("interval")
        .distinct()
        .select(*[F.lit(text).alias(name) for name, text in WEEK_DETAIL_ENTRY.items()], "interval")
    )
    # The vocabulary has 13 rows, whatever the data.
    vocabulary = F.broadcast(interval_table(indices.sparkSession))
    listed = offered.unionByName(charted).join(vocabulary, "interval", "left")
    return nest(listed, SERIES, ["intervalSeq", "interval"], "intervalItem")
