"""Ranges of an id, by exact bounds, so that neighbours in the order of ids can meet in one task."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F


def bounds_of(frame: DataFrame, column: str, ranges: int) -> tuple[list[int], int | None, bool]:
    """Ids that cut the table into about equal ranges, the least id, and whether an id is missing."""
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    row = frame.agg(
        F.percentile_approx(column, shares, 20 * ranges).alias("cuts"),
        F.min(column).alias("least"),
        F.coalesce(F.bool_or(F.col(column).isNull()), F.lit(False)).alias("missing"),
    ).first()
    cuts = sorted({x for x in row.cuts or [] if x > row.least}) if ranges > 1 else []
    return cuts, row.least, row.missing


def range_of(value: Column, cuts: list[int]) -> Column:
    """How many ``cuts`` are at most ``value``, in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = isqrt(len(cuts)) + 1
    tops = F.lit(cuts[::step])
    groups = F.array(*[F.lit(cuts[i : i + step]) for i in range(0, len(cuts), step)])
    top = F.size(F.filter(tops, lambda x: x <= value))
    within = F.size(F.filter(F.get(groups, top - 1), lambda x: x <= value))
    return F.when(top == 0, 0).otherwise((top - 1) * step + within)


def with_next(frame: DataFrame, id_col: str, column: str, into: str, ranges: int) -> DataFrame:
    """Adds ``column`` of the row with the next id (nulls first, ties by ``column``); the last row gets the first's.

    Rows are dealt by range of id. The first row of a range is dealt to the range before, too, and
    the first row of all to the last range, where they only serve as the next row.
    """
    cuts, least, missing = bounds_of(frame.select(id_col), id_col, ranges)
    own = range_of(F.col(id_col), cuts)
    first = F.col(id_col).isNull() if missing else F.col(id_col) == F.lit(least)
    starts = F.coalesce(F.array_contains(F.lit(cuts), F.col(id_col)), F.lit(False)) if cuts else F.lit(False)
    place = lambda at, wrap, guest: F.struct(at.alias("at"), F.lit(wrap).alias("wrap"), F.lit(guest).alias("guest"))
    places = F.concat(
        F.array(place(own, 0, False)),
        F.when(starts, F.array(place(own - 1, 0, True))).otherwise(F.array()),
        F.when(first, F.array(place(F.lit(len(cuts)), 1, True))).otherwise(F.array()),
    )
    order = Window.partitionBy("_at").orderBy("_wrap", F.col(id_col).asc_nulls_first(), F.col(column).asc_nulls_first())
    return (
        frame.withColumn("_places", F.explode(places))
        .select("*", F.col("_places.at").alias("_at"), F.col("_places.wrap").alias("_wrap"), F.col("_places.guest").alias("_guest"))
        .withColumn(into, F.lead(column).over(order))
        .filter(~F.col("_guest"))
        .drop("_places", "_at", "_wrap", "_guest")
    )
