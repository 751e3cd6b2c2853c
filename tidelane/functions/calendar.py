"""Week codes, closing times and the calendar tables.

Two week systems live side by side: the trade calendar numbers the Saturdays
of a year (``us_week``), the chart labels use ISO week numbers.  Everything
here is a column expression, so no calendar join is needed to look one up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Time-of-day suffixes that turn a date prefix into a 20-digit time.
CLOSING_SUFFIX = "010000000000"
MONTH_END_SUFFIX = "20010000000000"
YEAR_END_SUFFIX = "1220010000000000"

# Chart interval vocabulary, by sequence number.
INTERVALS = [
    (1, "tick"),
    (2, "secondly"),
    (3, "10sec"),
    (4, "30sec"),
    (5, "minutely"),
    (6, "5min"),
    (7, "10min"),
    (8, "30min"),
    (9, "hourly"),
    (10, "daily"),
    (11, "weekly"),
    (12, "monthly"),
    (13, "yearly"),
]


def saturday_of(day: Column) -> Column:
    """The Saturday that ends the Sunday-to-Saturday week of ``day``."""
    return F.date_add(day, 7 - F.dayofweek(day))


def week_of_saturday(saturday: Column) -> Column:
    """Number of a Saturday within its year, from 1."""
    return F.floor((F.dayofyear(saturday) + 6) / 7).cast("int")


def us_week(day: Column) -> Column:
    """Trade week ``yyyyWW`` of a date, as a string."""
    saturday = saturday_of(day)
    return (F.year(saturday) * 100 + week_of_saturday(saturday)).cast("string")


def current_week() -> Column:
    """Trade week of today; jobs take the week as an argument instead."""
    return us_week(F.current_date())


def iso_week(day: Column) -> Column:
    """ISO week ``yyyyWW`` of a date, as a string."""
    return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("string")


def chart_week(day: Column) -> Column:
    """Weekly chart label: calendar year followed by the unpadded ISO week."""
    return F.concat(F.year(day).cast("string"), F.weekofyear(day).cast("string"))


def digits(day: Column) -> Column:
    """``yyyyMMdd`` of a date, without going through a timestamp formatter."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("string")


def day_of(time_text: Column) -> Column:
    """Date of a 20-digit time string; null when the prefix is no date."""
    return F.try_to_date(F.substring(time_text, 1, 8), "yyyyMMdd")


def week_closing(code: Column) -> Column:
    """Closing time of the trade week ``code`` (``yyyyWW`` or ``yyyyW``).

    Null when the year has no such week, as for a code missing from a calendar
    table.
    """
    # Four signs that are a number from 1000 on are four digits; reckoned without a date parser.
    year = F.substring(code, 1, 4).try_cast("int")
    number = F.substring(code, 5, 2).try_cast("int")
    first = F.make_date(F.when(year >= 1000, year), F.lit(1), F.lit(1))
    saturday = F.date_add(saturday_of(first), (number - 1) * 7)
    known = (number >= 1) & (F.year(saturday) == year)
    return F.when(known, F.concat(digits(saturday), F.lit(CLOSING_SUFFIX)))


def week_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Calendar of trade weeks: ``idx``, ``BSE_YW``, ``yyyymmdd``, ``week2``."""
    saturday = F.col("saturday")
    number = week_of_saturday(saturday)
    return (
        _days(spark, first_year, last_year, "saturday")
        .filter(F.dayofweek(saturday) == 7)
        .select(
            (F.floor(F.datediff(saturday, _new_year(first_year)) / 7) + 1).cast("int").alias("idx"),
            us_week(saturday).alias("BSE_YW"),
            digits(saturday).alias("yyyymmdd"),
            F.concat(F.year(saturday).cast("string"), number.cast("string")).alias("week2"),
        )
    )


def day_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Calendar of days: ``idx``, ``day``."""
    return _days(spark, first_year, last_year, "d").select(
        (F.datediff("d", _new_year(first_year)) + 1).alias("idx"), digits(F.col("d")).alias("day")
    )


def month_table(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Calendar of months: ``idx``, ``month``."""
    return (
        _days(spark, first_year, last_year, "d")
        .filter(F.dayofmonth("d") == 1)
        .select(
            ((F.year("d") - first_year) * 12 + F.month("d")).alias("idx"),
            F.substring(digits(F.col("d")), 1, 6).alias("month"),
        )
    )


def interval_table(spark: SparkSession) -> DataFrame:
    """The 13 chart intervals: ``intervalSeq``, ``interval``."""
    return spark.createDataFrame(INTERVALS, "intervalSeq int not null, interval string not null")


def _new_year(year: int) -> Column:
    return F.make_date(F.lit(year), F.lit(1), F.lit(1))


def _days(spark: SparkSession, first_year: int, last_year: int, name: str) -> DataFrame:
    last = F.date_sub(_new_year(last_year + 1), 1)
    return spark.range(1).select(F.explode(F.sequence(_new_year(first_year), last)).alias(name))
