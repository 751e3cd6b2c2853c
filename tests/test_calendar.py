from datetime import date

from pyspark.sql import functions as F

from tests.frames import rows
from tidelane.functions import calendar
from tidelane.schemas import TABLES
from tidelane.sources.readers import read_csv


def test_week_codes(spark):
    days = spark.createDataFrame(
        [(date(2020, 1, 4),), (date(2020, 12, 30),), (date(2021, 1, 9),)], "d date"
    )
    d = F.col("d")
    coded = days.select("d", calendar.us_week(d), calendar.iso_week(d), calendar.chart_week(d))
    assert [tuple(r)[1:] for r in coded.orderBy("d").collect()] == [
        ("202001", "202001", "20201"),
        ("202101", "202053", "202053"),
        ("202102", "202101", "20211"),
    ]


def test_closing_agrees_with_week_table(spark):
    weeks = calendar.week_table(spark, 2000, 2021)
    wrong = weeks.filter(
        (calendar.week_closing(F.col("BSE_YW")) != F.concat("yyyymmdd", F.lit("010000000000")))
        | (calendar.week_closing(F.col("week2")) != F.concat("yyyymmdd", F.lit("010000000000")))
    )
    assert weeks.count() == 1148
    assert wrong.count() == 0
    assert weeks.filter(calendar.week_closing(F.col("BSE_YW")).isNull()).count() == 0


def test_unknown_weeks_have_no_closing(spark):
    codes = spark.createDataFrame([("202053",), ("202000",), ("x",), (None,)], "c string")
    assert rows(codes.select(calendar.week_closing(F.col("c")).alias("t"))) == [(None,)] * 4


def test_first_weeks_and_sizes(spark):
    first = calendar.week_table(spark, 2020, 2021).orderBy("idx").first()
    assert tuple(first) == (1, "202001", "20200104", "20201")
    days, months = calendar.day_table(spark, 2020, 2021), calendar.month_table(spark, 2020, 2021)
    assert (days.count(), months.count()) == (731, 24)
    assert tuple(days.orderBy("idx").first()) == (1, "20200101")
    assert tuple(months.orderBy(F.col("idx").desc()).first()) == (24, "202112")


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "weektable.csv"
    path.write_bytes(b"\xef\xbb\xbfidx,BSE_YW,yyyymmdd,week2\n1,202001,20200104,20201\n")
    weeks = read_csv(spark, str(path), TABLES["WEEK_TABLE"])
    assert rows(weeks) == [(1, "202001", "20200104", "20201")]


def test_intervals(spark):
    listed = rows(calendar.interval_table(spark))
    assert len(listed) == 13 and (11, "weekly") in listed
