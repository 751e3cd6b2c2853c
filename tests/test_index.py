from datetime import date

from tests.frames import rows
from tidelane.operators import index
from tidelane.schemas import TABLES


def quotes(spark, *days):
    return spark.createDataFrame(
        [("s", "c", "i", "n", day, float(value), "1", "T", "USD") for day, value in days],
        TABLES["INDEX"],
    )


def test_equal_values_of_a_week_count_once(spark):
    source = quotes(
        spark, (date(2020, 1, 6), 5), (date(2020, 1, 7), 5), (date(2020, 1, 8), 8)
    )
    weekly = index.mi_sum_rows(source).filter("interval = 'weekly'")
    assert rows(weekly, "xAxis", "value", "intervalTimestamp", "volume") == [
        ("20202", 6.5, "20200111010000000000", 0.0)
    ]


def test_label_order_and_time_order(spark):
    source = quotes(spark, (date(2020, 1, 6), 5), (date(2020, 3, 2), 8))
    lexical = index.mi_sum_rows(source).filter("interval = 'weekly'")
    assert rows(lexical, "xAxis", "changeValue") == [("20202", -3.0), ("202010", 8.0)][::-1]
    chrono = index.mi_sum_rows(source, chronological=True).filter("interval = 'weekly'")
    assert rows(chrono, "xAxis", "changeValue") == [("202010", 3.0), ("20202", 5.0)]


def test_bucket_ends(spark):
    source = quotes(spark, (date(2020, 12, 30), 5))
    assert rows(index.mi_sum_rows(source), "interval", "xAxis", "intervalTimestamp") == [
        ("monthly", "202012", "20201220010000000000"),
        ("weekly", "202053", None),
        ("yearly", "2020", "20201220010000000000"),
    ]


def test_catalogue(spark):
    source = quotes(spark, (date(2020, 1, 6), 5))
    detail = spark.createDataFrame([("daily",), ("daily",), ("monthly",)], "interval string")
    listed = {
        row.idxCd: [tuple(item) for item in row.intervalItem]
        for row in index.idx_lst(index.mi_sum(source), detail).collect()
    }
    assert listed == {
        "i": [(11, "weekly"), (12, "monthly"), (13, "yearly")],
        "MWWD": [(10, "daily"), (12, "monthly")],
    }
