from decimal import Decimal as D

from pyspark.sql import functions as F

from tests.frames import rows, time
from tidelane.functions.stamps import moment_time, stamp, stamp_moment, stamp_price


def test_stamps_give_back_time_and_price(spark):
    pairs = [
        (time("20200105", 7), D("12.34")),
        (time("19010101"), D("-5.00")),
        ("20991231235959999999", D("9999999999999999.99")),
        (time("20200105", 8), None),
        (None, D("1.00")),
        ("18991231235959999999", D("-9999999999999999.99")),
        ("29990101000000000000", D("0.00")),
        ("00000000000000000002", D("0.01")),
        ("99999999999999999999", D("9999999999999999.99")),
    ]
    frame = spark.createDataFrame(pairs, "t string, p decimal(18,2)")
    packed = stamp(F.col("t"), F.col("p"))
    back = frame.select(moment_time(stamp_moment(packed)).alias("t"), stamp_price(packed).alias("p"))
    assert rows(back) == rows(frame)


def test_stamps_order_by_time_then_price(spark):
    early, late = time("20200105", 1), time("20200105", 2)
    pairs = [(None, D(5)), (early, None), (early, D(-1)), (early, D(3)), (late, None), (late, D(1))]
    frame = spark.createDataFrame(
        [(n, *pair) for n, pair in enumerate(pairs)], "n int, t string, p decimal(18,2)"
    )
    ordered = frame.orderBy(stamp(F.col("t"), F.col("p"))).select("n").collect()
    assert [row.n for row in ordered] == list(range(len(pairs)))


def test_first_and_last_stay_in_a_hash_aggregate(spark):
    frame = spark.createDataFrame([("k", time("20200105"), D(1))], "k string, t string, p decimal(18,2)")
    packed = stamp(F.col("t"), F.col("p"))
    plan = frame.groupBy("k").agg(F.min(packed), F.max(packed))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_times_of_other_shapes_lose_only_the_time(spark):
    frame = spark.createDataFrame([(t, D(3)) for t in ("20200101", "x" * 20, "", "2" * 21)], "t string, p decimal(18,2)")
    packed = stamp(F.col("t"), F.col("p"))
    assert rows(frame.select(moment_time(stamp_moment(packed)), stamp_price(packed))) == [(None, D(3))] * 4


def test_all_years_order(spark):
    times = ["00010101000000000000", "18991231000000000000", "19000101000000000000", "28000101000000000000", "29990101000000000000"]
    frame = spark.createDataFrame([(t, D(p)) for t in times for p in (-1, 1)], "t string, p decimal(18,2)")
    packed = stamp(F.col("t"), F.col("p")).alias("s")
    assert [r.t for r in frame.select("t", packed).orderBy("s").collect()] == [t for t in times for _ in (0, 1)]
