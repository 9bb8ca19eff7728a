from datetime import datetime

from retrolane.clock import Clock
from tests.conftest import at

CLOCK = Clock.at("2014-10-18 09:30:00")


def kept(spark, condition, times):
    df = spark.createDataFrame([(at(t),) for t in times], "created TIMESTAMP_NTZ")
    return {row["created"] for row in df.where(condition).collect()}


def test_closed_days_include_both_midnights(spark):
    times = ["2014-10-11 00:00:00", "2014-10-10 23:59:59", "2014-10-18 00:00:00", "2014-10-18 00:00:01"]
    assert kept(spark, CLOCK.closed_days("created", 7), times) == {datetime(2014, 10, 11), datetime(2014, 10, 18)}


def test_rolling_window_ends_now(spark):
    times = ["2014-10-18 09:20:00", "2014-10-18 09:19:59", "2014-10-18 09:30:00", "2014-10-18 09:30:01"]
    assert kept(spark, CLOCK.last("created", minutes=10), times) == {at(times[0]), at(times[2])}


def test_days_to_now_start_at_midnight(spark):
    times = ["2014-10-17 00:00:00", "2014-10-16 23:59:59", "2014-10-18 09:30:00", "2014-10-18 10:00:00"]
    assert kept(spark, CLOCK.days_to_now("created", 1), times) == {at(times[0]), at(times[2])}


def test_days_go_back_over_a_month_end():
    assert Clock.at("2014-03-02").midnight(6) == datetime(2014, 2, 24)


def test_labels():
    assert CLOCK.day_label(7) == "11-10-2014"
    assert CLOCK.run_stamp() == "18_10_2014_09_30_00"


def test_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(at("2014-10-12"),)], "created TIMESTAMP_NTZ").write.parquet(path)
    df = spark.read.parquet(path).where(CLOCK.closed_days("created", 7))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created,2014-10-11T00:00)" in plan
