from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from rivulet.functions import timegrain as tg

AS_OF = datetime(2024, 1, 31)


def test_daily_buckets_exclude_the_current_day():
    days = [b.day for b in tg.buckets(AS_OF, "daily")]
    assert days == [date(2024, 1, 24) + timedelta(days=i) for i in range(7)]


def test_weekly_buckets_start_on_monday_and_include_the_current_week():
    assert [b.day for b in tg.buckets(AS_OF, "weekly")] == [date(2024, 1, d) for d in (8, 15, 22, 29)]


def test_monthly_buckets_and_lookback():
    days = [b.day for b in tg.buckets(datetime(2001, 8, 15), "monthly", lookback=1)]
    assert days == [date(2001, m, 1) for m in range(2, 9)]
    assert tg.buckets(datetime(2024, 2, 10), "monthly")[0].day == date(2023, 9, 1)


def test_edges_follow_daylight_saving():
    spring = {b.day: b for b in tg.buckets(datetime(2024, 4, 3), "daily")}
    assert spring[date(2024, 3, 31)].end - spring[date(2024, 3, 31)].start == timedelta(hours=23)
    autumn = {b.day: b for b in tg.buckets(datetime(2024, 10, 30), "daily")}
    assert autumn[date(2024, 10, 27)].end - autumn[date(2024, 10, 27)].start == timedelta(hours=25)


def test_as_of_late_in_the_day_is_tomorrow_in_paris():
    assert tg.current_bucket(datetime(2024, 1, 30, 23, 30), "daily") == date(2024, 1, 31)
    assert tg.current_bucket(datetime(2024, 1, 30, 23, 30), "daily", "UTC") == date(2024, 1, 30)
    aware = datetime(2024, 1, 31, 0, 30, tzinfo=timezone(timedelta(hours=1)))
    assert tg.current_bucket(aware, "daily", "UTC") == date(2024, 1, 30)


def test_retention_cutoffs():
    assert tg.retention_cutoff(AS_OF, "daily") == date(2024, 1, 24)
    assert tg.retention_cutoff(AS_OF, "weekly") == date(2024, 1, 8)
    assert tg.retention_cutoff(AS_OF, "monthly") == date(2023, 2, 1)


@pytest.mark.parametrize("grain", ["daily", "weekly", "monthly"])
def test_calendar_matches_the_driver_side_buckets(spark, grain):
    rows = [r[0] for r in spark.range(1).select(tg.bucket_calendar(AS_OF, grain)).collect()]
    assert rows == [b.day for b in tg.buckets(AS_OF, grain)]


def test_bucket_of_assigns_rows_across_the_clock_change(spark):
    times = ["2024-03-30 22:59:59", "2024-03-30 23:00:00", "2024-03-31 21:59:59", "2024-03-31 22:00:00"]
    df = spark.createDataFrame([(datetime.fromisoformat(t),) for t in times], "t timestamp_ntz")
    span = tg.buckets(datetime(2024, 4, 3), "daily")
    got = [r[0] for r in df.orderBy("t").select(tg.bucket_of(df, "t", span)).collect()]
    assert got == [date(2024, 3, 30), date(2024, 3, 31), date(2024, 3, 31), date(2024, 4, 1)]


def test_local_time_is_independent_of_column_type_and_session_zone(spark):
    ntz = spark.createDataFrame([(datetime(2024, 7, 1, 12),)], "t timestamp_ntz")
    ltz = spark.range(1).select(F.timestamp_micros(F.lit(1719835200000000)).alias("t"))
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for df in (ntz, ltz):
                assert df.select(tg.local_time(df, "t", "Europe/Paris")).first()[0] == datetime(2024, 7, 1, 14)
                kept = tg.time_between(df, "t", datetime(2024, 7, 1, 12), datetime(2024, 7, 1, 12, 0, 1))
                assert kept.count() == 1
                assert tg.time_between(df, "t", None, datetime(2024, 7, 1, 12)).count() == 0
                hour = tg.with_hour(df, "t", "Asia/Kolkata").first()["heure"]
                assert hour == datetime(2024, 7, 1, 17)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_labels(spark):
    df = spark.createDataFrame([(date(2024, 3, 4), datetime(2024, 3, 4, 7, 5))], "d date, t timestamp_ntz")
    row = df.select(
        tg.bucket_label(F.col("t"), "hourly"),
        tg.bucket_label(F.col("d"), "daily"),
        tg.bucket_label(F.col("d"), "weekly"),
        tg.bucket_label(F.col("d"), "monthly"),
    ).first()
    assert tuple(row) == ("07:05", "Monday", "2024-03-04", "March")
