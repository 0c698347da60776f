from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from gatelens.functions import time as t


def ms(*parts):
    return t.to_millis(datetime(*parts))


def test_days_of_a_range():
    assert t.days_of(t.TimeRange(1474581851724, 1474582151724)) == ["2016.09.22"]
    days = t.days_of(t.TimeRange(1473459236000, 1474582436000))
    assert len(days) == 14
    assert (days[0], days[-1]) == ("2016.09.09", "2016.09.22")


def test_days_depend_on_the_zone():
    late = ms(2017, 5, 22, 23, 30)
    assert t.days_of(t.TimeRange(late, late)) == ["2017.05.22"]
    assert t.days_of(t.TimeRange(late, late), "Europe/Paris") == ["2017.05.23"]


def test_month_before_clamps():
    assert t.month_before(ms(2024, 3, 31, 12)) == ms(2024, 2, 29, 12)
    assert t.month_before(ms(2023, 3, 31)) == ms(2023, 2, 28)
    assert t.month_before(ms(2024, 1, 15)) == ms(2023, 12, 15)


def test_last_days_and_aware_times():
    now = datetime(2024, 1, 30, tzinfo=timezone.utc)
    assert t.last_days(30, now) == t.TimeRange(ms(2023, 12, 31), ms(2024, 1, 30))
    assert t.to_millis(now) == ms(2024, 1, 30)


def test_rolling_windows_are_ordered_by_start():
    windows = t.rolling_windows(ms(2024, 3, 31))
    assert [label for label, _ in windows] == ["1M", "1w", "1d", "1h", "1m"]
    assert [start for _, start in windows] == sorted(start for _, start in windows)


@pytest.mark.parametrize("moment", [-1, -3_600_000, -3_600_001, 0, 7_199_999, 1_473_459_236_000])
def test_bucket_start(spark, moment):
    row = spark.range(1).select(t.bucket_start(F.lit(moment).cast("bigint"), 3_600_000).alias("b")).first()
    assert row.b == t.bucket_floor(moment, 3_600_000) == moment // 3_600_000 * 3_600_000


def test_day_columns_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    moments = spark.range(1).select(t.instant(ms(2017, 5, 22, 23, 30)).alias("ts"))
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = moments.select(
                t.day_of(F.col("ts")).alias("utc"), t.day_of(F.col("ts"), "Europe/Paris").alias("paris")
            ).first()
            assert tuple(row) == ("2017.05.22", "2017.05.23")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_sequence(spark):
    days = spark.range(1).select(
        t.day_sequence(t.instant(1473459236000), t.instant(1474582436000)).alias("days")
    )
    assert days.first().days == t.days_of(t.TimeRange(1473459236000, 1474582436000))


def moments(spark, *values):
    rows = spark.createDataFrame([(v,) for v in values], "ms bigint")
    return rows.select("ms", F.timestamp_millis("ms").alias("ts"))


def kept(frame):
    return sorted(row.ms for row in frame.collect())


def test_time_range_includes_both_ends_at_millisecond_resolution(spark):
    docs = moments(spark, 999, 1000, 1500, 2000, 2001)
    assert kept(docs.where(t.in_time_range(t.TimeRange(1000, 2000)))) == [1000, 1500, 2000]
    micros = spark.range(1).select(F.timestamp_micros(F.lit(2_000_999)).alias("ts"))
    assert micros.where(t.in_time_range(t.TimeRange(1000, 2000))).count() == 1
    assert micros.where(t.in_time_range(t.TimeRange(1000, 1999))).count() == 0


def test_whole_days_without_and_with_a_day_column(spark):
    first, last = date(2024, 2, 29), date(2024, 3, 1)
    inside = [ms(2024, 2, 29), ms(2024, 3, 1, 23, 59)]
    docs = moments(spark, ms(2024, 2, 28, 23, 59), *inside, ms(2024, 3, 2))
    assert kept(t.restrict_days(docs, first, last)) == inside
    assert kept(t.restrict_days(docs.withColumn("day", t.day_of(F.col("ts"))), first, last)) == inside


def test_whole_days_of_another_zone(spark):
    docs = moments(spark, ms(2024, 1, 9, 22, 59), ms(2024, 1, 9, 23), ms(2024, 1, 10, 22, 59), ms(2024, 1, 10, 23))
    day = date(2024, 1, 10)
    assert kept(t.restrict_days(docs, day, day, "Europe/Paris")) == [ms(2024, 1, 9, 23), ms(2024, 1, 10, 22, 59)]


def test_last_month_reads_whole_days(spark):
    now = ms(2024, 3, 31, 12)
    docs = moments(spark, ms(2024, 2, 28, 23), ms(2024, 2, 29, 1), ms(2024, 3, 31, 23), ms(2024, 4, 1))
    assert kept(t.restrict_last_month(docs, now)) == [ms(2024, 2, 29, 1), ms(2024, 3, 31, 23)]
