from __future__ import annotations

import pytest

from tallyweir.functions.buckets import bucket_end, bucket_of, bucket_time, rfc3339


def value(spark, sql):
    return spark.sql(f"SELECT {sql} AS v").first().v


@pytest.mark.parametrize(
    ("seconds", "duration", "bucket", "time"),
    [
        ("1568962553.325D", 3600, 435823, "2019-09-20T07:00:00+00:00"),
        ("1568962553.325D", 7200, 217912, "2019-09-20T08:00:00+00:00"),
        ("1568962563.374D", 1, 1568962564, "2019-09-20T06:56:04+00:00"),
        ("120.000D", 60, 2, "1970-01-01T00:02:00+00:00"),
        ("120.001D", 60, 3, "1970-01-01T00:03:00+00:00"),
        ("253402300799D", 1, 253402300799, "9999-12-31T23:59:59+00:00"),
    ],
)
def test_buckets_are_closed_on_the_right(spark, seconds, duration, bucket, time):
    assert value(spark, bucket_of(seconds, duration)) == bucket
    assert value(spark, bucket_time(f"{bucket}L", duration)) == time


def test_time_text_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert value(spark, rfc3339("1552186800L")) == "2019-03-10T03:00:00+00:00"
        assert value(spark, f"unix_seconds({bucket_end('2L', 60)})") == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("duration", [0, -60, 1.5, True])
def test_durations_are_whole_seconds(duration):
    with pytest.raises(ValueError):
        bucket_of("x", duration)
