"""Partition derivation: event date, application id, batch minute."""

import pytest
from pyspark.sql import functions as F

from tidelog.functions.derive import derive_partitions, dt_of, parse_ts, storeid_of


def _dt(spark, values, tz=None, ts_zone=None):
    df = spark.createDataFrame([(v,) for v in values], "ts string")
    return [r[0] for r in df.select(dt_of(spark, F.col("ts"), tz, ts_zone)).collect()]


def test_offset_time_in_utc_and_seoul(spark):
    v = ["2017-08-06T00:00:00+09:00"]
    assert _dt(spark, v, "UTC") == ["20170805"]
    assert _dt(spark, v, "Asia/Seoul") == ["20170806"]


def test_session_zone_default(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert _dt(spark, ["2017-08-06T00:00:00+09:00"]) == ["20170805"]


def test_lower_case_t_and_z(spark):
    assert _dt(spark, ["2024-01-01t23:59:59.999999z"], "UTC") == ["20240101"]


def test_unreadable_gives_null(spark):
    assert _dt(spark, ["garbage", None, "1502000000000", ""], "UTC") == [None, None, None, None]


def test_ts_zone_for_text_without_offset(spark):
    assert _dt(spark, ["2017-08-06 00:30:00"], "UTC", ts_zone="Asia/Seoul") == ["20170805"]
    assert _dt(spark, ["2017-08-06T00:30:00Z"], "UTC", ts_zone="Asia/Seoul") == ["20170806"]


def test_result_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _dt(spark, ["2017-08-06T00:00:00+09:00"], "Asia/Seoul") == ["20170806"]
        assert _dt(spark, ["2017-08-06T00:00:00+09:00"], "UTC") == ["20170805"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_storeid_is_24_hour_minute(spark):
    df = spark.createDataFrame([("2024-01-01T13:05:00Z",), ("2024-01-01T00:00:00Z",)], "ts string")
    got = [r[0] for r in df.select(storeid_of(spark, parse_ts(spark, F.col("ts")), "UTC")).collect()]
    assert got == ["1305", "0000"]


def test_derive_partitions_with_clock(spark):
    df = spark.createDataFrame([("2024-01-02T10:00:00Z", "click")], "ts string, appid string")
    clock = F.lit("2024-01-05 09:05:00").cast("timestamp")
    r = derive_partitions(df, clock=clock).collect()[0]
    assert (r.dt, r.appid, r.storeid) == ("20240102", "click", "0905")


def test_streaming_clock_defaults_to_current_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02T10:00:00Z", "a")], "ts string, appid string")
    r = derive_partitions(df).collect()[0]
    assert len(r.storeid) == 4 and r.storeid.isdigit()


def _derive(spark, session_tz, ts, tz=None, ts_zone=None):
    from tidelog.functions.derive import dt_of, parse_ts, storeid_of
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame([(ts,)], "ts string")
        return df.select(dt_of(spark, F.col("ts"), tz, ts_zone).alias("dt"),
                         storeid_of(spark, parse_ts(spark, F.col("ts"), ts_zone), tz).alias("at")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York", "Europe/Berlin", "Asia/Seoul"])
@pytest.mark.parametrize("ts,tz,ts_zone,dt,at", [
    ("2024-11-03T05:30:00Z", "America/Costa_Rica", None, "20241102", "2330"),   # both hours of a fall-back
    ("2024-11-03T06:30:00Z", "America/Costa_Rica", None, "20241103", "0030"),
    ("2024-11-03T06:30:00Z", "America/New_York", None, "20241103", "0130"),
    ("2024-03-10T07:30:00Z", "UTC", None, "20240310", "0730"),                  # a wall clock New York skips
    ("2024-03-10T02:30:00Z", "UTC", None, "20240310", "0230"),
    ("2024-03-31T01:30:00Z", "Europe/Berlin", None, "20240331", "0330"),        # spring forward
    ("2024-03-10T02:30:00", "UTC", "UTC", "20240310", "0230"),                  # no offset: the zone given
    ("2024-10-27T12:00:00", "UTC", "Europe/Berlin", "20241027", "1100"),
    ("2024-01-05", "Asia/Seoul", "Asia/Seoul", "20240105", "0000"),             # the end of a date is no offset
    ("2024-01-05", "America/New_York", "America/New_York", "20240105", "0000"),
    ("2024-01-05T00:00:00-05:00", "UTC", "Asia/Seoul", "20240105", "0500"),
])
def test_zones_come_from_the_instant(spark, session_tz, ts, tz, ts_zone, dt, at):
    got = _derive(spark, session_tz, ts, tz, ts_zone)
    assert (got.dt, got["at"]) == (dt, at)
