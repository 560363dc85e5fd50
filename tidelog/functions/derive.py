"""Derive the partition columns of an ingested row.

``dt``      event date ``yyyyMMdd`` of the ``ts`` field;
``appid``   the application id field, under its partition name;
``storeid`` the processing minute ``HHmm`` of the batch clock.

``ts`` is ISO-8601 text. The parity decode lower-cases the payload, which
turns ``T``/``Z`` into ``t``/``z``; ``upper`` repairs that before parsing.
Text that cannot be read as a timestamp gives a null ``dt`` (the row is kept
and lands in the default partition) instead of failing the batch under ANSI.

Time zone: by default the date is taken in the session time zone. A ``tz``
argument takes it in that zone instead, whatever the session says; a
``ts_zone`` argument reads a ``ts`` that carries no offset as wall-clock time
in that zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Output formats of the derived partitions (fixed values).
DT_FORMAT = "yyyyMMdd"
STOREID_FORMAT = "HHmm"


# An offset counts only behind a time of day: the end of a date is none.
WITH_OFFSET = r"[T ][0-9:.]+ *(Z|[+-][0-9][0-9](:?[0-9][0-9])?)$"


def parse_ts(spark: SparkSession, ts: Column, ts_zone: str | None = None) -> Column:
    """ISO text (any letter case) → timestamp; null when it cannot be read."""
    text = F.upper(ts)
    parsed = F.try_to_timestamp(text)
    if ts_zone is None:
        return parsed
    # text without an offset: its wall clock is read as such and taken in
    # ts_zone; the session's zone, which may skip that hour, plays no part
    utc = F.convert_timezone(F.lit(ts_zone), F.lit("UTC"), text.try_cast("timestamp_ntz"))
    local = F.try_to_timestamp(F.concat(utc.cast("string"), F.lit("Z")))
    return F.when(text.rlike(WITH_OFFSET), parsed).otherwise(local)


def wall_clock(t: Column, tz: str) -> Column:
    """Wall-clock time of instant ``t`` in zone ``tz`` (a timestamp_ntz),
    from the instant's microseconds, so that no other zone plays a part."""
    micros = F.unix_micros(t).cast("decimal(20,0)")
    utc = (F.lit("1970-01-01").cast("timestamp_ntz")
           + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros / 1_000_000).cast("decimal(18,6)")))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def dt_of(spark: SparkSession, ts: Column, tz: str | None = None,
          ts_zone: str | None = None) -> Column:
    t = parse_ts(spark, ts, ts_zone)
    return F.date_format(t if tz is None else wall_clock(t, tz).cast("date"), DT_FORMAT)


def storeid_of(spark: SparkSession, clock: Column, tz: str | None = None) -> Column:
    if tz is None:
        return F.date_format(clock, STOREID_FORMAT)
    t = wall_clock(clock, tz)
    return F.lpad((F.hour(t) * 100 + F.minute(t)).cast("string"), 4, "0")


def derive_partitions(df: DataFrame, clock: Column | None = None, ts_col: str = "ts",
                      app_col: str = "appid", tz: str | None = None,
                      ts_zone: str | None = None) -> DataFrame:
    """Add ``dt``, ``appid`` and ``storeid`` (in that order, replacing any
    decoded value).

    ``clock`` is the batch clock. In a streaming plan pass nothing: the
    engine's ``current_timestamp()`` is fixed per micro-batch and recorded in
    the checkpoint, so a replayed batch gets the same ``storeid``. Batch
    callers pass a literal (or any timestamp column).
    """
    spark = df.sparkSession
    if clock is None:
        clock = F.current_timestamp()
    return (df.withColumn("dt", dt_of(spark, F.col(ts_col), tz, ts_zone))
            .withColumn("appid", F.col(app_col))
            .withColumn("storeid", storeid_of(spark, clock, tz)))
