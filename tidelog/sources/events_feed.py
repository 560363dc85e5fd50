"""Replay the ``events`` table as a log topic (test and benchmark feed).

Each event becomes one record of the envelope: the payload is the JSON
document a client would send (camelCase keys, upper-case application id,
ISO-8601 time with a ``Z``), the Kafka partition is ``event_id % 13`` and
the offset is ``event_id div 13``, so offsets are dense per partition.
Everything is column expressions over the scan: no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.sources.schema import TableSpec

# Shape of the replayed topic (fixed values).
TOPIC = "events"
N_PARTITIONS = 13
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# The table spec the feed is ingested into (all strings, as log tables are).
EVENTS_SPEC = TableSpec(
    StructType([StructField(n, StringType()) for n in ("eventid", "userid", "ts", "value", "props")]),
    StructType([StructField(n, StringType()) for n in ("dt", "appid", "storeid")]),
    name="demo.events",
)


def payload_columns() -> list:
    """Fields of the client document, in the order they are sent."""
    return [
        F.col("event_id").cast("string").alias("eventId"),
        F.col("user_id").cast("string").alias("userId"),
        F.upper("event_type").alias("appId"),
        F.date_format("ts", ISO_MICROS).alias("ts"),
        F.col("value"),
        F.col("props"),
    ]


def raw_log(ev: DataFrame, topic: str = TOPIC, n_partitions: int = N_PARTITIONS) -> DataFrame:
    """``events`` → envelope ``(key, value, topic, partition, offset, timestamp)``.

    The scan keeps its own splits; nothing is shuffled.
    """
    src = ev.select("event_id", "user_id", "event_type", "ts", "value", "props",
                    F.pmod(F.col("event_id"), F.lit(n_partitions)).cast("int").alias("partition"))
    return src.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(F.struct(*payload_columns())).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition"),
        F.expr(f"event_id div {int(n_partitions)}").cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def raw_log_dirty(ev: DataFrame) -> DataFrame:
    """The feed with damaged records mixed in, chosen by ``event_id % 100``:
    7 → payload cut to its first 20 characters; 8 → a root array holding the
    document twice, after a line end; 9 → a blank payload; 10 → a payload of
    line ends; 11 → a root array of the document and null; every other record
    unchanged."""
    env = raw_log(ev)
    k = F.pmod(F.col("key").cast("bigint"), F.lit(100))
    v = F.col("value")
    damaged = (F.when(k == 7, F.substring(v, 1, 20))
               .when(k == 8, F.concat(F.lit("\n["), v, F.lit(","), v, F.lit("]")))
               .when(k == 9, F.lit("   "))
               .when(k == 10, F.lit(" \r\n\t"))
               .when(k == 11, F.concat(F.lit("["), v, F.lit(",null]")))
               .otherwise(v))
    return env.withColumn("value", damaged)


# Stream legs, each with rows of every day and application: what is already
# compacted (R), the batches folded by the next compaction (W_a) and the
# batches after it (W_b).
LEGS = {"R": 0, "W_a": 1, "W_b": 2}


def leg(ev: DataFrame, *names: str) -> DataFrame:
    """The rows of the named legs; every row of ``ev`` is in exactly one."""
    k = F.coalesce(F.pmod(F.col("event_id"), F.lit(len(LEGS))), F.lit(0))
    return ev.where(k.isin(*[LEGS[n] for n in names]))
