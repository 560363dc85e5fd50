"""Record sources: Kafka options, start offsets, the events feed."""

import json

import pytest
from pyspark.sql import functions as F

from tidelog.operators.stats import offset_ranges
from tidelog.sources.events_feed import raw_log, raw_log_dirty
from tidelog.sources.stream import (EARLIEST, LATEST, kafka_options, keep_from_offsets,
                                    parse_offset_list, starting_offsets_json)


def test_kafka_options():
    o = kafka_options("h1:9092,h2:9092", "logs", group_id="g", max_offsets_per_trigger=1000)
    assert o["subscribe"] == "logs" and o["startingOffsets"] == "latest"
    assert o["kafka.group.id"] == "g" and o["maxOffsetsPerTrigger"] == "1000"
    o2 = kafka_options("h:1", "logs", starting_offsets={("logs", 0): 5, ("logs", 1): -2})
    assert json.loads(o2["startingOffsets"]) == {"logs": {"0": 5, "1": -2}}
    with pytest.raises(ValueError):
        kafka_options("", "logs")


def test_offset_list_of_13_partitions():
    entries = [{"topic": "t", "partition_id": p, "offset": 0} for p in range(13)]
    m = parse_offset_list(entries)
    assert len(m) == 13 and set(m.values()) == {0}
    assert json.loads(starting_offsets_json(m)) == {"t": {str(p): 0 for p in range(13)}}


def test_keep_from_offsets(spark, events):
    env = raw_log(events)
    offs = {("events", p): 10 * p for p in range(13)}
    kept = keep_from_offsets(env, offs)
    exp = env.where(F.col("offset") >= F.col("partition") * 10).count()
    assert kept.count() == exp
    only0 = keep_from_offsets(env, {("events", 0): 5}, unlisted=LATEST)
    assert only0.count() == env.where("partition = 0 and offset >= 5").count()
    all_rows = keep_from_offsets(env, {("events", 0): 5}, unlisted=EARLIEST)
    assert all_rows.count() == env.count() - 5
    plan = kept._jdf.queryExecution().executedPlan().toString()
    base = env._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange") == base.count("Exchange")   # no shuffle of its own


def test_offset_ranges(spark, events):
    r = offset_ranges(raw_log(events)).orderBy("partition").collect()
    n = events.count()
    assert len(r) == 13 and sum(x.n for x in r) == n
    assert all(x.until_offset - x.from_offset == x.n for x in r)


def test_feed_shape(spark, events):
    env = raw_log(events)
    assert env.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    doc = json.loads(env.first().value)
    assert list(doc) == ["eventId", "userId", "appId", "ts", "value", "props"]
    assert doc["ts"].endswith("Z") and doc["appId"].isupper()
    dirty = raw_log_dirty(events)
    assert dirty.where("trim(value) = ''").count() == events.where("event_id % 100 = 9").count()


def test_kafka_shaped_rows_to_envelope(spark):
    from tidelog.sources.stream import to_envelope
    from tidelog.functions.decode import decode_json
    from pyspark.sql.types import StructType
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b'{"A":"x"}'), "t", 3, 7, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, "
        "timestamp timestamp, timestampType int")
    env = to_envelope(raw)
    assert env.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    r = decode_json(env, StructType.fromDDL("a string"), keep=["partition", "offset"]).collect()[0]
    assert (r.partition, r.offset, r.a) == (3, 7, "x")
