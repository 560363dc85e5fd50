"""Log record sources: one envelope for every feed.

Envelope columns: ``key string, value string, topic string, partition int,
offset bigint, timestamp timestamp``. Only ``value`` is decoded; the rest
serves offset reports and replays.

* :func:`read_kafka_stream` subscribes to one topic (needs the Kafka
  connector on the classpath);
* :func:`read_file_stream` reads envelope files (Parquet or JSON) or raw
  payload text files with the same columns, for backfills and tests;
* :func:`starting_offsets` / :func:`keep_from_offsets` apply explicit start
  offsets, to a new stream or to a batch backfill.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

ENVELOPE_DDL = ("key string, value string, topic string, partition int, "
                "offset bigint, timestamp timestamp")
ENVELOPE = StructType([
    StructField("key", StringType()), StructField("value", StringType()),
    StructField("topic", StringType()), StructField("partition", IntegerType()),
    StructField("offset", LongType()), StructField("timestamp", TimestampType()),
])

# Consumer policy of the ingest (fixed values): start at the latest offset of a
# new subscription; offsets are committed only after the batch is written.
DEFAULT_STARTING_OFFSETS = "latest"
# Kafka's start-offset sentinels in Spark's JSON form (fixed values).
LATEST, EARLIEST = -1, -2


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str | dict | None = None,
                  max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> dict:
    """Options of a Kafka stream for one topic. Broker addresses and any
    credentials come from the caller."""
    if not bootstrap_servers or not topic:
        raise ValueError("bootstrap servers and topic are required")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": DEFAULT_STARTING_OFFSETS,
        "failOnDataLoss": "true",
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if starting_offsets is not None:
        opts["startingOffsets"] = (starting_offsets if isinstance(starting_offsets, str)
                                   else starting_offsets_json(starting_offsets))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def read_kafka_stream(spark: SparkSession, options: dict) -> DataFrame:
    """Streaming envelope from Kafka (key and value as strings)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return to_envelope(raw)


def to_envelope(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      F.col("topic").cast("string").alias("topic"),
                      F.col("partition").cast("int").alias("partition"),
                      F.col("offset").cast("bigint").alias("offset"),
                      F.col("timestamp").cast("timestamp").alias("timestamp"))


def read_file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None, topic: str | None = None) -> DataFrame:
    """Streaming envelope from files.

    ``fmt='parquet'`` or ``'json'``: files hold envelope columns.
    ``fmt='text'``: one payload per line; ``topic`` names the feed and the
    other envelope columns are null.
    """
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "text":
        lines = r.text(path)
        return lines.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                            F.lit(topic).cast("string").alias("topic"),
                            F.lit(None).cast("int").alias("partition"),
                            F.lit(None).cast("bigint").alias("offset"),
                            F.lit(None).cast("timestamp").alias("timestamp"))
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unsupported envelope format {fmt!r}")
    return r.schema(ENVELOPE).format(fmt).load(path)


# ---------------------------------------------------------------------------
# S3: explicit start offsets
# ---------------------------------------------------------------------------

def parse_offset_list(entries: list[dict]) -> dict[tuple[str, int], int]:
    """``[{topic, partition_id, offset}, …]`` → ``{(topic, partition): offset}``."""
    out: dict[tuple[str, int], int] = {}
    for e in entries:
        out[(str(e["topic"]), int(e["partition_id"]))] = int(e["offset"])
    return out


def starting_offsets_json(offsets: dict[tuple[str, int], int]) -> str:
    """Spark's ``startingOffsets`` JSON: ``{"topic": {"0": n, …}}``. Every
    partition of a topic must be listed (−1 latest, −2 earliest)."""
    doc: dict[str, dict[str, int]] = {}
    for (topic, part), off in sorted(offsets.items()):
        doc.setdefault(topic, {})[str(part)] = int(off)
    return json.dumps(doc, sort_keys=True)


def _offset_lookup(offsets: dict[tuple[str, int], int], topic: Column, part: Column) -> Column:
    if not offsets:
        return F.lit(None).cast("bigint")
    pairs = []
    for (t, p), off in sorted(offsets.items()):
        pairs += [F.lit(f"{t}\u0000{p}"), F.lit(int(off)).cast("bigint")]
    m = F.create_map(*pairs)
    return F.try_element_at(m, F.concat_ws("\u0000", topic, part.cast("string")))


def keep_from_offsets(envelope: DataFrame, offsets: dict[tuple[str, int], int],
                      unlisted: int = EARLIEST) -> DataFrame:
    """Batch backfill from explicit start offsets: keep records at or after
    the start of their (topic, partition).

    The offset map is one literal map expression (size = number of topic
    partitions), evaluated per row inside the scan stage: no join, no
    shuffle. ``unlisted`` applies to partitions without an entry: −2
    (earliest) keeps them whole, −1 (latest) keeps nothing from them.
    """
    start = _offset_lookup(offsets, F.col("topic"), F.col("partition"))
    if unlisted == EARLIEST:
        cond = start.isNull() | (start < 0) | (F.col("offset") >= start)
    elif unlisted == LATEST:
        cond = start.isNotNull() & ((start == EARLIEST) | (F.col("offset") >= start)) & (start != LATEST)
    else:
        raise ValueError("unlisted must be -1 (latest) or -2 (earliest)")
    return envelope.where(cond)
