"""Ingest: decoded log rows → one committed key directory per micro-batch.

The streaming plan is ``source → decode → derive partitions → foreachBatch``.
Decoding and the batch clock (``storeid``) are part of the streaming plan, so
a replayed batch carries the same rows and the same clock. The batch body
writes ``write/key=<queryId>-<batchId>``:

* key already committed, or already folded by a compaction → skip (replay
  after a crash between write and checkpoint commit adds nothing);
* leftover of a failed attempt without a marker → overwritten;
* empty batch → with ``skip_empty`` nothing is written and the key stays
  unused; by default the key is committed with no data files (the same
  snapshot, without an extra job over the batch). Structured Streaming runs
  no micro-batch when no new records arrived, so this is rare;
* missing table → raise, so the checkpoint does not move past the batch.

Late rows need nothing special: no watermark is used, nothing is dropped,
and a late row lands in its own event-date ``dt`` under the current
``storeid``.
"""

from __future__ import annotations

import json
import time
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tidelog.functions.decode import decode_json
from tidelog.functions.derive import derive_partitions
from tidelog.operators.stats import offset_ranges
from tidelog.operators.write import quoted, write_partitioned
from tidelog.plans import fs
from tidelog.plans.evolve import mark_key
from tidelog.plans.ledger import ingest_once
from tidelog.plans.maintain import add_written_partitions, refresh
from tidelog.plans.skipping import write_manifest
from tidelog.plans.table import KEY_COL, LogicalTable
from tidelog.sources.schema import TableSpec

# Micro-batch interval: default and lower bound, in seconds, and files per
# partition directory per batch (fixed values).
DEFAULT_INTERVAL_S = 300
MIN_INTERVAL_S = 10
DEFAULT_FILES_PER_PARTITION = None   # size-driven layout, see ingest_batch
# Area of the durable offset report, one folder per batch key.
OFFSETS_AREA = "offsets"
# The application field as clients send it, for decoding with exact keys.
APP_FIELD = "appId"
CLOCK = "__clock"
RESULTS_KEPT = 100


@dataclass
class BatchResult:
    key: str
    written: bool
    reason: str


def decode_and_derive(envelope: DataFrame, table: LogicalTable | TableSpec, mode: str = "lower_all",
                      clock=None, tz: str | None = None, ts_zone: str | None = None,
                      app_field: str = APP_FIELD, keep: list[str] | None = None) -> DataFrame:
    """Envelope (``value`` column) → rows in the table's column order
    (``table`` is a logical table or just its spec).

    With ``mode="exact"`` the application id is read from the payload's
    ``app_field`` (unless the table declares a data column of that name) and
    aliased; the other modes find it in any letter case. ``keep`` names
    envelope columns that ``clock`` refers to."""
    spec = table.spec if isinstance(table, LogicalTable) else table
    schema, app_col = payload_schema(spec, mode, app_field)
    decoded = decode_json(envelope, schema, mode=mode, keep=keep)
    return derived_rows(decoded, spec, mode, app_col, clock, tz, ts_zone)


def payload_schema(spec: TableSpec, mode: str, app_field: str = APP_FIELD) -> tuple[StructType, str]:
    """The fields that payloads are decoded into, and the one of the
    application id."""
    schema = spec.row_schema
    if mode != "exact":
        return schema, "appid"
    schema = StructType([f for f in schema.fields if f.name != "appid" or "appid" in spec.column_names])
    if app_field not in schema.fieldNames():
        schema = schema.add(app_field, StringType())
    return schema, app_field


def derived_rows(decoded: DataFrame, spec: TableSpec, mode: str, app_col: str, clock=None, tz: str | None = None,
                 ts_zone: str | None = None) -> DataFrame:
    """Decoded rows in the table's column order, with its partitions."""
    cols = [c.lower() if mode == "lower_all" else c for c in spec.column_names]
    derived = derive_partitions(decoded, clock=clock, ts_col=_find(cols, "ts"),
                                app_col=app_col, tz=tz, ts_zone=ts_zone)
    return derived.select(*map(quoted, [*cols, *spec.partition_names]))


def _find(cols: list[str], name: str) -> str:
    for c in cols:
        if c.lower() == name:
            return c
    raise ValueError(f"the table has no {name!r} column")


def ingest_batch(table: LogicalTable, rows: DataFrame, key: str,
                 files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
                 skip_empty: bool = False,
                 catalog_table: str | None = None,
                 index_columns: list[str] | None = None) -> BatchResult:
    """Write one batch of derived rows as key directory ``key``.

    Layout (default ``files_per_partition=None``): a ``REBALANCE`` on the
    partition columns. Adaptive execution measures the batch while it
    shuffles it: every partition directory is written by one task (one file
    per directory per batch, the reference contract), except a directory
    larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` in this
    batch — one hot application — which is split over several writers. No
    extra pass over the batch is needed.

    ``files_per_partition=n`` instead bounds files per directory by ``n``,
    whatever a directory's size. ``catalog_table`` names a catalog table over
    the write area to register the new directories in (just this key's, not a
    full recovery) and to refresh. ``index_columns`` writes the key's manifest
    after its commit (:mod:`tidelog.plans.skipping`); a crash between the two
    leaves a key that is read whole.
    """
    st = table.state()  # raises TableMissing: the batch must not be acknowledged
    if key in st.folded:
        return BatchResult(key, False, "folded")
    if table.is_committed(key):
        return BatchResult(key, False, "committed")
    if skip_empty and rows.isEmpty():
        return BatchResult(key, False, "empty")
    if st.evolved:
        mark_key(table.spark, table.root, key, table.spec_version, list(range(1, len(st.evolved) + 1)))
    out = rows.select(*map(quoted, [*table.spec.column_names, *table.spec.partition_names]))
    write_partitioned(out, table.key_path(key), table.spec.partition_names, files_per_partition,
                      mode="overwrite")
    if index_columns:
        write_manifest(table, index_columns, key=key)
    if catalog_table:
        add_written_partitions(table, catalog_table, key=key)
        refresh(table.spark, catalog_table)
    return BatchResult(key, True, "written")


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if qid:
        return qid
    meta = json.loads(fs.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))
    return meta["id"]


def start_ingest(table: LogicalTable, envelope: DataFrame, checkpoint: str,
                 mode: str = "lower_all",
                 files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
                 interval_s: int | None = DEFAULT_INTERVAL_S, available_now: bool = False,
                 tz: str | None = None, ts_zone: str | None = None,
                 query_name: str | None = None, skip_empty: bool = False,
                 catalog_table: str | None = None, offset_report: bool = False,
                 ledger: bool = False, index_columns: list[str] | None = None) -> StreamingQuery:
    """Start the streaming ingest of ``envelope`` (a streaming DataFrame with
    a ``value`` column) into ``table``.

    ``interval_s`` is the micro-batch interval (must exceed 10 s);
    ``available_now=True`` processes what is there and stops (tests, backfill).
    ``skip_empty`` and ``catalog_table`` are those of :func:`ingest_batch`.
    ``offset_report`` writes each batch's offset ranges per topic partition
    under the table, before the batch is committed (:func:`offset_reports`
    reads them); the batch's offsets are read once more for it. ``ledger``
    takes each record of the topic once, whatever other streams or checkpoints
    brought it before (:mod:`tidelog.plans.ledger`). ``index_columns`` writes
    each key's manifest after its commit (:mod:`tidelog.plans.skipping`).
    """
    if not envelope.isStreaming:
        raise ValueError("start_ingest needs a streaming DataFrame; use ingest_batch for batch data")
    if not available_now and (interval_s is None or interval_s <= MIN_INTERVAL_S):
        raise ValueError(f"batch interval must be larger than {MIN_INTERVAL_S} s")
    if offset_report or ledger:
        # the clock belongs to the streaming plan, so that a replay has the same
        rows = envelope.withColumn(CLOCK, F.current_timestamp())
    else:
        rows = decode_and_derive(envelope, table, mode=mode, tz=tz, ts_zone=ts_zone)
    # of a long stream only the last results are kept
    results: deque[BatchResult] = deque(maxlen=RESULTS_KEPT)

    def rows_of(batch: DataFrame) -> DataFrame:
        return decode_and_derive(batch, table, mode=mode, clock=F.col(CLOCK), tz=tz, ts_zone=ts_zone, keep=[CLOCK])

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        key = f"{_query_id(batch.sparkSession, checkpoint)}-{batch_id}"
        if offset_report:
            offset_ranges(batch).write.mode("overwrite").parquet(_offsets_path(table, key))
        if ledger:
            results.append(ingest_once(table, batch, key, rows_of, files_per_partition, catalog_table))
            if index_columns and results[-1].written:
                write_manifest(table, index_columns, key=key)
            return
        if offset_report:
            batch = rows_of(batch)
        results.append(ingest_batch(table, batch, key, files_per_partition, skip_empty, catalog_table, index_columns))

    w = rows.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=f"{int(interval_s)} seconds")
    q = w.start()
    q.batch_results = results  # type: ignore[attr-defined]
    return q


def _offsets_path(table: LogicalTable, key: str) -> str:
    return f"{table.root}/{OFFSETS_AREA}/{KEY_COL}={key}"


def offset_reports(table: LogicalTable) -> DataFrame:
    """(key, topic, partition, from_offset, until_offset, n) of every batch
    that was ingested with ``offset_report``, however many there were."""
    schema = StructType([
        StructField("topic", StringType()), StructField("partition", IntegerType()),
        StructField("from_offset", LongType()), StructField("until_offset", LongType()),
        StructField("n", LongType()), StructField(KEY_COL, StringType())])
    path = f"{table.root}/{OFFSETS_AREA}"
    if not fs.exists(table.spark, path):
        return table.spark.createDataFrame([], schema)
    return table.spark.read.schema(schema).parquet(fs.literal(path))


def progress_offsets(query: StreamingQuery, all_batches: bool = False) -> list[dict]:
    """Live offset report of the batches whose progress the engine still
    keeps (the complete report is :func:`offset_reports`): per micro-batch and source, the start and
    end offsets and the row count, from the query's progress records
    (driver-side metadata; for Kafka the offsets are per topic partition)."""
    records = query.recentProgress if all_batches else [query.lastProgress]
    out = []
    for p in records:
        if not p:
            continue
        for s in p["sources"]:
            out.append({"batchId": p["batchId"], "source": s["description"],
                        "startOffset": s.get("startOffset"), "endOffset": s.get("endOffset"),
                        "numInputRows": s.get("numInputRows")})
    return out


def stop_between_batches(query: StreamingQuery, timeout_s: float = 600.0,
                         poll_s: float = 0.5) -> bool:
    """Stop ``query`` when no micro-batch is running (graceful stop).

    Stopping mid-batch is also safe — the batch is replayed under the same
    key on restart — this only avoids redoing the work. Returns False when
    the query was stopped after ``timeout_s`` with a batch still running.
    """
    deadline = time.monotonic() + timeout_s
    idle = False
    while query.isActive and time.monotonic() < deadline:
        if not query.status.get("isTriggerActive", False):
            idle = True
            break
        time.sleep(poll_s)
    query.stop()
    return idle or not query.isActive
