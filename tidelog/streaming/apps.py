"""The two long-running jobs of a log table, as functions.

``ingest_app``      subscribe to a topic (or watch a folder), decode, derive,
                    append one key directory per micro-batch;
``compaction_app``  fold committed batches into the read area, optionally
                    merge gens and clean up.

Their options are the command-line options of a classic deployment, as
parameters: batch interval, files per partition (coalesce level /
repartition factor), explicit start offsets, key-case mode.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.cluster import Cluster
from tidelog.plans.compact import (DEFAULT_FILES_PER_PARTITION, CompactionResult, compact,
                                   gen_bytes, gens_to_merge, merge_gens, vacuum)
from tidelog.plans.maintain import add_written_partitions, refresh
from tidelog.plans.table import LogicalTable
from tidelog.sources.stream import kafka_options, read_file_stream, read_kafka_stream
from tidelog.streaming.ingest import DEFAULT_FILES_PER_PARTITION as INGEST_FILES_PER_PARTITION
from tidelog.streaming.ingest import DEFAULT_INTERVAL_S, start_ingest


def ingest_app(spark: SparkSession, table_root: str, *, bootstrap_servers: str | None = None,
               topic: str | None = None, group_id: str | None = None,
               start_offsets: dict[tuple[str, int], int] | None = None,
               max_offsets_per_trigger: int | None = None,
               source_path: str | None = None, source_format: str = "parquet",
               checkpoint: str | None = None, interval_s: int = DEFAULT_INTERVAL_S,
               available_now: bool = False,
               files_per_partition: int | None = INGEST_FILES_PER_PARTITION,
               mode: str = "lower_all", tz: str | None = None,
               ts_zone: str | None = None, skip_empty: bool = False, ledger: bool = False,
               catalog_table: str | None = None, offset_report: bool = False,
               max_files_per_trigger: int | None = None,
               index_columns: list[str] | None = None) -> StreamingQuery:
    """Start the ingest of one topic (or folder) into the table at ``table_root``.

    The table must exist (``LogicalTable.create``); the stream fails rather
    than skip batches when it does not. The checkpoint defaults to a folder
    next to the table. ``catalog_table`` names a catalog table over the write
    area: each batch's directories are registered there and it is refreshed.
    ``index_columns`` are the columns of the keys' manifests, for data skipping.
    """
    table = LogicalTable.open(spark, table_root)
    if source_path is not None:
        stream = read_file_stream(spark, source_path, source_format, topic=topic,
                                  max_files_per_trigger=max_files_per_trigger)
    else:
        opts = kafka_options(bootstrap_servers or "", topic or "", group_id=group_id,
                             starting_offsets=start_offsets,
                             max_offsets_per_trigger=max_offsets_per_trigger)
        stream = read_kafka_stream(spark, opts)
    ckpt = checkpoint or f"{table.root}/_checkpoints/ingest"
    return start_ingest(table, stream, ckpt, mode=mode, files_per_partition=files_per_partition,
                        interval_s=interval_s, available_now=available_now, tz=tz,
                        ts_zone=ts_zone, skip_empty=skip_empty, ledger=ledger, catalog_table=catalog_table,
                        offset_report=offset_report, index_columns=index_columns)


def compaction_app(spark: SparkSession, table_root: str, *,
                   files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
                   merge: bool = False, merge_fan_in: int = 8, retention_s: float | None = None,
                   forget: bool = False, catalog_table: str | None = None, analyze: bool = False,
                   analyze_columns: bool = False, index_columns: list[str] | None = None,
                   cluster: Cluster | None = None) -> CompactionResult:
    """One compaction run: fold, then optionally merge gens and clean up.

    ``merge`` merges the gens of one size tier once ``merge_fan_in`` of them
    are there. ``retention_s`` removes what no reader needs any more, and
    ``forget`` also the record of it, which keeps the state small.
    ``catalog_table`` names a catalog table over the read area: the new gens'
    directories are registered, analysed if asked, and the table refreshed.
    ``index_columns`` and ``cluster`` lay out the new gens for data skipping."""
    table = LogicalTable.open(spark, table_root)
    res = compact(table, files_per_partition=files_per_partition, catalog_table=catalog_table,
                  analyze=analyze, analyze_columns=analyze_columns, index_columns=index_columns, cluster=cluster)
    if merge:
        due = gens_to_merge(gen_bytes(table), merge_fan_in)
        merged = merge_gens(table, due, files_per_partition=files_per_partition, index_columns=index_columns,
                            cluster=cluster)
        if merged.gen is not None:
            res = CompactionResult(merged.gen, res.keys, merged.state)
            if catalog_table:
                add_written_partitions(table, catalog_table, gen=merged.gen)
                refresh(spark, catalog_table)
    if retention_s is not None:
        vacuum(table, retention_s=retention_s, forget=forget)
    return res
