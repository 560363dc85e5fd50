"""Streaming ingest: availableNow runs, replay after a crash, late rows."""

import os

import pytest
from pyspark.sql import functions as F

from tidelog.plans.table import LogicalTable
from tidelog.sources.events_feed import EVENTS_SPEC, raw_log
from tidelog.sources.stream import read_file_stream
from tidelog.streaming.ingest import start_ingest


def _source(spark, events, path, n_files=4):
    raw_log(events).repartition(n_files, "partition").write.parquet(path)


def _forget_commit(ckpt, batch_id):
    """Simulate a crash after the batch wrote but before the engine committed it."""
    for name in (f"{batch_id}", f".{batch_id}.crc"):
        p = f"{ckpt}/commits/{name}"
        if os.path.exists(p):
            os.remove(p)


def _ids(df):
    return sorted(int(r[0]) for r in df.select("eventid").collect())


def test_stream_ingest_available_now(spark, tmp_root, events):
    _source(spark, events, f"{tmp_root}/src")
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    s = read_file_stream(spark, f"{tmp_root}/src", max_files_per_trigger=1)
    q = start_ingest(t, s, f"{tmp_root}/ckpt", available_now=True, tz="UTC")
    q.awaitTermination()
    assert len([r for r in q.batch_results if r.written]) == 4
    assert len(t.committed_keys()) == 4
    all_ids = sorted(r[0] for r in events.select("event_id").collect())
    assert _ids(t.snapshot()) == all_ids
    # keys are <queryId>-<batchId>
    assert all(k.startswith(q.id) for k in t.committed_keys())
    from tidelog.streaming.ingest import progress_offsets
    rep = progress_offsets(q, all_batches=True)
    assert sum(r["numInputRows"] for r in rep) == events.count()
    assert [r["batchId"] for r in rep] == [0, 1, 2, 3]


def test_crash_between_write_and_commit_replays_without_duplicates(spark, tmp_root, events):
    _source(spark, events, f"{tmp_root}/src", n_files=3)
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    ckpt = f"{tmp_root}/ckpt"
    s = read_file_stream(spark, f"{tmp_root}/src", max_files_per_trigger=1)
    q = start_ingest(t, s, ckpt, available_now=True, tz="UTC")
    q.awaitTermination()
    storeids = sorted(r[0] for r in t.write_leg(t.committed_keys()).select("storeid").distinct().collect())
    # forget the commit of the last batch: the engine replays it on restart
    _forget_commit(ckpt, 2)
    s2 = read_file_stream(spark, f"{tmp_root}/src", max_files_per_trigger=1)
    q2 = start_ingest(t, s2, ckpt, available_now=True, tz="UTC")
    q2.awaitTermination()
    assert q2.id == q.id
    assert [r.reason for r in q2.batch_results] == ["committed"]
    all_ids = sorted(r[0] for r in events.select("event_id").collect())
    assert _ids(t.snapshot()) == all_ids
    again = sorted(r[0] for r in t.write_leg(t.committed_keys()).select("storeid").distinct().collect())
    assert again == storeids


def test_leftover_of_failed_batch_is_rewritten(spark, tmp_root, events):
    _source(spark, events, f"{tmp_root}/src", n_files=2)
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    ckpt = f"{tmp_root}/ckpt"
    q = start_ingest(t, read_file_stream(spark, f"{tmp_root}/src", max_files_per_trigger=1),
                     ckpt, available_now=True, tz="UTC")
    q.awaitTermination()
    last = sorted(t.committed_keys())[-1]
    os.remove(f"{t.key_path(last)}/_SUCCESS".removeprefix("file:"))   # the write of batch 1 never committed
    _forget_commit(ckpt, 1)
    q2 = start_ingest(t, read_file_stream(spark, f"{tmp_root}/src", max_files_per_trigger=1),
                      ckpt, available_now=True, tz="UTC")
    q2.awaitTermination()
    assert [r.reason for r in q2.batch_results] == ["written"]
    assert t.snapshot().count() == events.count()


def test_late_rows_land_in_their_event_date(spark, tmp_root, events):
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    late = events.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    src = f"{tmp_root}/src"
    raw_log(events.where(F.col("ts") >= F.lit("2024-01-02").cast("timestamp_ntz"))).write.parquet(f"{src}/a")
    s = read_file_stream(spark, f"{src}/*", max_files_per_trigger=1)
    q = start_ingest(t, s, f"{tmp_root}/ckpt", available_now=True, tz="UTC")
    q.awaitTermination()
    raw_log(late).write.parquet(f"{src}/b")
    q = start_ingest(t, read_file_stream(spark, f"{src}/*", max_files_per_trigger=1),
                     f"{tmp_root}/ckpt", available_now=True, tz="UTC")
    q.awaitTermination()
    snap = t.snapshot()
    assert snap.count() == events.count()
    assert snap.where("dt = '20240101'").count() == late.count()


def test_text_payload_stream(spark, tmp_root, events):
    path = f"{tmp_root}/lines"
    raw_log(events).select("value").write.text(path)
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    q = start_ingest(t, read_file_stream(spark, path, fmt="text", topic="events"),
                     f"{tmp_root}/ckpt", available_now=True, tz="UTC")
    q.awaitTermination()
    assert t.snapshot().count() == events.count()


def test_interval_rules(spark, tmp_root):
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    s = read_file_stream(spark, tmp_root)
    with pytest.raises(ValueError):
        start_ingest(t, s, f"{tmp_root}/ckpt", interval_s=10)
    with pytest.raises(ValueError):
        start_ingest(t, spark.range(1).selectExpr("'x' as value"), f"{tmp_root}/ckpt")


def test_processing_time_trigger_and_graceful_stop(spark, tmp_root, events):
    from tidelog.streaming.ingest import stop_between_batches
    _source(spark, events, f"{tmp_root}/src", n_files=2)
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    q = start_ingest(t, read_file_stream(spark, f"{tmp_root}/src"), f"{tmp_root}/ckpt",
                     interval_s=11, tz="UTC")
    q.processAllAvailable()
    assert stop_between_batches(q, timeout_s=60)
    assert not q.isActive
    assert t.snapshot().count() == events.count()


def test_apps_end_to_end(spark, tmp_root, events):
    from tidelog.streaming.apps import compaction_app, ingest_app
    _source(spark, events, f"{tmp_root}/src", n_files=2)
    root = f"{tmp_root}/t"
    with pytest.raises(Exception):
        ingest_app(spark, root, source_path=f"{tmp_root}/src", available_now=True)  # no table yet
    LogicalTable.create(spark, root, EVENTS_SPEC)
    q = ingest_app(spark, root, source_path=f"{tmp_root}/src", available_now=True, tz="UTC")
    q.awaitTermination()
    res = compaction_app(spark, root, merge=True, retention_s=0)
    t = LogicalTable.open(spark, root)
    assert res.gen is not None and t.delta_keys() == []
    assert t.snapshot().count() == events.count()
    assert _ids(t.snapshot()) == sorted(r[0] for r in events.select("event_id").collect())


def test_missing_table_fails_the_batch_and_replays_later(spark, tmp_root, events):
    from pyspark.errors import StreamingQueryException
    _source(spark, events, f"{tmp_root}/src", n_files=2)
    root, ckpt = f"{tmp_root}/t", f"{tmp_root}/ckpt"
    missing = LogicalTable(spark, root, EVENTS_SPEC)          # no state: not created
    q = start_ingest(missing, read_file_stream(spark, f"{tmp_root}/src"), ckpt,
                     available_now=True, tz="UTC")
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    # the batch was not acknowledged: once the table exists it is replayed whole
    t = LogicalTable.create(spark, root, EVENTS_SPEC)
    q2 = start_ingest(t, read_file_stream(spark, f"{tmp_root}/src"), ckpt,
                      available_now=True, tz="UTC")
    q2.awaitTermination()
    assert t.snapshot().count() == events.count()
