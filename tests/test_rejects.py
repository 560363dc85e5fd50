"""Reject channel: every payload is rows or one reject, once, in one commit."""

import pytest

from tidelog.plans import fs
from tidelog.plans.compact import compact, vacuum
from tidelog.plans.table import LogicalTable
from tidelog.sources.schema import TableSpec
from tidelog.streaming import rejects as module
from tidelog.streaming.rejects import decode_or_reject, ingest_with_rejects, rejects

ENV = "value string, topic string, partition int, offset bigint"
DOC = '{"TS":"2024-01-02T03:04:05.000Z","appId":"A","x":"Y"}'
PAYLOADS = [DOC, f"[{DOC},{DOC}]", DOC[:20], "null", "7", f"[{DOC},null]", "", " \n", "[]", None, '{"x":']
BAD = [(2, "malformed"), (3, "malformed"), (4, "malformed"), (5, "null element"), (10, "malformed")]


@pytest.fixture
def table(spark, tmp_root):
    return LogicalTable.create(spark, tmp_root, TableSpec.from_ddl(
        "ts string, x string", "dt string, appid string, storeid string"))


def _env(spark, payloads=PAYLOADS):
    return spark.createDataFrame([(p, "t", 0, i) for i, p in enumerate(payloads)], ENV)


def _bad(table):
    return sorted((r.offset, r.reason) for r in rejects(table).collect())


def test_each_payload_is_rows_or_one_reject(spark, table):
    ingest_with_rejects(table, _env(spark), "k", tz="UTC")
    assert [tuple(r) for r in table.snapshot().select("x", "dt", "appid").collect()] == [("y", "20240102", "a")] * 3
    assert _bad(table) == BAD
    assert {r.raw for r in rejects(table).collect()} == {PAYLOADS[i] for i, _ in BAD}     # as sent
    assert {(r.topic, r.partition, r.key) for r in rejects(table).collect()} == {("t", 0, "k")}


def test_payloads_are_parsed_once(spark, table):
    d = decode_or_reject(_env(spark), table.spec.row_schema, keep=["offset"])
    assert d._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    with pytest.raises(ValueError):
        decode_or_reject(_env(spark), table.spec.row_schema, mode="keep_values")


def test_replays_and_crashes_leave_each_reject_once(spark, table, monkeypatch):
    def crash(*a, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(module, "ingest_batch", crash)
        with pytest.raises(RuntimeError):
            ingest_with_rejects(table, _env(spark), "k", tz="UTC")
    assert _bad(table) == []              # not committed
    with monkeypatch.context() as m:
        m.setattr(module.fs, "create_exclusive", lambda *a: crash())
        with pytest.raises(RuntimeError):
            ingest_with_rejects(table, _env(spark), "k", tz="UTC")
    assert _bad(table) == BAD             # committed, its own marker is missing
    assert not ingest_with_rejects(table, _env(spark), "k", tz="UTC").written
    assert fs.exists(spark, f"{table.root}/rejects/key=k/_VISIBLE")
    compact(table)
    assert not ingest_with_rejects(table, _env(spark, ["other"]), "k", tz="UTC").written
    vacuum(table, retention_s=-10, forget=True)
    assert table.state().folded == () and _bad(table) == BAD and table.snapshot().count() == 3


def test_no_records_and_no_rejects(spark, table):
    assert _bad(table) == []
    ingest_with_rejects(table, _env(spark, []), "none", tz="UTC")
    ingest_with_rejects(table, _env(spark, [DOC]).select("value"), "plain", tz="UTC")
    ingest_with_rejects(table, _env(spark, ["["]).select("value"), "unplaced", tz="UTC")
    assert table.snapshot().count() == 1
    assert [tuple(r) for r in rejects(table).collect()] == [(None, None, None, "malformed", "[", "unplaced")]
