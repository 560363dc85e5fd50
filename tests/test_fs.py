"""Metadata helpers on both paths: local ``os`` and the Hadoop FileSystem."""

import pytest

from tidelog.plans import fs


@pytest.fixture(params=["local", "hadoop"])
def mode(request, monkeypatch):
    if request.param == "hadoop":
        monkeypatch.setattr(fs, "_local", lambda spark, p: None)
    return request.param


def test_exclusive_create_and_listing(spark, tmp_root, mode):
    root = f"file:{tmp_root}/m" if mode == "hadoop" else f"{tmp_root}/m"
    assert fs.create_exclusive(spark, f"{root}/state/v1.json", '{"a": 1}')
    assert not fs.create_exclusive(spark, f"{root}/state/v1.json", '{"a": 2}')
    assert fs.read_text(spark, f"{root}/state/v1.json") == '{"a": 1}'
    assert fs.list_names(spark, f"{root}/state") == ["v1.json"]   # no temp files left
    fs.mkdirs(spark, f"{root}/write/key=k1")
    assert fs.create_exclusive(spark, f"{root}/write/key=k1/_SUCCESS", "")
    fs.mkdirs(spark, f"{root}/write/key=k2")
    assert fs.marked_children(spark, f"{root}/write", "_SUCCESS") == ["key=k1"]
    assert fs.exists(spark, f"{root}/write/key=k2")
    assert fs.mtime(spark, f"{root}/write/key=k1") > 0
    fs.delete(spark, f"{root}/write/key=k2")
    assert not fs.exists(spark, f"{root}/write/key=k2")
    assert fs.list_names(spark, f"{root}/nothing") == []


def test_table_lifecycle_through_hadoop_fs(spark, tmp_root, events, monkeypatch):
    from tidelog.plans.compact import compact, vacuum
    from tidelog.plans.table import LogicalTable, PublishConflict
    from tidelog.sources.events_feed import EVENTS_SPEC, raw_log
    from tidelog.streaming.ingest import decode_and_derive, ingest_batch
    monkeypatch.setattr(fs, "_local", lambda spark, p: None)
    t = LogicalTable.create(spark, f"file:{tmp_root}/h", EVENTS_SPEC)
    rows = decode_and_derive(raw_log(events), t, tz="UTC")
    ingest_batch(t, rows, "b1")
    assert t.committed_keys() == ["b1"]
    res = compact(t)
    assert t.snapshot().count() == events.count()
    with pytest.raises(PublishConflict):
        t.publish(t.state(0), [], [])
    assert vacuum(t, retention_s=0)["keys"] == ["b1"]
    assert t.snapshot().count() == events.count()
    assert LogicalTable.open(spark, f"file:{tmp_root}/h").state().gens == (res.gen,)


@pytest.fixture
def remote_default(spark, tmp_path):
    """The session's default file system is a mount that only Hadoop resolves."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    was = conf.get("fs.defaultFS")
    (tmp_path / "mounted").mkdir()
    conf.set("fs.viewfs.mounttable.far.link./data", f"file://{tmp_path}/mounted")
    conf.set("fs.defaultFS", "viewfs://far/")
    yield str(tmp_path / "mounted")
    conf.set("fs.defaultFS", was)


@pytest.mark.parametrize("root", ["/data/t"])
def test_bare_path_means_the_default_file_system(spark, remote_default, root):
    import os

    from tidelog.plans.compact import compact, vacuum
    from tidelog.plans.table import LogicalTable
    from tidelog.sources.events_feed import EVENTS_SPEC, leg, raw_log
    from tidelog.streaming.ingest import decode_and_derive, ingest_batch
    t = LogicalTable.create(spark, root, EVENTS_SPEC)
    events = spark.read.parquet("file:///root/testdata/sf0.001/events.parquet")
    n = events.count()
    rows = lambda *names: decode_and_derive(raw_log(leg(events, *names)), t, tz="UTC")
    assert ingest_batch(t, rows("R"), "b1").written
    assert ingest_batch(t, rows("R"), "b1").reason == "committed"
    assert t.committed_keys() == ["b1"]
    assert os.path.isdir(remote_default + root.removeprefix("/data") + "/state")
    compact(t)
    assert ingest_batch(t, rows("R"), "b1").reason == "folded"
    assert ingest_batch(t, rows("W_a", "W_b"), "b2").written
    assert t.snapshot().count() == n
    compact(t)
    assert vacuum(t, retention_s=0)["keys"] == ["b1", "b2"]
    assert LogicalTable.open(spark, root).snapshot().count() == n
    assert not os.path.exists(root)


def test_root_with_pattern_characters(spark, events, tmp_root):
    from tidelog.plans.compact import compact
    from tidelog.plans.table import LogicalTable
    from tidelog.sources.events_feed import EVENTS_SPEC, raw_log
    from tidelog.streaming.ingest import decode_and_derive, ingest_batch
    t = LogicalTable.create(spark, f"{tmp_root}/a[1]", EVENTS_SPEC)
    ingest_batch(t, decode_and_derive(raw_log(events), t, tz="UTC"), "b1")
    assert t.committed_keys() == ["b1"]
    assert t.snapshot().count() == events.count()
    compact(t)
    assert t.snapshot().count() == events.count()
