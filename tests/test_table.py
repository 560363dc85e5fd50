"""Logical table: every committed row visible exactly once at every stage."""

import os

import pytest
from pyspark.sql import functions as F

from tidelog.plans import fs
from tidelog.plans.compact import compact, files_per_partition, fold, vacuum
from tidelog.plans.table import LogicalTable, PublishConflict, TableMissing
from tidelog.sources.events_feed import EVENTS_SPEC, leg, raw_log
from tidelog.sources.schema import TableSpec
from tidelog.streaming.ingest import decode_and_derive, ingest_batch


def _rows(t, ev):
    return decode_and_derive(raw_log(ev), t, tz="UTC")


def _ids(df):
    return sorted(int(r[0]) for r in df.select("eventid").collect())


@pytest.fixture
def table(spark, tmp_root):
    return LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)


def test_bootstrap_state_v0_and_rerun(spark, tmp_root):
    t = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    t2 = LogicalTable.create(spark, f"{tmp_root}/t", EVENTS_SPEC)
    st = t2.state()
    assert (st.version, st.gens, st.folded) == (0, (), ())
    assert t.snapshot().count() == 0
    other = TableSpec.from_ddl("x string", "dt string, appid string, storeid string")
    with pytest.raises(ValueError):
        LogicalTable.create(spark, f"{tmp_root}/t", other)
    assert LogicalTable.open(spark, f"{tmp_root}/t").spec.column_names == EVENTS_SPEC.column_names


def test_missing_table_raises(spark, tmp_root, events):
    t = LogicalTable(spark, f"{tmp_root}/nothing", EVENTS_SPEC)
    with pytest.raises(TableMissing):
        ingest_batch(t, _rows(t, events), "k")
    with pytest.raises(TableMissing):
        compact(t)
    with pytest.raises(TableMissing):
        LogicalTable.open(spark, f"{tmp_root}/nothing")


def test_exactly_once_through_every_stage(spark, table, events):
    all_ids = _ids(events.select(F.col("event_id").alias("eventid")))
    t = table
    ingest_batch(t, _rows(t, leg(events, "R")), "b1")
    compact(t)
    ingest_batch(t, _rows(t, leg(events, "W_a")), "b2")
    assert _ids(t.snapshot()) == sorted(
        _ids(leg(events, "R").select(F.col("event_id").alias("eventid")))
        + _ids(leg(events, "W_a").select(F.col("event_id").alias("eventid"))))
    # compaction freezes its keys, then a batch lands mid-way
    base = t.state()
    keys = t.delta_keys(base)
    ingest_batch(t, _rows(t, leg(events, "W_b")), "b3")
    gen = f"{base.version + 1:010d}-run"
    fold(t, keys, gen)
    # written but not published: not visible, no duplicates
    assert _ids(t.snapshot()) == all_ids
    t.publish(base, list(base.gens) + [gen], list(base.folded) + keys)
    assert _ids(t.snapshot()) == all_ids
    # the next run folds the rest
    res = compact(t)
    assert res.keys == ["b3"]
    assert _ids(t.snapshot()) == all_ids
    assert t.delta_keys() == []


def test_second_publisher_refused(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    base = t.state()
    keys = t.delta_keys(base)
    fold(t, keys, "0000000001-a")
    fold(t, keys, "0000000001-b")
    t.publish(base, ["0000000001-a"], keys)
    with pytest.raises(PublishConflict):
        t.publish(base, ["0000000001-b"], keys)
    assert _ids(t.snapshot()) == _ids(events.select(F.col("event_id").alias("eventid")))


def test_replay_of_committed_and_folded_key(spark, table, events):
    t = table
    rows = _rows(t, events)
    assert ingest_batch(t, rows, "q-0").written
    assert ingest_batch(t, rows, "q-0").reason == "committed"
    compact(t)
    assert ingest_batch(t, rows, "q-0").reason == "folded"
    vacuum(t, retention_s=0)
    assert not fs.exists(spark, t.key_path("q-0"))
    assert ingest_batch(t, rows, "q-0").reason == "folded"
    assert t.snapshot().count() == events.count()


def test_leftover_without_marker_is_overwritten(spark, table, events):
    t = table
    rows = _rows(t, events)
    ingest_batch(t, rows, "q-0")
    os.remove(t.key_path("q-0").removeprefix("file:") + "/_SUCCESS")  # a write that died before its commit
    assert t.snapshot().count() == 0            # uncommitted: invisible
    assert ingest_batch(t, rows, "q-0").written
    assert t.snapshot().count() == events.count()


def test_empty_batch(spark, table, events):
    t = table
    res = ingest_batch(t, _rows(t, events.where("false")), "q-0", skip_empty=True)
    assert res.reason == "empty" and not t.is_committed("q-0")
    res = ingest_batch(t, _rows(t, events.where("false")), "q-1")
    assert res.written and t.is_committed("q-1")     # committed, with no data files
    assert t.snapshot().count() == 0
    compact(t)
    assert t.snapshot().count() == 0


def test_vacuum_keeps_recent_and_listed(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    fold(t, ["b1"], "0000000009-orphan")        # never published
    compact(t)
    removed = vacuum(t, retention_s=3600)
    assert removed == {"keys": [], "gens": []}
    removed = vacuum(t, retention_s=0)
    assert removed["keys"] == ["b1"] and removed["gens"] == ["0000000009-orphan"]
    assert t.snapshot().count() == events.count()


def test_partition_values_read_back_unchanged(spark, tmp_root):
    spec = TableSpec.from_ddl("eventid string, ts string", "dt string, appid string, storeid string")
    t = LogicalTable.create(spark, f"{tmp_root}/trap", spec)
    df = spark.createDataFrame([("1", "2024-01-01T00:00:00Z", "20240101", "007", "0905")],
                               "eventid string, ts string, dt string, appid string, storeid string")
    ingest_batch(t, df, "k")
    r = t.write_leg(["k"]).collect()[0]
    assert (r.dt, r.appid, r.storeid) == ("20240101", "007", "0905")
    compact(t)
    r = t.snapshot().collect()[0]
    assert (r.dt, r.appid) == ("20240101", "007")


def test_view_columns_and_reference_columns(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    assert t.snapshot().columns == EVENTS_SPEC.column_names + ["dt", "appid"]
    assert t.snapshot(reference_columns=True).columns == EVENTS_SPEC.column_names
    t.register_view("v_events_test")
    assert spark.sql("select count(*) from v_events_test").collect()[0][0] == events.count()


def test_pruning_reaches_both_legs(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, leg(events, "R")), "b1")
    compact(t)
    ingest_batch(t, _rows(t, leg(events, "W_a")), "b2")
    q = t.snapshot().where("dt = '20240105' and appid = 'click'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(dt") == 2


def test_compaction_file_bound(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    res = compact(t, files_per_partition=3)
    got = files_per_partition(t, res.gen).collect()
    assert got and all(r.n_files <= 3 for r in got)
    assert any(r.n_files > 1 for r in got)
    res2 = compact(t)
    assert res2.gen is None


def test_compaction_rebalance_layout(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    compact(t, files_per_partition=None)
    assert t.snapshot().count() == events.count()


def test_vacuum_forget_keeps_state_small(spark, table, events):
    t = table
    ingest_batch(t, _rows(t, events), "b1")
    compact(t)
    removed = vacuum(t, retention_s=0, forget=True)
    assert removed["forgotten"] == ["b1"]
    assert t.state().folded == ()
    assert t.snapshot().count() == events.count()


def test_catalog_view_follows_state(spark, table, events):
    from tidelog.plans.maintain import register_areas, register_catalog_view
    t = table
    ingest_batch(t, _rows(t, leg(events, "R")), "b1")
    compact(t)
    ingest_batch(t, _rows(t, leg(events, "W_a")), "b2")
    register_areas(t, "cv_write", "cv_read")
    register_catalog_view(t, "v_cv", "cv_write", "cv_read")
    n_ra = leg(events, "R").count() + leg(events, "W_a").count()
    assert spark.table("v_cv").count() == n_ra
    plan = spark.table("v_cv").where("dt = '20240105'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters") == 2   # both legs pruned by dt and gen/key
    compact(t)                                   # b2 moves to the read area
    register_catalog_view(t, "v_cv", "cv_write", "cv_read")
    assert spark.table("v_cv").count() == n_ra   # still once


@pytest.mark.parametrize("crash_after", ["freeze", "fold", "publish"])
def test_compaction_crash_and_rerun(spark, table, events, crash_after):
    """A compaction that dies after any step leaves the snapshot exact; the
    next run finishes the job and the leftovers are never read."""
    t = table
    all_ids = _ids(events.select(F.col("event_id").alias("eventid")))
    ingest_batch(t, _rows(t, leg(events, "R")), "b1")
    ingest_batch(t, _rows(t, leg(events, "W_a")), "b2")
    base = t.state()
    keys = t.delta_keys(base)
    if crash_after in ("fold", "publish"):
        fold(t, keys, f"{base.version + 1:010d}-crashed")
    if crash_after == "publish":
        t.publish(base, list(base.gens) + [f"{base.version + 1:010d}-crashed"], list(base.folded) + keys)
    ra = sorted(_ids(leg(events, "R").select(F.col("event_id").alias("eventid")))
                + _ids(leg(events, "W_a").select(F.col("event_id").alias("eventid"))))
    assert _ids(t.snapshot()) == ra                # each row once, whatever step died
    ingest_batch(t, _rows(t, leg(events, "W_b")), "b3")
    assert _ids(t.snapshot()) == all_ids
    res = compact(t)                               # the rerun
    assert res.keys == (["b3"] if crash_after == "publish" else ["b1", "b2", "b3"])
    assert _ids(t.snapshot()) == all_ids
    removed = vacuum(t, retention_s=0)
    if crash_after == "fold":
        assert removed["gens"] == [f"{base.version + 1:010d}-crashed"]
    assert _ids(t.snapshot()) == all_ids


def test_merge_gens_keeps_rows_once(spark, table, events):
    from tidelog.plans.compact import merge_gens
    t = table
    all_ids = _ids(events.select(F.col("event_id").alias("eventid")))
    for name in ("R", "W_a", "W_b"):
        ingest_batch(t, _rows(t, leg(events, name)), name)
        compact(t)
    assert len(t.state().gens) == 3
    res = merge_gens(t)
    assert t.state().gens == (res.gen,)
    assert _ids(t.snapshot()) == all_ids
    assert len(vacuum(t, retention_s=0)["gens"]) == 3
    assert _ids(t.snapshot()) == all_ids
    assert merge_gens(t).gen is None            # nothing left to merge


@pytest.mark.parametrize("mode", ["lower_all", "keep_values"])
def test_camel_case_spec(spark, tmp_root, events, mode):
    spec = TableSpec.from_ddl("eventId string, userId string, ts string, value string, props string",
                              "dt string, appid string, storeid string")
    t = LogicalTable.create(spark, f"{tmp_root}/camel", spec)
    rows = decode_and_derive(raw_log(events), t, mode=mode, tz="UTC")
    ingest_batch(t, rows, "b1")
    compact(t)
    snap = t.snapshot()
    assert snap.count() == events.count()
    assert snap.where("eventId is null or appid is null or dt is null").count() == 0
    apps = {r[0] for r in snap.select("appid").distinct().collect()}
    assert apps == ({"click", "view", "purchase", "signup", "error"} if mode == "lower_all"
                    else {"CLICK", "VIEW", "PURCHASE", "SIGNUP", "ERROR"})


def test_vacuum_keeps_gens_unlisted_within_the_retention(spark, table, events):
    """A gen written long ago but merged away just now may still be read by a
    snapshot resolved before the merge: it must survive the retention."""
    import time as _time
    from tidelog.plans.compact import merge_gens
    t = table
    for name in ("R", "W_a"):
        ingest_batch(t, _rows(t, leg(events, name)), name)
        compact(t)
    before = t.snapshot()                              # resolved before the merge
    old = _time.time() - 10 * 24 * 3600
    for g in t.state().gens:
        os.utime(t.gen_path(g).removeprefix("file:"), (old, old))
    merge_gens(t)
    removed = vacuum(t, retention_s=7 * 24 * 3600)
    assert removed["gens"] == []
    expected = leg(events, "R").count() + leg(events, "W_a").count()
    assert before.count() == expected                  # the old snapshot still reads
    later = vacuum(t, retention_s=7 * 24 * 3600, now=_time.time() + 8 * 24 * 3600)
    assert len(later["gens"]) == 2                     # unlisted long enough: removed
    assert t.snapshot().count() == expected


def test_tiers_are_merged_whole_and_once():
    from tidelog.plans.compact import gens_to_merge
    sizes = {f"s{i}": 10 for i in range(3)} | {f"m{i}": 500 for i in range(4)} | {"l": 10_000}
    sizes["m3"] = 300                                      # another tier than 500
    assert gens_to_merge(sizes, fan_in=4, base_bytes=100) == []
    assert gens_to_merge(sizes | {"s3": 90}, fan_in=4, base_bytes=100) == ["s0", "s1", "s2", "s3"]
    assert gens_to_merge({f"m{i}": 300 for i in range(4)}, fan_in=4, base_bytes=100) == [f"m{i}" for i in range(4)]


def test_upkeep_keeps_the_state_constant(spark, tmp_root, events):
    from tidelog.plans import fs
    from tidelog.streaming.apps import compaction_app
    t = LogicalTable.create(spark, f"{tmp_root}/upkeep", EVENTS_SPEC)
    some = events.limit(40)
    seen = []
    for i in range(5):
        ingest_batch(t, _rows(t, some), f"k{i}")
        compaction_app(spark, t.root, merge=True, merge_fan_in=3, retention_s=0, forget=True)
        st = t.state()
        seen.append((len(st.folded), len(st.gens), len(fs.list_names(spark, f"{t.root}/state"))))
    assert max(s[0] for s in seen) == 0
    assert max(s[1] for s in seen) <= 3 and max(s[2] for s in seen) <= 4
    assert t.snapshot().count() == 5 * some.count()
