"""Incremental view: rows between two marks, across folds, merges, schema changes and vacuum."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.plans import fs
from tidelog.plans.changes import ChangesGone, Mark, changes, mark
from tidelog.plans.compact import compact, fold, merge_gens, publish_rewrite, rewrite, vacuum
from tidelog.plans.evolve import add_column, evolve, rename_column
from tidelog.plans.table import LogicalTable, PublishConflict
from tidelog.sources.schema import TableSpec
from tidelog.streaming.ingest import ingest_batch


def _put(t, key, ids):
    ingest_batch(t, t.spark.createDataFrame([(i, f"2024010{i % 3 + 1}", "a", "0905") for i in ids],
                                            "id bigint, dt string, appid string, storeid string"), key)


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture
def table(spark, tmp_root):
    return LogicalTable.create(spark, tmp_root, TableSpec.from_ddl(
        "id bigint", "dt string, appid string, storeid string"))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_two_marks_under_random_work(table, seed):
    rnd = random.Random(seed)
    seen, moments, n = [], [(None, [])], 0
    for _ in range(12):
        work = rnd.choice(["put", "put", "fold", "some", "merge"])
        if work == "put":
            new = list(range(n, n + rnd.randrange(1, 4)))
            n += len(new)
            _put(table, f"k{n:03d}", new)
            seen = seen + new
        elif work == "merge":
            gens = list(table.state().gens)
            merge_gens(table, rnd.sample(gens, min(len(gens), 2)))
        else:
            compact(table, max_keys=1 if work == "some" else None)
        moments.append((mark(table), seen))
    assert _ids(table.snapshot()) == seen
    for _ in range(8):
        a, b = sorted(rnd.sample(range(len(moments)), 2))
        got = changes(table, moments[a][0], moments[b][0])
        assert got.columns == table.view_columns()
        assert _ids(got) == sorted(set(moments[b][1]) - set(moments[a][1]))


def test_empty_table_and_equal_marks(table):
    m = mark(table)
    assert _ids(changes(table, m)) == [] == _ids(changes(table, None))
    _put(table, "k", [1, 1, 2])           # repeated rows stay repeated
    assert _ids(changes(table, m)) == [1, 1, 2]
    now = Mark.from_json(mark(table).to_json())
    assert _ids(changes(table, now)) == []
    compact(table)
    assert _ids(changes(table, now)) == []
    with pytest.raises(ValueError):
        changes(table, mark(table), m)
    # the compacted area of a version alone
    assert _ids(changes(table, Mark(0), Mark(1))) == [1, 1, 2]


def test_new_gens_are_read_and_old_ones_not_looked_at(table):
    for k in range(3):
        _put(table, f"k{k}", [k])
        compact(table)
    m = mark(table)
    _put(table, "k3", [3])
    _put(table, "k4", [4])
    new = compact(table)
    fs.delete(table.spark, table.key_path("k3"))        # the gen alone serves
    fs.delete(table.spark, table.lineage_path(table.state().gens[0]))
    got = changes(table, m)
    assert _ids(got) == [3, 4]
    assert {f.split("gen=")[1].split("/")[0] for f in got.inputFiles()} == {new.gen}


def test_vacuum_ends_what_can_be_told_apart(table):
    _put(table, "k0", [0])
    early = mark(table)
    _put(table, "k1", [1])
    compact(table)
    later = mark(table)
    _put(table, "k2", [2])
    compact(table)
    merge_gens(table)
    assert _ids(changes(table, early)) == [1, 2]
    vacuum(table, retention_s=-10)
    with pytest.raises(ChangesGone):      # k1 shares its gen with an old key
        changes(table, early)
    assert _ids(changes(table, None)) == [0, 1, 2]
    with pytest.raises(ChangesGone):
        changes(table, later)             # merged with old rows
    vacuum(table, retention_s=-10, forget=True)
    names = fs.list_names(table.spark, f"{table.root}/lineage")
    assert [n for n in names if n.endswith(".json")] == [f"{g}.json" for g in table.state().gens]
    _put(table, "k3", [3])
    assert _ids(changes(table, Mark(table.state().version))) == [3]


def test_changes_across_schema_versions(table):
    _put(table, "k0", [0])
    m = mark(table)
    _put(table, "k1", [1])
    compact(table)                        # both, under the first version
    wider = evolve(table, add_column("note", "string"))
    ingest_batch(wider, table.spark.createDataFrame(
        [(2, "x", "20240101", "a", "0905")], "id bigint, note string, dt string, appid string, storeid string"), "k2")
    compact(wider)
    merge_gens(wider)
    evolve(wider, rename_column("note", "remark"))
    rows = changes(table, m).select("id", "remark").collect()
    assert sorted(map(tuple, rows)) == [(1, None), (2, "x")]


def test_finished_rewrites_are_published_on_newer_states(table):
    for k in range(2):
        _put(table, f"k{k}", [k])
        compact(table)
    _put(table, "k2", [2])
    _put(table, "k3", [3])
    base = table.state()
    fold(table, ["k2"], "a")
    fold(table, ["k2", "k3"], "both")
    rewrite(table, list(base.gens), "m")
    rewrite(table, list(base.gens), "m2")
    publish_rewrite(table, base, "m", merged=list(base.gens))
    publish_rewrite(table, base, "a", keys=["k2"])
    for lost in ({"gen": "both", "keys": ["k2", "k3"]}, {"gen": "m2", "merged": list(base.gens)}):
        with pytest.raises(PublishConflict):
            publish_rewrite(table, base, **lost)
    assert table.state().gens == ("m", "a") and table.delta_keys() == ["k3"]
    assert _ids(table.snapshot()) == [0, 1, 2, 3]


def test_a_fold_whose_keys_were_forgotten_meanwhile_is_refused(table):
    _put(table, "k0", [0])
    base = table.state()
    fold(table, ["k0"], "slow")
    compact(table)
    vacuum(table, retention_s=-10, forget=True)
    assert table.state().folded == ()
    with pytest.raises(PublishConflict):
        publish_rewrite(table, base, "slow", keys=["k0"])
    assert table.snapshot().agg(F.count(F.lit(1))).first()[0] == 1
