"""Schema evolution: versions of the column list, reconciled by id."""

import pytest
from pyspark.sql import functions as F

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidelog.plans.compact import compact, merge_gens, vacuum
from tidelog.plans.evolve import add_column, drop_column, evolve, may_widen, rename_column, widen_column
from tidelog.plans.maintain import register_areas
from tidelog.plans.table import LogicalTable, PublishConflict
from tidelog.sources.schema import TableSpec, _ddl_struct
from tidelog.streaming.ingest import ingest_batch

SPEC = TableSpec(
    StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("hits", IntegerType())]),
    StructType([StructField(n, StringType()) for n in ("dt", "appid", "storeid")]))


def _put(spark, table, key, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    return ingest_batch(table, df.selectExpr("*", "'20240101' dt", "'007' appid", "'0905' storeid"), key)


def _seen(table, *cols):
    return sorted(map(tuple, table.snapshot().select(*cols).collect()))


def _three_versions(spark, root):
    t0 = LogicalTable.create(spark, root, SPEC)
    _put(spark, t0, "k0", [(1, "a", 10)], "id int, name string, hits int")
    t1 = evolve(t0, add_column("lang", "string"))
    _put(spark, t1, "k1", [(2, "b", 20, "en")], "id int, name string, hits int, lang string")
    t2 = evolve(t1, rename_column("name", "title"), widen_column("hits", "bigint"))
    _put(spark, t2, "k2", [(3, "c", 1 << 40, "fr")], "id int, title string, hits bigint, lang string")
    return t0, t1, t2


WANT = [(1, "a", 10, None), (2, "b", 20, "en"), (3, "c", 1 << 40, "fr")]
COLS = ("id", "title", "hits", "lang")


def test_each_key_is_read_under_its_own_version(spark, tmp_root):
    t0, t1, t2 = _three_versions(spark, f"{tmp_root}/t")
    for t in (t0, t1, t2, LogicalTable.open(spark, f"{tmp_root}/t")):     # old handles see the latest columns
        assert _seen(t, *COLS) == WANT
    assert dict(t2.snapshot().dtypes)["hits"] == "bigint"
    assert t2.snapshot().columns == ["id", "title", "hits", "lang", "dt", "appid"]


def test_old_states_keep_their_columns(spark, tmp_root):
    t0, _, t2 = _three_versions(spark, f"{tmp_root}/t")
    first = t2.state(0)
    assert t2.snapshot(state=first).columns[:3] == ["id", "name", "hits"]
    assert t0.state().spec_version == 2


def test_folds_and_merges_keep_rows(spark, tmp_root):
    t0 = LogicalTable.create(spark, f"{tmp_root}/t", SPEC)
    _put(spark, t0, "k0", [(1, "a", 10)], "id int, name string, hits int")
    compact(t0)
    t1 = evolve(t0, add_column("lang", "string"))
    _put(spark, t1, "k1", [(2, "b", 20, "en")], "id int, name string, hits int, lang string")
    # a job on the old handle folds under the new version
    compact(t0)
    t2 = evolve(t1, rename_column("name", "title"), widen_column("hits", "bigint"))
    _put(spark, t2, "k2", [(3, "c", 1 << 40, "fr")], "id int, title string, hits bigint, lang string")
    assert sorted(t2.state().gen_specs.values()) == [1]
    assert _seen(t2, *COLS) == WANT
    compact(t1)
    merge_gens(t0)
    st = t2.state()
    assert len(st.gens) == 1 and list(st.gen_specs.values()) == [2]
    vacuum(t2, retention_s=0.0)
    assert _seen(t2, *COLS) == WANT


def test_old_writers_and_failed_attempts(spark, tmp_root):
    t0, t1, t2 = _three_versions(spark, f"{tmp_root}/t")
    # a stream started before the changes goes on under its version
    _put(spark, t0, "old", [(4, "d", 40)], "id int, name string, hits int")
    assert _seen(t2, *COLS) == [*WANT, (4, "d", 40, None)]
    # an attempt under one version that left its marker, then one under another
    from tidelog.plans.evolve import mark_key
    mark_key(spark, t2.root, "again", 2, [1, 2])
    _put(spark, t1, "again", [(5, "e", 50, "de")], "id int, name string, hits int, lang string")
    assert _seen(t2, *COLS) == [*WANT, (4, "d", 40, None), (5, "e", 50, "de")]


def test_a_new_column_of_an_old_name_is_another_column(spark, tmp_root):
    t = LogicalTable.create(spark, f"{tmp_root}/t", SPEC)
    _put(spark, t, "k0", [(1, "a", 10)], "id int, name string, hits int")
    t = evolve(t, drop_column("name"), add_column("name", "double"))
    _put(spark, t, "k1", [(2, 20, 0.5)], "id int, hits int, name double")
    assert _seen(t, "id", "name") == [(1, None), (2, 0.5)]
    t = evolve(t, rename_column("id", "tmp"), rename_column("hits", "id"), rename_column("tmp", "hits"))
    assert _seen(t, "id", "hits") == [(10, 1), (20, 2)]


def test_refused_changes_publish_nothing(spark, tmp_root):
    t = LogicalTable.create(spark, f"{tmp_root}/t", SPEC)
    for bad in (add_column("NAME", "int"), add_column("dt", "string"), rename_column("x", "y"), rename_column("id", "hits"),
                widen_column("name", "bigint"), widen_column("hits", "smallint"), drop_column("nope"),
                rename_column("dt", "day")):
        with pytest.raises(ValueError):
            evolve(t, add_column("more", "int"), bad)
    assert t.state().version == 0
    t1 = evolve(t, add_column("more", "int"))
    with pytest.raises(ValueError):
        LogicalTable.create(spark, f"{tmp_root}/t", SPEC)
    assert LogicalTable.create(spark, f"{tmp_root}/t", t1.spec).spec_version == 1
    with pytest.raises(ValueError):
        register_areas(t1, "no_w", "no_r")


def test_change_meets_another_publish(spark, tmp_root, monkeypatch):
    t = LogicalTable.create(spark, f"{tmp_root}/t", SPEC)
    _put(spark, t, "k0", [(1, "a", 10)], "id int, name string, hits int")
    late = t.state()
    compact(t)          # publishes first
    with pytest.raises(PublishConflict):
        t.publish_columns(late, t.columns)
    states = iter([late])
    real = t.state
    monkeypatch.setattr(t, "state", lambda *a: next(states, None) or real(*a))
    t1 = evolve(t, add_column("lang", "string"))
    assert t1.state().version == 2 and _seen(t1, "id", "lang") == [(1, None)]


def test_filters_reach_every_version(spark, tmp_root):
    _, _, t2 = _three_versions(spark, f"{tmp_root}/t")
    plan = t2.snapshot().where((F.col("title") == "a") & (F.col("dt") == "20240101"))._jdf.queryExecution().toString()
    assert "EqualTo(name,a)" in plan and "EqualTo(title,a)" in plan
    narrow = t2.snapshot().select("lang")._jdf.queryExecution().executedPlan().toString()
    assert "hits" not in narrow.replace("hits#", "hits") or "ReadSchema: struct<lang:string>" in narrow


def test_widening_is_exact(spark):
    one = lambda t: _ddl_struct([("c", t)]).fields[0].dataType
    yes = [("tinyint", "int"), ("int", "bigint"), ("int", "double"), ("float", "double"), ("decimal(5,2)", "decimal(7,3)"),
           ("int", "decimal(10,0)"), ("date", "timestamp_ntz"), ("smallint", "float")]
    no = [("bigint", "int"), ("bigint", "double"), ("int", "float"), ("double", "float"), ("int", "int"), ("string", "int"),
          ("decimal(5,2)", "decimal(6,4)"), ("int", "decimal(9,0)"), ("int", "string"), ("decimal(5,2)", "decimal(5,2)")]
    assert all(may_widen(one(a), one(b)) for a, b in yes)
    assert not any(may_widen(one(a), one(b)) for a, b in no)
