"""Data skipping: the rows of a filtered snapshot, from the files that may hold them."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators.cluster import Cluster
from tidelog.operators.stats import column_stats
from tidelog.plans import fs
from tidelog.plans.compact import compact, merge_gens, vacuum
from tidelog.plans.evolve import add_column, drop_column, evolve, rename_column, widen_column
from tidelog.plans.skipping import (_hits, between, files_where, index_missing, manifest_stats, missing, one_of,
                                    present, select_where, write_manifest)
from tidelog.plans.table import LogicalTable
from tidelog.sources.schema import TableSpec
from tidelog.streaming.ingest import ingest_batch

INDEXED = ["id", "name", "x"]
APPS = ["a", "007", "x y+z", "p%q=r/s", "é[1]{2}*"]


@pytest.fixture
def table(spark, tmp_root):
    return LogicalTable.create(spark, tmp_root, TableSpec.from_ddl(
        "id int, name string, x double, other string", "dt string, appid string, storeid string"))


def _row(rnd, i):
    return (rnd.choice([i, i, i, None]), rnd.choice([f"n{i % 50}", "", None, "long" * 30 + str(i % 9)]),
            rnd.choice([i / 3, float("nan"), -0.0, None]), f"o{i}", f"2024010{i % 3 + 1}", rnd.choice(APPS), "0905")


def _put(t, key, rows, **kw):
    ddl = "id int, name string, x double, other string, dt string, appid string, storeid string"
    ingest_batch(t, t.spark.createDataFrame(rows, ddl), key, **kw)


def _same(got, exp):
    assert got.columns == exp.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_every_condition_gives_the_rows_of_the_filtered_snapshot(table):
    rnd = random.Random(3)
    rows = [_row(rnd, i) for i in range(160)]
    _put(table, "k0", rows[:60])
    compact(table, index_columns=INDEXED)
    _put(table, "k1", rows[60:90] + rows[60:65])
    compact(table)                                              # a gen without a manifest
    _put(table, "k2", rows[90:130], index_columns=["id"])       # one of fewer columns
    _put(table, "k3", rows[130:])
    _put(table, "k4", [], index_columns=INDEXED)                # no rows
    snap = table.snapshot()
    cases = [
        ([one_of("id", 7)], snap.id == 7),
        ([one_of("id", 3, 64, 101, 999, None)], snap.id.isin(3, 64, 101, 999)),
        ([one_of("id")], F.lit(False)),
        ([one_of("name", "")], snap.name == ""),
        ([one_of("name", "long" * 30 + "4"), between("id", 20, None)], (snap.name == "long" * 30 + "4") & (snap.id >= 20)),
        ([between("name", "long" * 30 + "5", "n2")], snap.name.between("long" * 30 + "5", "n2")),
        ([between("x", 1.0, 9.5)], snap.x.between(1.0, 9.5)),
        ([one_of("x", 0.0)], snap.x == 0.0),
        ([between("x", 1e9)], snap.x >= 1e9),                   # NaN is above all numbers
        ([missing("name"), one_of("dt", "20240102")], snap.name.isNull() & (snap.dt == "20240102")),
        ([present("id"), one_of("appid", *APPS[2:])], snap.id.isNotNull() & snap.appid.isin(*APPS[2:])),
        ([one_of("other", "o5", "o100", "o150")], snap.other.isin("o5", "o100", "o150")),
        ([], F.lit(True)),
    ]
    for conditions, test in cases:
        _same(select_where(table, *conditions), snap.where(test))
    _same(select_where(table, *cases[1][0], max_files=1), snap.where(cases[1][1]))
    _same(select_where(table, one_of("id", 7), reference_columns=True),
          table.snapshot(reference_columns=True).where("id = 7"))
    with pytest.raises(ValueError):
        select_where(table, one_of("storeid", "0905"))


def test_only_files_that_may_match_are_opened(table):
    for k in range(4):
        _put(table, f"k{k}", [(100 * k + i, f"n{i}", 0.5, "o", f"2024010{k + 1}", APPS[i % 5], "0905")
                              for i in range(40)])
        compact(table, index_columns=INDEXED)
    # an overlapping leg that bounds alone would not skip
    _put(table, "wide", [(i, "w", 0.5, "o", "20240109", APPS[0], "0905") for i in range(1, 400, 2)], index_columns=["id"])
    got = select_where(table, one_of("id", 208))        # even: the filter of the wide key says no
    assert len(got.inputFiles()) == 1 == files_where(table, one_of("id", 208)).count()
    assert [r.id for r in got.collect()] == [208]
    assert len(select_where(table, one_of("id", 5000)).inputFiles()) == 0
    assert len(select_where(table, between("id", 90, 110), one_of("dt", "20240102")).inputFiles()) == 5
    # the wide key's manifest does not know that column
    assert [r.leg for r in files_where(table, between("x", 0.6)).collect()] == ["key-wide"]
    assert files_where(table).count() == 21


def test_filters_have_no_false_negative_and_few_false_positives(table):
    n = 40_000                                          # sixteen blocks a file
    t = table
    spark = t.spark
    rows = spark.range(n).select((F.col("id") * 3).cast("int").alias("id"), F.concat(F.lit("u"), F.col("id") * 3).alias("name"),
                                 F.lit(1.0).alias("x"), F.lit("o").alias("other"), F.lit("20240101").alias("dt"),
                                 F.lit("a").alias("appid"), F.lit("0905").alias("storeid"))
    ingest_batch(t, rows, "k", files_per_partition=1, index_columns=["id", "name"])
    i = 1                                               # the id of the column "name"
    blooms = spark.read.parquet(f"{t.root}/index/blooms/of=key-k/col={i}")
    assert blooms.select("blocks").distinct().first()[0] in (8, 16) and blooms.select("fid").distinct().count() == 1
    probe = spark.range(0, 3 * n, 1).select(F.concat(F.lit("u"), "id").alias("v"), F.xxhash64(F.concat(F.lit("u"), "id")).alias("h"), "id")
    from tidelog.plans.skipping import _bit, _place
    met = (probe.join(blooms, F.col("block") == F.col("h").bitwiseAND(F.col("blocks") - 1))
           .select("id", (_bit("bits0", _place(F.col("h"), 0)) & _bit("bits1", _place(F.col("h"), 1))).alias("met")))
    inside, outside = [met.where(f"(id % 3 = 0) = {b} AND met").count() for b in ("true", "false")]
    assert inside == n
    assert outside < 0.04 * 2 * n
    plan = _hits(t, ["key-k"], i, [F.xxhash64(F.lit("u3"))])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "Or(Or(" in plan                # (blocks, block) of every size, as literals


def test_columns_are_known_by_id(table):
    rnd = random.Random(5)
    _put(table, "k0", [_row(rnd, i) for i in range(40)])
    compact(table, index_columns=["id", "name", "x"])
    _put(table, "k1", [_row(rnd, i) for i in range(40, 60)], index_columns=["id", "name"])
    t = evolve(table, rename_column("name", "label"), widen_column("id", "bigint"), drop_column("x"),
               add_column("name", "string"))
    ddl = "id bigint, label string, other string, name string, dt string, appid string, storeid string"
    ingest_batch(t, t.spark.createDataFrame([(1 << 40, "n3", "o", "new", "20240101", "a", "0905"),
                                             (3, "n4", "o", None, "20240102", "a", "0905")], ddl), "k2",
                 index_columns=["id", "label", "name"])
    snap = t.snapshot()
    for conditions, test in [([one_of("id", 3, 1 << 40)], snap.id.isin(3, 1 << 40)),
                             ([one_of("label", "n3", "n44")], snap.label.isin("n3", "n44")),
                             ([one_of("name", "new", "n3")], snap.name.isin("new", "n3")),
                             ([missing("name"), between("id", 30, 50)], snap.name.isNull() & snap.id.between(30, 50)),
                             ([between("label", "n4")], snap.label >= "n4")]:
        _same(select_where(t, *conditions), snap.where(test))
    assert {r.leg for r in files_where(t, one_of("name", "new")).collect()} == {"key-k2"}
    compact(t, index_columns=["id", "label"])
    merge_gens(t, index_columns=["id", "label"])
    snap = t.snapshot()
    _same(select_where(t, one_of("id", 1 << 40)), snap.where(snap.id == 1 << 40))


def test_manifests_go_with_their_data_and_unfinished_ones_are_not_used(table):
    _put(table, "k0", [_row(random.Random(1), i) for i in range(20)], index_columns=["id"])
    fs.delete(table.spark, f"{table.root}/index/done/key-k0")           # a crash before the marker
    assert files_where(table).count() == 0
    _same(select_where(table, one_of("id", 4)), table.snapshot().where("id = 4"))
    assert index_missing(table, ["id", "name"]) == ["key-k0"]
    assert index_missing(table, ["id", "name"]) == []
    write_manifest(table, ["id"], key="k0")                             # whole: left as it is
    assert files_where(table, one_of("name", "nothing")).count() == 0
    compact(table, index_columns=["id"])
    compact(table)
    vacuum(table, retention_s=0)
    assert fs.list_names(table.spark, f"{table.root}/index/files") == [f"of=gen-{table.state().gens[0]}"]
    _same(select_where(table, one_of("id", 4)), table.snapshot().where("id = 4"))
    with pytest.raises(ValueError):
        write_manifest(table, ["storeid"], gen=table.state().gens[0] + "x")


def test_statistics_are_merged_from_manifests(table):
    rnd = random.Random(9)
    for k in range(3):
        _put(table, f"k{k}", [_row(rnd, i) for i in range(300 * k, 300 * k + 400)])
        if k < 2:
            compact(table, index_columns=["id", "other"])
    with pytest.raises(ValueError):
        manifest_stats(table, ["id"])
    index_missing(table, ["id", "other"])
    for gen in table.state().gens:      # statistics need no data file
        names = fs.partition_dirs(table.spark, table.gen_path(gen), ["dt", "appid"])
        assert names
    got = {r["col"]: r for r in manifest_stats(table, ["id", "other"]).collect()}
    snap = table.snapshot()
    for r in column_stats(snap.select("id", "other"), exact=True).collect():
        g = got[r["col"]]
        assert (g.n, g.nulls, g.max_len) == (r.n, r.nulls, r.max_len)
        assert abs(g.ndv - r.ndv) <= 0.1 * r.ndv
        lo, hi = snap.agg(F.min(r["col"]).cast("string"), F.max(r["col"]).cast("string")).first()
        assert (g["min"], g["max"]) == (lo, hi)
    files = manifest_stats(table, ["id"]).inputFiles()
    assert files and all("/index/files/" in f for f in files)
    with pytest.raises(Exception, match="lacks"):
        manifest_stats(table, ["name"]).collect()


def test_a_clustered_fold_keeps_rows_and_reads_a_third(spark, tmp_root):
    ddl = "id int, name string, x double, other string"
    rnd = random.Random(11)
    rows = [(rnd.choice([*[rnd.randrange(1000)] * 8, 5, None]), f"n{rnd.randrange(1000):04d}", 0.0, "o", "20240101", "a", "0905")
            for _ in range(4000)] + [(5, "same", 0.0, "o", "20240101", "b", "0905")] * 2000
    read = []
    for name, kw in (("plain", {"files_per_partition": 16}),
                     ("curve", {"cluster": Cluster(("id", "name"), ranges=72)})):
        t = LogicalTable.create(spark, f"{tmp_root}/{name}", TableSpec.from_ddl(
            ddl, "dt string, appid string, storeid string"))
        _put(t, "k", rows)
        compact(t, index_columns=["id", "name"], **kw)
        conditions = [between("id", 300, 400), between("name", "n0300", "n0450"), one_of("appid", "a")]
        got = select_where(t, *conditions)
        snap = t.snapshot()
        _same(got, snap.where(snap.id.between(300, 400) & snap.name.between("n0300", "n0450") & (snap.appid == "a")))
        assert sorted(map(str, snap.drop("dt", "appid").collect())) == sorted(
            str(r) for r in spark.createDataFrame([r[:4] for r in rows], ddl).collect())
        assert len(got.inputFiles()) == files_where(t, *conditions).count() > 0
        read.append(files_where(t, *conditions).agg(F.sum("n")).first()[0])     # rows of the files opened
        # copies of one row are split over several files, too
        assert files_where(t, one_of("appid", "b")).count() > 1
    assert 3 * read[1] <= read[0]
    with pytest.raises(ValueError):
        compact_rows = t.snapshot()
        from tidelog.operators.write import write_partitioned
        write_partitioned(compact_rows, f"{tmp_root}/no", ["dt"], 2, cluster=Cluster(("id",)))
