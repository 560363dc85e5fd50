"""Statistics aggregations and the file layout of writes."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators.stats import column_stats, offset_gaps, partition_stats
from tidelog.operators.write import layout, write_partitioned


def test_column_stats_exact_and_approx(spark):
    df = spark.createDataFrame([("a", None), ("bb", "x"), ("a", "x"), (None, "yyy")], "c1 string, c2 string")
    exact = {r.col: r for r in column_stats(df, exact=True).collect()}
    assert (exact["c1"].n, exact["c1"].nulls, exact["c1"].ndv, exact["c1"].max_len) == (4, 1, 2, 2)
    assert (exact["c2"].nulls, exact["c2"].ndv, exact["c2"].max_len) == (1, 2, 3)
    approx = {r.col: r for r in column_stats(df).collect()}
    assert approx["c1"].ndv == 2


def test_column_stats_hot_value_is_preaggregated(spark):
    df = spark.range(100000).select(F.lit("same").alias("v"))
    q = column_stats(df, exact=True)
    assert q.collect()[0].ndv == 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan  # map-side partial aggregation before the shuffle


def test_partition_stats_reads_no_data_columns(spark, tmp_root, events):
    path = f"{tmp_root}/p"
    events.select("event_id", F.col("event_type").alias("appid"),
                  F.date_format("ts", "yyyyMMdd").alias("dt")).write.partitionBy("dt", "appid").parquet(path)
    df = spark.read.schema("event_id bigint, dt string, appid string").parquet(path)
    q = partition_stats(df)
    assert q.agg(F.sum("n")).collect()[0][0] == events.count()
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def _files_per_dir(spark, path):
    df = spark.read.parquet(path)
    return df.groupBy("dt").agg(F.count_distinct(F.col("_metadata.file_path")).alias("f")).collect()


def test_write_bound_and_hot_directory_split(spark, tmp_root):
    # one hot directory holds a third of the rows, all of them identical copies
    hot = spark.range(30000).select(F.lit("hot").alias("dt"), F.lit(1).alias("v"))
    cold = spark.range(60000).select((F.col("id") % 50).cast("string").alias("dt"), F.lit(1).alias("v"))
    df = hot.unionByName(cold)
    write_partitioned(df, f"{tmp_root}/w", ["dt"], files_per_partition=4)
    got = {r.dt: r.f for r in _files_per_dir(spark, f"{tmp_root}/w")}
    assert 2 <= got["hot"] <= 4                 # copies of one row are split too
    assert max(got.values()) <= 4
    assert spark.read.parquet(f"{tmp_root}/w").count() == 90000
    write_partitioned(df, f"{tmp_root}/one", ["dt"], files_per_partition=1)
    assert {r.f for r in _files_per_dir(spark, f"{tmp_root}/one")} == {1}   # at any size


def test_layout_plans(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("dt"))
    p1 = layout(df, ["dt"], 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in p1
    p2 = layout(df, ["dt"], None)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in p2


def test_union_legs(spark):
    from tidelog.operators.union import union_view, view_extended
    a = spark.createDataFrame([("1", "x", "d1")], "a string, extra string, dt string")
    b = spark.createDataFrame([("d2", "2")], "dt string, a string")
    v = view_extended(a, b, b, ["a", "dt"])
    assert v.columns == ["a", "dt"] and v.count() == 3   # no de-duplication
    import pytest
    with pytest.raises(ValueError):
        union_view([], ["a"])


def test_preview_limits_rows(spark):
    from tidelog.functions.decode import preview
    assert preview(spark.range(100), 10).count() == 10


def test_rebalance_default_splits_only_the_hot_directory(spark, tmp_root):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    old_n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        # a third of the rows in one directory, as distinct wide rows
        hot = spark.range(60000).select(F.lit("hot").alias("dt"),
                                        F.sha2(F.col("id").cast("string"), 256).alias("v"))
        cold = spark.range(120000).select((F.col("id") % 400).cast("string").alias("dt"),
                                          F.sha2(F.col("id").cast("string"), 256).alias("v"))
        write_partitioned(hot.unionByName(cold).repartition(8), f"{tmp_root}/r", ["dt"], None)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.set("spark.sql.shuffle.partitions", old_n)
    got = {r.dt: r.f for r in _files_per_dir(spark, f"{tmp_root}/r")}
    assert got["hot"] > 1                                         # split by size
    # the rest stay one file each, except a directory that shares the hot
    # directory's shuffle partition and is split along with it
    assert sum(1 for k, v in got.items() if k != "hot" and v > 1) <= 4
    assert len(got) == 401
    assert spark.read.parquet(f"{tmp_root}/r").count() == 180000


@pytest.mark.parametrize("block", [1, 4, 1 << 16])
def test_offset_gaps_equal_brute_force(spark, block):
    rnd = random.Random(block)
    records = [("t" if rnd.random() < 0.8 else "u", rnd.randrange(2), rnd.choice([rnd.randrange(40), 200 + rnd.randrange(9)]))
               for _ in range(90)]
    want = set()
    for where in {r[:2] for r in records}:
        own = sorted(o for t, p, o in records if (t, p) == where)
        there = sorted(set(own))
        want |= {(*where, "gap", a + 1, b, b - a - 1) for a, b in zip(there, there[1:], strict=False) if b - a > 1}
        want |= {(*where, "duplicate", o, o + 1, own.count(o) - 1) for o in there if own.count(o) > 1}
    df = spark.createDataFrame([*records, (None, 1, 1), ("t", None, 1), ("t", 1, None)],
                               "topic string, partition int, offset bigint")
    got = list(map(tuple, offset_gaps(df, block).collect()))
    assert sorted(got) == sorted(want)
    assert offset_gaps(df.limit(0)).count() == 0
