"""Table and feed statistics as distributed aggregations.

* :func:`partition_stats` — rows per partition (what a ``COMPUTE STATS``
  records per partition); counting needs no data columns, so the scan reads
  partition values only.
* :func:`column_stats` — per column: rows, nulls, distinct values, maximum
  length. By default one aggregate over the table with a HyperLogLog sketch
  per column (bounded memory, one row per task in the shuffle, whatever the
  skew), unpivoted afterwards. ``exact=True`` unpivots every row into
  ``(column, value)`` pairs and de-duplicates them with a partial aggregate
  before the shuffle, so a hot value costs one row per task.
* :func:`offset_gaps` — missing ranges and repeated records per topic partition.
* :func:`offset_ranges` — per topic partition: first offset, offset after the
  last, record count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def partition_stats(df: DataFrame, partition_cols: list[str] | None = None) -> DataFrame:
    cols = partition_cols or ["dt", "appid"]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def column_stats(df: DataFrame, columns: list[str] | None = None, exact: bool = False,
                 rsd: float = 0.05) -> DataFrame:
    cols = columns or df.columns
    if not exact:
        return _column_stats_sketch(df, cols, rsd)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in cols]))
    long = df.select(pairs.alias("p")).select("p.col", "p.v")
    return long.groupBy("col").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("v").isNull()).alias("nulls"),
        F.count_distinct("v").cast("bigint").alias("ndv"),
        F.max(F.length("v")).cast("bigint").alias("max_len"),
    )


def offset_ranges(envelope: DataFrame) -> DataFrame:
    return envelope.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + F.lit(1)).alias("until_offset"),
        F.count(F.lit(1)).alias("n"),
    )


def offset_gaps(envelope: DataFrame, block: int = 1 << 16) -> DataFrame:
    """(topic, partition, kind, from_offset, until_offset, n): what is missing
    and what came twice in the offsets of ``envelope``.

    ``gap``: a maximal range of offsets between two that are there, and its
    length. ``duplicate``: an offset of several records, and how many too many.
    Offsets before the first and after the last are no gap; records
    without a topic, partition or offset are not looked at.

    Records are counted by offset before anything is gathered, and offsets meet
    in blocks, so that neither a hot topic partition nor an offset that repeats
    is one task. Only the first and last offset of each block are ordered per
    topic partition, to find the gaps between blocks."""
    where = ["topic", "partition"]
    found = "array<struct<kind:string,from_offset:bigint,until_offset:bigint,n:bigint>>"
    row = lambda kind, a, b, n: F.struct(
        F.lit(kind).alias("kind"), a.cast("bigint").alias("from_offset"), b.cast("bigint").alias("until_offset"),
        n.cast("bigint").alias("n"))
    counted = (envelope.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL")
               .groupBy(*where, "offset").agg(F.count(F.lit(1)).alias("n")))
    blocks = (counted.groupBy(*where, F.floor(F.col("offset") / F.lit(block)).alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("offset", "n"))).alias("o")))
    gap = F.transform("o", lambda x, i: F.when(x["offset"] - F.get("o", i - 1)["offset"] > 1, row(
        "gap", F.get("o", i - 1)["offset"] + 1, x["offset"], x["offset"] - F.get("o", i - 1)["offset"] - 1)))
    twice = F.transform(F.filter("o", lambda x: x["n"] > 1), lambda x: row(
        "duplicate", x["offset"], x["offset"] + 1, x["n"] - 1))
    within = blocks.select(*where, F.inline(F.concat(
        F.filter(gap, lambda g: g.isNotNull()).cast(found), twice.cast(found))))
    edges = blocks.select(*where, "block", F.element_at("o", 1)["offset"].alias("until_offset"),
                          (F.element_at("o", -1)["offset"] + 1).alias("end"))
    before = F.lag("end").over(Window.partitionBy(*where).orderBy("block"))
    between = edges.withColumn("from_offset", before).where("until_offset > from_offset").select(
        *where, F.lit("gap").alias("kind"), "from_offset", "until_offset",
        (F.col("until_offset") - F.col("from_offset")).alias("n"))
    return within.unionByName(between)


def _column_stats_sketch(df: DataFrame, cols: list[str], rsd: float) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("string")
        aggs += [F.count_if(v.isNull()).alias(f"__z{i}"),
                 F.approx_count_distinct(v, rsd).alias(f"__d{i}"),
                 F.max(F.length(v)).alias(f"__l{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col("__n").alias("n"),
                              F.col(f"__z{i}").alias("nulls"),
                              F.col(f"__d{i}").cast("bigint").alias("ndv"),
                              F.col(f"__l{i}").cast("bigint").alias("max_len"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))
