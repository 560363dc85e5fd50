"""Partitioned Parquet writes with a declared number of files per partition.

Two layouts, and a third one of :mod:`tidelog.operators.cluster`:

``files_per_partition=None``
    Size-driven, the default of every job: a ``REBALANCE`` on the partition
    columns. Adaptive execution merges small pieces and splits a hot
    directory into chunks of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so files stay near
    that size however skewed the keys are, and no pass over the data is
    needed to find the hot ones.

``files_per_partition=n``
    At most ``n`` files in each partition directory per write, at any size
    (the contract of the ingest coalesce level and of the compaction
    repartition factor). Rows are hash-partitioned into
    ``spark.sql.shuffle.partitions`` writer tasks on the partition columns
    and, for ``n`` above one, a salt below ``n``. The salt is a row
    position, so copies of one row spread too; the shuffle is cut by the
    write, so a retried writer re-reads the same shuffled rows.

Neither layout collapses the upstream work (decode, derive) into ``n``
tasks, as ``coalesce(n)`` would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.cluster import Cluster, clustered

SALT = "__salt"


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def layout(df: DataFrame, partition_cols: list[str], files_per_partition: int | None) -> DataFrame:
    """Shuffle ``df`` so that a partitioned write meets the file contract."""
    if files_per_partition is None:
        return df.hint("rebalance", *partition_cols)
    n = int(files_per_partition)
    if n < 1:
        raise ValueError("files_per_partition must be >= 1")
    writers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(quoted(c)) for c in partition_cols]
    if n == 1:
        return df.repartition(writers, *keys)
    salted = df.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(n)))
    return salted.repartition(writers, *keys, F.col(SALT)).drop(SALT)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      files_per_partition: int | None = None, mode: str = "append",
                      compression: str | None = None, marker: bool = True,
                      cluster: Cluster | None = None) -> None:
    """Write ``df`` as Parquet under ``path``, partitioned by ``partition_cols``;
    without ``marker`` the caller commits the directory. ``cluster`` orders the rows
    of each directory along a curve and cuts files by it; a bound of files per
    directory does not go with it."""
    if cluster is not None and files_per_partition is not None:
        raise ValueError("files_per_partition cannot be combined with a clustered layout")
    laid = clustered(df, partition_cols, cluster) if cluster else layout(df, partition_cols, files_per_partition)
    w = (laid
         .write.mode(mode)
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true" if marker else "false")
         .partitionBy(*partition_cols))
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)
