"""Clustered layout: rows that are near in several columns go into the same file.

Each column's values are numbered by sampled quantiles, the numbers' bits are
interleaved (a Z-order curve), and within each partition directory files are
ranges of that curve. A condition on any of the columns then matches the bounds of few
files, which :mod:`tidelog.plans.skipping` reads alone.

Quantiles are those of a sample of about ``SAMPLE`` rows, whatever the size, which
goes to the driver. It decides the layout only, never which rows are written. Nulls
stand first. A row position ends the range key, so that a cell with very many
rows, copies of one row included, is split like any other range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

SAMPLE = 20_000
SEED = 7
CUT = 64
CURVE = "__curve"
PLACE = "__place"


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class Cluster:
    """Columns of the curve; ``bits`` a column (at most 62 in all); ``ranges`` fixes the
    number of ranges over all directories, by default they are sized by bytes."""

    columns: tuple[str, ...]
    ranges: int | None = None
    bits: int = 6

    def __post_init__(self):
        if not self.columns or self.bits < 1 or self.bits * len(self.columns) > 62:
            raise ValueError("a curve takes at least one column and at most 62 bits")


def quantiles(df: DataFrame, columns: tuple[str, ...], bits: int) -> dict[str, list]:
    """At most ``2 ** bits - 1`` increasing bounds of each column, from a sample."""
    n = df.count()
    picked = df.select(*[(F.left(_named(c), F.lit(CUT)) if isinstance(df.schema[c].dataType, StringType)
                          else _named(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    if n > SAMPLE:
        picked = picked.sample(fraction=SAMPLE / n, seed=SEED)
    rows = picked.collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        step = max(len(values), 1) / (1 << bits)
        out[c] = sorted({values[int(k * step)] for k in range(1, 1 << bits)}) if values else []
    return out


def _number(c: Column, bounds: list, type_: DataType, bits: int) -> Column:
    """How many of the bounds are at or below the value, by a search tree; of
    fewer bounds (a frequent value is one alone) spread over all of the bits."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit((lo << bits) // (len(bounds) + 1))
        mid = (lo + hi) // 2
        return F.when(c < F.lit(bounds[mid]).cast(type_), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return F.when(c.isNull(), F.lit(0)).otherwise(tree(0, len(bounds))).cast("bigint")


def curve(df: DataFrame, cluster: Cluster) -> Column:
    """Place of a row on the curve over the quantiles of ``df``."""
    found = quantiles(df, cluster.columns, cluster.bits)
    numbers = [_number(_named(c), found[c], df.schema[c].dataType, cluster.bits) for c in cluster.columns]
    place, m = F.lit(0).cast("bigint"), len(numbers)
    for j, x in enumerate(numbers):
        for k in range(cluster.bits):
            bit = F.shiftright(x, k).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.shiftleft(bit, k * m + m - 1 - j))
    return place


def clustered(df: DataFrame, partition_cols: list[str], cluster: Cluster) -> DataFrame:
    """``df`` in ranges of (partition, curve), each in that order."""
    columns = df.columns
    placed = df.withColumn(CURVE, curve(df, cluster)).withColumn(PLACE, F.monotonically_increasing_id())
    keys = [*map(_named, partition_cols), F.col(CURVE), F.col(PLACE)]
    ranged = (placed.repartitionByRange(cluster.ranges, *keys) if cluster.ranges
              else placed.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys).select(*map(_named, columns))
