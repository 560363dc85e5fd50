"""Offset ledger: each record of a topic enters a table once, whatever reads it.

A batch key makes a replay of the same query harmless, but it says nothing of
another query: with a lost checkpoint, rewound start offsets, or two streams on one
topic, the same records come again under other keys. The ledger keeps the offset
intervals that each key took per topic partition, and a batch takes only records
outside of all of them.

::

    <root>/ledger/v<N>.json               {"key", "intervals"} or {"merged"}, in one order
    <root>/ledger/intervals/<name>/       topic, partition, from_offset, until_offset

One batch:

1. its exact intervals are found (maximal runs, so a gap is never taken for
   records), and compared with those of the ledger;
2. records inside them are left out; without an overlap the batch stays as it is,
   with no join. Records twice in a batch are taken once;
3. the data are written without the commit marker;
4. entry ``N + 1`` is created, if it does not exist yet. When another writer was
   first, its intervals are compared too: if they are disjoint the next number is
   tried, else the batch is trimmed and written again;
5. the marker commits the key.

Step 4 decides. A crash before it leaves data nobody reads, which a replay
overwrites; after it, the data are whole, and the next batch of any writer sets the
marker (:func:`roll_forward`), so nothing is lost with a checkpoint either.

Records without a topic, partition or offset cannot be told apart; they are
taken as they come. Cost: the batch's offsets are read once more; the ledger holds
a row per run of offsets, and is merged into one entry every ``MERGE_AFTER`` batches.
Runs are sorted and swept within blocks of offsets, never compared pair by pair, so
the work grows with the records however scattered a batch's offsets are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.write import quoted, write_partitioned
from tidelog.plans import fs
from tidelog.plans.evolve import mark_key
from tidelog.plans.table import LogicalTable

LEDGER_AREA = "ledger"
INTERVALS = "topic string, partition int, from_offset bigint, until_offset bigint"
BLOCK = 1 << 16         # offsets that meet in one row while runs are sought
MERGE_AFTER = 64
_WHERE = ["topic", "partition"]


# -- intervals ----------------------------------------------------------------

def _block(offset: Column) -> Column:
    return F.floor(offset / F.lit(BLOCK)).cast("bigint")


def _tracked(records: DataFrame) -> DataFrame:
    return records.where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL")


def offset_runs(records: DataFrame) -> DataFrame:
    """Maximal runs of offsets of ``records(topic, partition, offset)``.

    Runs are found in blocks of offsets and stitched at their borders, so
    a hot topic partition is many groups."""
    offsets = _tracked(records).select(*_WHERE, _block(F.col("offset")).alias("block"), "offset").distinct()
    # offsets of one run grow as fast as their rank does
    rank = F.row_number().over(Window.partitionBy(*_WHERE, "block").orderBy("offset"))
    runs = offsets.withColumn("run", F.col("offset") - rank).groupBy(*_WHERE, "block", "run").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
    return _stitched(runs)


def coalesced(intervals: DataFrame) -> DataFrame:
    """The union of intervals as disjoint ones that do not touch. They are cut
    into blocks for it, so a hot topic partition is many groups."""
    return _stitched(_islands(_pieces(intervals), "block"))


def _islands(intervals: DataFrame, *within: str) -> DataFrame:
    """The union of the intervals of each topic partition and ``within``."""
    order = Window.partitionBy(*_WHERE, *within).orderBy("from_offset", "until_offset")
    reach = F.max("until_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = intervals.withColumn("new", F.when(F.col("from_offset") <= reach, 0).otherwise(1))
    return (new.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*_WHERE, *within, "island").agg(F.min("from_offset").alias("from_offset"),
                                                     F.max("until_offset").alias("until_offset"))
            .drop("island"))


def _stitched(runs: DataFrame) -> DataFrame:
    """Maximal runs of blocks as those of their topic partitions: only the runs at
    a border of a block, at most two of each, meet in one group."""
    first = F.col("block") * F.lit(BLOCK)
    inner = (F.col("from_offset") > first) & (F.col("until_offset") < first + F.lit(BLOCK))
    lone = runs.withColumn("lone", F.when(inner, F.col("from_offset")))
    return _islands(lone, "lone").select(*_WHERE, "from_offset", "until_offset")


def _pieces(intervals: DataFrame) -> DataFrame:
    """Intervals cut at the borders of blocks."""
    last = _block(F.col("until_offset") - 1)
    cut = intervals.select("*", F.explode(F.sequence(_block(F.col("from_offset")), last)).alias("block"))
    first = F.col("block") * F.lit(BLOCK)
    return cut.select(*_WHERE, "block", F.greatest("from_offset", first).alias("from_offset"),
                      F.least("until_offset", first + F.lit(BLOCK)).alias("until_offset"))


def overlaps(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """The common part of two sets of intervals."""
    hull = mine.groupBy(*_WHERE).agg(F.min("from_offset").alias("lo"), F.max("until_offset").alias("hi"))
    # long histories are cut to the reach of the batch first
    near = theirs.join(F.broadcast(hull), _WHERE).where("from_offset < hi AND until_offset > lo").select(
        *_WHERE, F.greatest("from_offset", "lo").alias("from_offset"), F.least("until_offset", "hi").alias("until_offset"))
    # each block is swept once over the borders of both sets, with the number of open intervals of either
    borders = _borders(mine, "mine").unionByName(_borders(near, "theirs"), allowMissingColumns=True)
    order = Window.partitionBy(*_WHERE, "block").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = borders.select(*_WHERE, F.col("at").alias("from_offset"), F.lead("at").over(order).alias("until_offset"),
                           *[F.sum(c).over(so_far).alias(c) for c in ("mine", "theirs")])
    return coalesced(swept.where("mine > 0 AND theirs > 0 AND from_offset < until_offset").select(
        *_WHERE, "from_offset", "until_offset"))


def _borders(intervals: DataFrame, name: str) -> DataFrame:
    """Where pieces of intervals open (1) and close (-1), in the column ``name``."""
    ends = F.array(*[F.struct(F.col(c).alias("at"), F.lit(n).alias(name))
                     for c, n in (("from_offset", 1), ("until_offset", -1))])
    return _pieces(intervals).select(*_WHERE, "block", F.inline(ends))


def outside(records: DataFrame, intervals: DataFrame) -> DataFrame:
    """Records whose offset is in none of the intervals."""
    # spread by blocks before each offset becomes a row, then joined by equality
    spread = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = _pieces(intervals).repartition(spread, *_WHERE, "block").select(
        *_WHERE, F.explode(F.sequence(F.col("from_offset"), F.col("until_offset") - 1)).alias("offset"))
    return records.join(taken, [*_WHERE, "offset"], "left_anti").select(*records.columns)


# -- the ledger ---------------------------------------------------------------

def _path(table: LogicalTable, version: int) -> str:
    return f"{table.root}/{LEDGER_AREA}/v{version:010d}.json"


def _entries(table: LogicalTable) -> tuple[int, list[dict]]:
    """Number of the last entry, and the entries since the last merged one, it
    included."""
    names = [n for n in fs.list_names(table.spark, f"{table.root}/{LEDGER_AREA}") if n.startswith("v")]
    versions = sorted((int(n[1:-5]) for n in names if n.endswith(".json")), reverse=True)
    out = []
    for v in versions:
        out.append({**json.loads(fs.read_text(table.spark, _path(table, v))), "version": v})
        if "merged" in out[-1]:
            break
    return (versions[0] if versions else 0), out


def _read(table: LogicalTable, entries: list[dict]) -> DataFrame:
    paths = [f"{table.root}/{LEDGER_AREA}/intervals/{e.get('merged') or e['intervals']}" for e in entries]
    if not paths:
        return table.spark.createDataFrame([], INTERVALS)
    return table.spark.read.schema(INTERVALS).parquet(*map(fs.literal, paths))


def _write(table: LogicalTable, intervals: DataFrame, name: str) -> None:
    intervals.write.mode("overwrite").parquet(f"{table.root}/{LEDGER_AREA}/intervals/{name}")


def ledger_intervals(table: LogicalTable) -> DataFrame:
    """(topic, partition, from_offset, until_offset) of all records taken."""
    return coalesced(_read(table, _entries(table)[1]))


def roll_forward(table: LogicalTable) -> list[str]:
    """Commits the keys that a writer entered in the ledger but had no time
    to mark; their data are whole."""
    folded, done = set(table.state().folded), []
    for e in _entries(table)[1]:
        key = e.get("key")
        if key and key not in folded and not table.is_committed(key) and fs.exists(table.spark, table.key_path(key)):
            fs.create_exclusive(table.spark, f"{table.key_path(key)}/_SUCCESS", "")
            done.append(key)
    return done


def merge_ledger(table: LogicalTable) -> bool:
    """One entry in place of all earlier ones; False if another writer was first."""
    roll_forward(table)
    version, entries = _entries(table)
    if len(entries) < 2:
        return False
    name = f"merged-{uuid.uuid4().hex[:12]}"
    _write(table, coalesced(_read(table, entries)).coalesce(1), name)
    return fs.create_exclusive(table.spark, _path(table, version + 1), json.dumps({"merged": name}))


def ingest_once(table: LogicalTable, batch: DataFrame, key: str, rows_of, files_per_partition: int | None = None,
                catalog_table: str | None = None, merge_after: int = MERGE_AFTER, attempts: int = 20):
    """Write the records of the envelope ``batch`` that no earlier key took, as
    key ``key``; ``rows_of`` turns an envelope into rows of the table."""
    from tidelog.plans.maintain import add_written_partitions, refresh
    from tidelog.streaming.ingest import BatchResult
    st = table.state()      # raises TableMissing
    roll_forward(table)
    version, entries = _entries(table)
    if key in st.folded:
        return BatchResult(key, False, "folded")
    if table.is_committed(key) or any(e.get("key") == key for e in entries):
        return BatchResult(key, False, "committed")

    name = f"{key}-{uuid.uuid4().hex[:12]}"
    own = lambda: _read(table, [{"intervals": name}])
    tracked = _tracked(batch)
    _write(table, offset_runs(batch), name)
    n, runs = tracked.count(), own().agg(F.sum(F.col("until_offset") - F.col("from_offset")).alias("n")).first()["n"] or 0
    kept, todo, against = batch, True, entries
    if n != runs:       # a record twice in this batch
        kept = tracked.dropDuplicates([*_WHERE, "offset"]).unionByName(
            batch.where("topic IS NULL OR partition IS NULL OR offset IS NULL"))
    for _ in range(attempts):
        seen = f"{name}-seen{version}"
        if against:
            _write(table, overlaps(own(), _read(table, against)), seen)
        if against and not (common := _read(table, [{"intervals": seen}])).isEmpty():
            kept, todo = outside(kept, common), True
            name = f"{key}-{uuid.uuid4().hex[:12]}"
            _write(table, offset_runs(kept), name)
        if todo:
            if st.evolved:
                mark_key(table.spark, table.root, key, table.spec_version, list(range(1, st.spec_version + 1)))
            rows = rows_of(kept).select(*map(quoted, [*table.spec.column_names, *table.spec.partition_names]))
            write_partitioned(rows, table.key_path(key), table.spec.partition_names, files_per_partition,
                              mode="overwrite", marker=False)
            todo = False
        if fs.create_exclusive(table.spark, _path(table, version + 1), json.dumps({"key": key, "intervals": name})):
            break
        was, (version, entries) = version, _entries(table)
        against = [e for e in entries if e["version"] > was]
    else:
        raise RuntimeError(f"batch {key}: other writers took {attempts} ledger entries meanwhile")
    fs.mkdirs(table.spark, table.key_path(key))
    fs.create_exclusive(table.spark, f"{table.key_path(key)}/_SUCCESS", "")
    if catalog_table:
        add_written_partitions(table, catalog_table, key=key)
        refresh(table.spark, catalog_table)
    if len(entries) >= merge_after:
        merge_ledger(table)
    return BatchResult(key, True, "written")

