"""Compaction: fold committed batch keys into a new gen of the read area.

One run:

1. read the latest state ``vN`` and freeze ``keys = committed - folded``;
2. read those key directories with the declared schema, drop ``storeid`` and
   ``key``, lay the rows out by ``(dt, appid)`` (salted or rebalanced, see
   :mod:`tidelog.operators.write`) and write ``read/gen=<N+1>-<runId>``;
3. publish ``v{N+1} = {gens + [gen], folded + keys}`` with an exclusive
   create — the one atomic step that moves the rows from the write leg to
   the read leg of every later snapshot.

Ingest keeps running the whole time: a batch that commits after step 1 is
simply not in ``keys`` and stays in the write leg. A run that dies before
step 3 leaves a gen that no state lists, so nobody reads it. When another job
publishes first, the finished gen is published on the newer state as long as
both are disjoint (:func:`publish_rewrite`); a compactor whose keys were folded
by another one gets :class:`PublishConflict` and its gen stays unlisted.
:func:`vacuum` removes such leftovers and the folded key directories once no
reader can still need them.

Only history since the last run is rewritten; earlier gens are never copied
again.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import functions as F

from tidelog.operators.cluster import Cluster
from tidelog.operators.write import quoted, write_partitioned
from tidelog.plans import fs
from tidelog.plans.evolve import SPECS_AREA
from tidelog.plans.maintain import add_written_partitions, compute_stats, refresh
from tidelog.plans.skipping import drop_manifest, write_manifest
from tidelog.plans.table import (GEN_COL, INGEST_ONLY, KEY_COL, LINEAGE_AREA, LogicalTable,
                                 PublishConflict, State)

# Size-driven files; a number bounds the files per (dt, appid) directory.
DEFAULT_FILES_PER_PARTITION = None


@dataclass
class CompactionResult:
    gen: str | None
    keys: list[str]
    state: State


def fold(table: LogicalTable, keys: list[str], gen: str,
         files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
         compression: str | None = None, cluster: Cluster | None = None) -> None:
    """Write the rows of ``keys`` as gen ``gen`` (not yet visible).

    ``files_per_partition=None`` sizes files by bytes instead (adaptive
    rebalance), with no fixed bound on their number; ``cluster`` also orders
    them by several columns (:mod:`tidelog.operators.cluster`).
    """
    rows = table.write_leg(keys).drop(INGEST_ONLY, KEY_COL)
    cols = map(quoted, table.spec.column_names + table.read_partitions())
    write_partitioned(rows.select(*cols), table.gen_path(gen), table.read_partitions(),
                      files_per_partition, mode="errorifexists", compression=compression, cluster=cluster)


def rewrite(table: LogicalTable, gens: list[str], gen: str,
            files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION, compression: str | None = None,
            cluster: Cluster | None = None) -> None:
    """Write the rows of ``gens`` as gen ``gen`` (not yet visible)."""
    cols = map(quoted, table.spec.column_names + table.read_partitions())
    write_partitioned(table.read_leg(gens).select(*cols), table.gen_path(gen), table.read_partitions(),
                      files_per_partition, mode="errorifexists", compression=compression, cluster=cluster)


def publish_rewrite(table: LogicalTable, base: State, gen: str, keys: list[str] | None = None,
                    merged: list[str] | None = None, attempts: int = 20) -> State:
    """Publish ``gen``, which holds the rows of ``keys`` and of the gens
    ``merged`` and was made on the state ``base``.

    When another job publishes meanwhile, the gen goes on the newer state
    unless that job took one of the same sources: then its rows are visible
    already, and :class:`PublishConflict` is raised. So a finished rewrite is
    only lost to another one of the same rows."""
    keys, merged = set(keys or ()), set(merged or ())
    for attempt in range(attempts):
        gens = [g for g in base.gens if g not in merged] + [gen]
        try:
            return table.publish(base, gens, list(base.folded) + sorted(keys))
        except PublishConflict:
            base = table.state()
            # a folded key may be forgotten already, but then its directory is gone
            free = merged <= set(base.gens) and not keys & set(base.folded) and (
                not keys or keys <= set(table.committed_keys()))
            if attempt == attempts - 1 or not free:
                raise
    raise AssertionError("unreachable")


def compact(table: LogicalTable, files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
            run_id: str | None = None, compression: str | None = None,
            max_keys: int | None = None, catalog_table: str | None = None,
            analyze: bool = False, analyze_columns: bool = False,
            index_columns: list[str] | None = None, cluster: Cluster | None = None) -> CompactionResult:
    """Run one compaction. ``max_keys`` folds the oldest keys first and
    leaves the rest for the next run (every row stays visible either way).
    ``catalog_table`` names a catalog table over the read area to register
    the new gen's directories in after the publish; with ``analyze`` the
    statistics of those partitions are computed as well (only the new gen is
    scanned); ``analyze_columns`` computes the column statistics of the whole
    catalog table, which is one scan of all of it. ``index_columns`` writes the
    gen's manifest over these columns before the publish
    (:mod:`tidelog.plans.skipping`); ``cluster`` is that of :func:`fold`."""
    base = table.state()  # raises TableMissing: never fold without a state
    table = table.at(base)      # a gen has the columns of the state it is published on
    keys = table.delta_keys(base)
    if max_keys is not None:
        keys = keys[:max_keys]
    if not keys:
        return CompactionResult(None, [], base)
    gen = f"{base.version + 1:010d}-{run_id or uuid.uuid4().hex[:12]}"
    fold(table, keys, gen, files_per_partition, compression, cluster)
    if index_columns:
        write_manifest(table, index_columns, gen=gen)
    new = publish_rewrite(table, base, gen, keys=keys)
    if catalog_table:
        add_written_partitions(table, catalog_table, gen=gen)
        if analyze:
            compute_stats(table.spark, catalog_table, partition={GEN_COL: gen})
        if analyze_columns:
            compute_stats(table.spark, catalog_table)
        refresh(table.spark, catalog_table)
    return CompactionResult(gen, keys, new)


def merge_gens(table: LogicalTable, gens: list[str] | None = None,
               files_per_partition: int | None = DEFAULT_FILES_PER_PARTITION,
               run_id: str | None = None, compression: str | None = None,
               index_columns: list[str] | None = None, cluster: Cluster | None = None) -> CompactionResult:
    """Rewrite several gens of the read area as one (all listed gens by
    default) and swap them in the same atomic publish: the rows move from the
    old gens to the new one in one step, so each stays visible once. The old
    directories become unlisted and are removed by :func:`vacuum`.

    When another job publishes meanwhile, the swap is tried again on the new
    state as long as it still lists the chosen gens, so the work isn't lost
    (:func:`publish_rewrite`). ``index_columns`` and ``cluster`` are those of :func:`compact`."""
    base = table.state()
    table = table.at(base)
    chosen = list(base.gens) if gens is None else [g for g in base.gens if g in set(gens)]
    if len(chosen) < 2:
        return CompactionResult(None, [], base)
    new_gen = f"{base.version + 1:010d}-{run_id or uuid.uuid4().hex[:12]}"
    rewrite(table, chosen, new_gen, files_per_partition, compression, cluster)
    if index_columns:
        write_manifest(table, index_columns, gen=new_gen)
    return CompactionResult(new_gen, [], publish_rewrite(table, base, new_gen, merged=chosen))


def gen_bytes(table: LogicalTable) -> dict[str, int]:
    """Size of each listed gen, from the file system's summary."""
    out = {}
    for g in table.state().gens:
        hfs, p = fs.hadoop_fs(table.spark, table.gen_path(g))
        out[g] = int(hfs.getContentSummary(p).getLength())
    return out


def gens_to_merge(sizes: dict[str, int], fan_in: int = 8, base_bytes: int = 1 << 27) -> list[str]:
    """Gens of one size tier that are due: tiers grow by ``fan_in`` from
    ``base_bytes``; the smallest tier that holds ``fan_in`` gens is merged
    whole, so every row is rewritten once per tier, not once per run."""
    tiers: dict[int, list[str]] = {}
    for g, n in sizes.items():
        tier, top = 0, base_bytes
        while n > top:
            tier, top = tier + 1, top * fan_in
        tiers.setdefault(tier, []).append(g)
    return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan_in), [])


def vacuum(table: LogicalTable, retention_s: float = 7 * 24 * 3600.0,
           now: float | None = None, forget: bool = False) -> dict:
    """Delete what no snapshot resolved in the last ``retention_s`` seconds
    can read: key directories folded by a state published before that, and
    gens that no state published since then lists (merged away or never
    published) and whose directory is older than that.

    Folded keys stay listed in the state, so a replay of a folded batch is
    still recognised and skipped after its directory is gone. With
    ``forget=True`` the keys whose directories are gone are also dropped
    from the state (one more atomic publish), which keeps the state small;
    do it only when no stream can still replay a batch that old (a stream
    replays at most its last uncommitted batch).
    """
    now = time.time() if now is None else now
    cutoff = now - retention_s
    latest = table.state()
    # newest state that is older than the retention: what it folded is safe;
    # every gen listed by it or by any later state may still be read
    old = None
    listed: set[str] = set()
    for v in range(latest.version, -1, -1):
        if not fs.exists(table.spark, table.state_path(v)):
            break       # forgotten states
        st = table.state(v)
        listed.update(st.gens)
        if st.created <= cutoff:
            old = st
            break
    removed = {"keys": [], "gens": []}
    if old is not None:
        folded = set(old.folded)
        for name in fs.list_names(table.spark, table.write_path):
            key = name.split("=", 1)[1] if name.startswith(f"{KEY_COL}=") else None
            if key in folded:
                drop_manifest(table, key=key)
                fs.delete(table.spark, table.key_path(key))
                for v in range(1, len(latest.evolved) + 1):
                    fs.delete(table.spark, f"{table.root}/{SPECS_AREA}/{v}/{key}")
                removed["keys"].append(key)
    for name in fs.list_names(table.spark, table.read_path):
        if not name.startswith(f"{GEN_COL}="):
            continue
        gen = name.split("=", 1)[1]
        path = table.gen_path(gen)
        # unlisted since before the cutoff (or never listed), and not being written
        if gen not in listed and fs.mtime(table.spark, path) <= cutoff:
            drop_manifest(table, gen=gen)
            fs.delete(table.spark, path)
            removed["gens"].append(gen)
    if forget and old is not None:
        gone = set(old.folded) - {n.split("=", 1)[1] for n in fs.list_names(table.spark, table.write_path)
                                  if n.startswith(f"{KEY_COL}=")}
        if gone:
            cur = table.state()
            table.publish(cur, list(cur.gens), [k for k in cur.folded if k not in gone])
            removed["forgotten"] = sorted(gone)
        # states before the newest one outside the retention serve no reader
        for v in range(old.version - 1, -1, -1):
            path = table.state_path(v)
            if not fs.exists(table.spark, path):
                break
            fs.delete(table.spark, path)
        # lineage between states that are gone; a gen not published yet is young
        for name in fs.list_names(table.spark, f"{table.root}/{LINEAGE_AREA}"):
            path = f"{table.root}/{LINEAGE_AREA}/{name}"
            if name.removesuffix(".json") not in listed and fs.mtime(table.spark, path) <= cutoff:
                fs.delete(table.spark, path)
    return removed


def files_per_partition(table: LogicalTable, gen: str):
    """Number of data files and rows in each ``(dt, appid)`` directory of a gen."""
    df = table.read_leg([gen])
    return (df.select(*table.read_partitions(), F.col("_metadata.file_path").alias("f"))
            .groupBy(*table.read_partitions())
            .agg(F.count_distinct("f").alias("n_files"), F.count("*").alias("n")))
