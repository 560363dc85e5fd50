"""Catalog maintenance for the physical areas of a logical table.

The snapshot of :class:`~tidelog.plans.table.LogicalTable` needs no catalog.
These helpers serve users who also want the areas as catalog tables (for
SQL by name, or for cost-based optimisation):

* :func:`register_areas` — external Parquet tables over the write and read
  areas, created from the table spec;
* :func:`recover_partitions` — register partition directories written by
  path (``MSCK REPAIR TABLE``, which lists the whole table);
* :func:`add_written_partitions` — register just the directories of one new
  batch key or gen (one glob under it), the per-batch form that stays cheap
  however large the table grows;
* :func:`refresh` — drop cached file listings (``REFRESH TABLE``);
* :func:`compute_stats` — table and column statistics (``ANALYZE TABLE``);
* :func:`register_catalog_view` — a catalog view that unions the area
  tables with the snapshot's ``gen``/``key`` predicates (partition filters,
  so they prune directories), redefined after each publish;
* :func:`recreate_table` — empty a table and define it again with the same
  columns, partitions and location. Dropping an external table leaves its
  files, and a later partition recovery would bring them back, so the data
  directory is removed explicitly.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.plans import fs
from tidelog.plans.table import GEN_COL, KEY_COL, LogicalTable
from tidelog.sources.schema import TableSpec, from_catalog


def _area_spec(table: LogicalTable, area: str) -> TableSpec:
    spec = table.spec
    if table.state().evolved:
        # a catalog table reads every directory by the same names and types
        raise ValueError("an evolved table has no catalog form; query its snapshot or register_view")
    if area == "write":
        parts = [StructField(KEY_COL, StringType())] + list(spec.partitions.fields)
        return TableSpec(spec.columns, StructType(parts), table.write_path)
    parts = [StructField(GEN_COL, StringType())] + [
        f for f in spec.partitions.fields if f.name in table.read_partitions()]
    return TableSpec(spec.columns, StructType(parts), table.read_path)


def register_areas(table: LogicalTable, write_name: str, read_name: str) -> None:
    """Create (if missing) catalog tables over both areas and load their
    partitions."""
    spark = table.spark
    for name, area in ((write_name, "write"), (read_name, "read")):
        spec = _area_spec(table, area)
        if not spark.catalog.tableExists(name):
            spark.sql(spec.create_table_sql(name))
        recover_partitions(spark, name)


def register_catalog_view(table: LogicalTable, view: str, write_name: str, read_name: str,
                          reference_columns: bool = False, recover: bool = True) -> str:
    """``CREATE OR REPLACE VIEW`` over the area tables for the current state.

    Returns the view text. Redefine the view after every ingest commit or
    compaction publish to move it to the new snapshot. ``recover`` lists both
    areas to find unregistered directories; jobs that register what they write
    (:func:`add_written_partitions`) pass False and list nothing.
    """
    st = table.state()
    if st.evolved:
        raise ValueError("an evolved table has no catalog form; use register_view")
    keys = table.delta_keys(st)
    cols = ", ".join(f"`{c}`" for c in table.view_columns(reference_columns))

    def in_list(col: str, values) -> str:
        if not values:
            return "false"
        quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
        return f"`{col}` IN ({quoted})"

    if recover:
        recover_partitions(table.spark, write_name)
        recover_partitions(table.spark, read_name)
    sql = (f"CREATE OR REPLACE VIEW {view} AS "
           f"SELECT {cols} FROM {read_name} WHERE {in_list(GEN_COL, st.gens)} "
           f"UNION ALL SELECT {cols} FROM {write_name} WHERE {in_list(KEY_COL, keys)}")
    table.spark.sql(sql)
    return sql


def add_written_partitions(table: LogicalTable, catalog_table: str, key: str | None = None,
                           gen: str | None = None, chunk: int = 500) -> int:
    """Add the partition directories of one batch ``key`` (write area) or one
    ``gen`` (read area) to ``catalog_table``; returns how many were found."""
    if (key is None) == (gen is None):
        raise ValueError("give exactly one of key or gen")
    if key is not None:
        base, first = table.key_path(key), (KEY_COL, key)
        names = table.spec.partition_names
    else:
        base, first = table.gen_path(gen), (GEN_COL, gen)
        names = table.read_partitions()
    specs = []
    for d in fs.partition_dirs(table.spark, base, names):
        parts = d.rstrip("/").split("/")[-len(names):]
        values = [first] + [tuple(x.split("=", 1)) for x in parts]
        specs.append(", ".join(f"`{k}` = '{_unescape(v)}'" for k, v in values))
    for i in range(0, len(specs), chunk):
        body = " ".join(f"PARTITION ({s})" for s in specs[i:i + chunk])
        table.spark.sql(f"ALTER TABLE {catalog_table} ADD IF NOT EXISTS {body}")
    return len(specs)


def _unescape(v: str) -> str:
    """Directory value → partition value (Hive-style escaping), quoted for SQL."""
    return unquote(v).replace("\\", "\\\\").replace("'", "\\'")


def recover_partitions(spark: SparkSession, table: str) -> None:
    spark.catalog.recoverPartitions(table)


def refresh(spark: SparkSession, table: str) -> None:
    spark.catalog.refreshTable(table)


def compute_stats(spark: SparkSession, table: str, columns: bool = True,
                  partition: dict[str, str] | None = None) -> None:
    """``ANALYZE TABLE``: table and column statistics, or — with a (partial)
    partition spec — size and row counts of just those partitions, so that
    the statistics of a newly published gen cost a scan of that gen only."""
    if partition:
        spec = ", ".join(f"`{k}` = '{_unescape(v)}'" for k, v in partition.items())
        spark.sql(f"ANALYZE TABLE {table} PARTITION ({spec}) COMPUTE STATISTICS")
        return
    suffix = " FOR ALL COLUMNS" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}")


def recreate_table(spark: SparkSession, table: str, delete_data: bool = True) -> TableSpec:
    """Drop ``table`` and create it again from its own catalog schema.

    A copy of the definition, under a name of its own, stands before anything
    goes and is dropped last. The data go after the new definition stands: a run
    that dies before has lost no file, and one that dies meanwhile is repeated."""
    spec = from_catalog(spark, table)
    if not spec.location:
        raise ValueError(f"{table} has no location")
    kept = f"{table}__kept_{uuid.uuid4().hex[:12]}"
    spark.sql(spec.create_table_sql(kept))
    spark.sql(f"DROP TABLE {table}")
    spark.sql(spec.create_table_sql(table))
    if delete_data:
        fs.delete(spark, spec.location)
        fs.mkdirs(spark, spec.location)
    spark.sql(f"DROP TABLE {kept}")
    return spec
