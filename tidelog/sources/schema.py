"""Table schema: the declared columns, partitions and location of a log table.

A schema document has three lists of ``{name, type}`` objects::

    {"columns": [...], "partitions": [...], "locations": [{"name": "Location:", "type": "<uri>"}]}

Types are Spark DDL type strings; any type the DDL parser accepts works
(``string``, ``decimal(10,2)``, ``array<string>`` ...). Schemas are always
built through DDL because ``StructType.add(name, "String")`` does not parse
capitalised type names in PySpark.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from importlib import resources

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

# The key a location entry carries in the schema document (fixed value).
LOCATION_KEY = "Location:"


def _ddl_struct(pairs: list[tuple[str, str]]) -> StructType:
    if not pairs:
        return StructType([])
    ddl = ", ".join(f"`{n}` {t}" for n, t in pairs)
    return StructType.fromDDL(ddl)


@dataclass(frozen=True)
class TableSpec:
    """Declared schema of one log table."""

    columns: StructType
    partitions: StructType
    location: str | None = None
    name: str | None = None
    extra: dict = field(default_factory=dict, compare=False)

    # -- views ---------------------------------------------------------------
    @property
    def column_names(self) -> list[str]:
        return [f.name for f in self.columns.fields]

    @property
    def partition_names(self) -> list[str]:
        return [f.name for f in self.partitions.fields]

    @property
    def row_schema(self) -> StructType:
        """Columns followed by partitions: the schema a payload is decoded with."""
        return StructType(list(self.columns.fields) + list(self.partitions.fields))

    def field_list(self) -> list[tuple[int, str, str, bool]]:
        """(position, name, type, is_partition) for every field, in order."""
        out = []
        for i, f in enumerate(self.row_schema.fields):
            out.append((i, f.name, f.dataType.simpleString(),
                        f.name in self.partition_names))
        return out

    def without_partitions(self, *names: str) -> "TableSpec":
        keep = [f for f in self.partitions.fields if f.name not in names]
        return TableSpec(self.columns, StructType(keep), self.location, self.name)

    def lower(self) -> "TableSpec":
        """Same spec with lower-case names (what a Hive-style catalog returns)."""
        def low(st: StructType) -> StructType:
            return StructType([StructField(f.name.lower(), f.dataType, f.nullable)
                               for f in st.fields])
        return TableSpec(low(self.columns), low(self.partitions), self.location, self.name)

    # -- DDL -----------------------------------------------------------------
    def columns_ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns.fields)

    def partitions_ddl(self) -> str:
        return ", ".join(f"`{f.name}`" for f in self.partitions.fields)

    def create_table_sql(self, table: str, location: str | None = None) -> str:
        """``CREATE TABLE`` for an external Parquet table on ``location``."""
        loc = location or self.location
        if not loc:
            raise ValueError("a location is required to create an external table")
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in self.row_schema.fields)
        sql = f"CREATE TABLE {table} ({cols}) USING PARQUET"
        if self.partitions.fields:
            sql += f" PARTITIONED BY ({self.partitions_ddl()})"
        return sql + f" LOCATION '{loc}'"

    # -- documents -----------------------------------------------------------
    def to_document(self) -> dict:
        def lst(st: StructType):
            return [{"name": f.name, "type": f.dataType.simpleString()} for f in st.fields]
        doc = {"columns": lst(self.columns), "partitions": lst(self.partitions),
               "locations": []}
        if self.location:
            doc["locations"] = [{"name": LOCATION_KEY, "type": self.location}]
        return doc

    @staticmethod
    def from_document(doc: dict, name: str | None = None) -> "TableSpec":
        cols = [(c["name"], c["type"]) for c in doc.get("columns", [])]
        parts = [(c["name"], c["type"]) for c in doc.get("partitions", [])]
        locs = [c["type"] for c in doc.get("locations", [])
                if c.get("name") == LOCATION_KEY]
        if not cols:
            raise ValueError("schema document has no columns")
        return TableSpec(_ddl_struct(cols), _ddl_struct(parts),
                         locs[0] if locs else None, name)

    @staticmethod
    def from_ddl(columns: str, partitions: str = "", location: str | None = None,
                 name: str | None = None) -> "TableSpec":
        return TableSpec(StructType.fromDDL(columns),
                         StructType.fromDDL(partitions) if partitions else StructType([]),
                         location, name)


# ---------------------------------------------------------------------------
# S5: template documents shipped as files, looked up by (db, table)
# ---------------------------------------------------------------------------

def from_template(db: str, table: str, root: str | None = None) -> TableSpec:
    """Load ``<root>/<db>/<table>.json``; the default root is the package's
    ``resources/templates`` folder."""
    if root is None:
        ref = resources.files("tidelog").joinpath("resources", "templates", db, f"{table}.json")
        text = ref.read_text()
    else:
        with open(os.path.join(root, db, f"{table}.json")) as fh:
            text = fh.read()
    return TableSpec.from_document(json.loads(text), name=f"{db}.{table}")


# ---------------------------------------------------------------------------
# S6/S7: schema and location of a table registered in the session catalog
# ---------------------------------------------------------------------------

def from_catalog(spark: SparkSession, table: str) -> TableSpec:
    """Columns and partitions of a catalog table, in catalog order.

    ``listColumns`` flags partition columns, so each column is listed once
    (DESCRIBE FORMATTED repeats partition columns in its first block).
    """
    cols = spark.catalog.listColumns(table)
    data = [(c.name, c.dataType) for c in cols if not c.isPartition]
    parts = [(c.name, c.dataType) for c in cols if c.isPartition]
    return TableSpec(_ddl_struct(data), _ddl_struct(parts),
                     table_location(spark, table), table)


def table_location(spark: SparkSession, table: str) -> str | None:
    """Location row of ``DESCRIBE FORMATTED`` (Spark spells it without a colon)."""
    rows = (spark.sql(f"DESCRIBE FORMATTED {table}")
            .where("trim(col_name) IN ('Location', 'Location:')")
            .select("data_type").limit(1).collect())
    return rows[0][0].strip() if rows else None
