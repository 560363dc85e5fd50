"""Schema evolution of a logical table.

Every column of a table has an id that never changes. The state keeps each
version of the column list; a batch key or gen belongs to the version it was
written under and is never rewritten for a change. A read takes each under its
own version and reconciles by id: a renamed column is the same column, an added
one is null in older rows, a widened one is cast, a dropped one is gone, and a
new column that takes an old name is not the old column. So a change is one
metadata publish, at any size of table.

    table = evolve(table, add_column("language", "string"),
                   rename_column("mid", "member"), widen_column("hits", "bigint"))

The gen of each version is in the state. A key's version is the name of an empty
marker under ``specs/``, set before the key's first data file, because a key is
committed by its writer alone; keys of the first version have none. A stream that
was started before a change goes on under its own version until it is
restarted on the new handle. A fold or merge writes the version of the state it
publishes on, so that old versions are read no more once their data are folded.

Partition columns do not change: their values are directory names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType, StructField, StructType, TimestampNTZType)

from tidelog.operators.write import quoted
from tidelog.plans import fs

SPECS_AREA = "specs"
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
_WHOLE = list(_DIGITS)


@dataclass(frozen=True)
class Columns:
    """One version of a table's column list: (id, field), in order, and the
    smallest id never used."""

    fields: tuple[tuple[int, StructField], ...]
    next_id: int

    @staticmethod
    def first(columns: StructType) -> "Columns":
        return Columns(tuple(enumerate(columns.fields)), len(columns.fields))

    @property
    def struct(self) -> StructType:
        return StructType([f for _, f in self.fields])

    def to_document(self) -> dict:
        return {"next_id": self.next_id, "columns": [
            {"id": i, "name": f.name, "type": f.dataType.simpleString()} for i, f in self.fields]}

    @staticmethod
    def from_document(doc: dict) -> "Columns":
        return Columns(tuple((int(c["id"]), StructType.fromDDL(f"{quoted(c['name'])} {c['type']}").fields[0])
                             for c in doc["columns"]), int(doc["next_id"]))

    def place(self, name: str) -> int:
        for k, (_, f) in enumerate(self.fields):
            if f.name == name:
                return k
        raise ValueError(f"no column {name!r}")

    def check_free(self, name: str, partitions: list[str]) -> None:
        # two names that differ in case alone would be one to Spark's resolver
        taken = {f.name.lower() for _, f in self.fields} | {p.lower() for p in partitions}
        if name.lower() in taken:
            raise ValueError(f"there is a column {name!r}")


def may_widen(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new``, exactly."""
    a, b = type(old), type(new)
    if a in _WHOLE:
        if b in _WHOLE:
            return _WHOLE.index(b) > _WHOLE.index(a)
        if b is DoubleType:
            return a is not LongType
        if b is FloatType:
            return a in (ByteType, ShortType)
        return b is DecimalType and new.precision - new.scale >= _DIGITS[a]
    if a is DecimalType and b is DecimalType:
        return old != new and new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (a, b) in ((FloatType, DoubleType), (DateType, TimestampNTZType))


def add_column(name: str, type_: str):
    """A new column at the end, null in the rows there are."""
    def change(cols: Columns, partitions: list[str]) -> Columns:
        cols.check_free(name, partitions)
        field = StructType.fromDDL(f"{quoted(name)} {type_}").fields[0]
        return Columns((*cols.fields, (cols.next_id, field)), cols.next_id + 1)
    return change


def rename_column(old: str, new: str):
    def change(cols: Columns, partitions: list[str]) -> Columns:
        k = cols.place(old)
        if old.lower() != new.lower():
            cols.check_free(new, partitions)
        i, f = cols.fields[k]
        return Columns((*cols.fields[:k], (i, StructField(new, f.dataType)), *cols.fields[k + 1:]), cols.next_id)
    return change


def widen_column(name: str, type_: str):
    """A larger type that holds every value of the old one; others are refused."""
    def change(cols: Columns, partitions: list[str]) -> Columns:
        k = cols.place(name)
        i, f = cols.fields[k]
        new = StructType.fromDDL(f"c {type_}").fields[0].dataType
        if not may_widen(f.dataType, new):
            raise ValueError(f"{name!r} cannot go from {f.dataType.simpleString()} to {new.simpleString()}")
        return Columns((*cols.fields[:k], (i, StructField(f.name, new)), *cols.fields[k + 1:]), cols.next_id)
    return change


def drop_column(name: str):
    """The column is read no more; its id is not used again."""
    def change(cols: Columns, partitions: list[str]) -> Columns:
        k = cols.place(name)
        if len(cols.fields) == 1:
            raise ValueError("a table needs a column")
        return Columns((*cols.fields[:k], *cols.fields[k + 1:]), cols.next_id)
    return change


def reconciled(df: DataFrame, written: Columns, now: Columns, others: list[str]) -> DataFrame:
    """Rows written under one version as rows of another; ``others`` are kept
    as they are."""
    there = dict(written.fields)
    cols = []
    for i, f in now.fields:
        if i in there:
            c = F.col(quoted(there[i].name))
            cols.append((c if there[i].dataType == f.dataType else c.cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *map(quoted, others))


# -- versions of keys ---------------------------------------------------------

def mark_key(spark: SparkSession, root: str, key: str, version: int, versions: list[int]) -> None:
    """Names the version that ``key`` is about to be written under. A failed
    attempt under another version leaves a marker, which goes first."""
    for v in versions:
        if v != version:
            fs.delete(spark, f"{root}/{SPECS_AREA}/{v}/{key}")
    if version:
        fs.create_exclusive(spark, f"{root}/{SPECS_AREA}/{version}/{key}", "")


def key_versions(spark: SparkSession, root: str, versions: list[int]) -> dict[str, int]:
    """Version of each key that is not of the first one."""
    return {name: v for v in versions if v for name in fs.list_names(spark, f"{root}/{SPECS_AREA}/{v}")
            if not name.startswith("_tmp-")}


def evolve(table, *changes, attempts: int = 5):
    """Publishes the column list of the current state with ``changes``
    applied; returns a handle on the new version. When another job publishes
    first, the changes are checked and applied again on its state."""
    from tidelog.plans.table import PublishConflict
    for attempt in range(attempts):
        base = table.state()
        now = table.at(base)
        cols = now.columns
        for change in changes:
            cols = change(cols, table.spec.partition_names)
        try:
            return table.at(table.publish_columns(base, cols))
        except PublishConflict:
            if attempt == attempts - 1:
                raise
    raise AssertionError("unreachable")
