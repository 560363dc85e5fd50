"""A logical log table: fresh write area + compacted read area + versioned state.

Layout under the table root::

    write/key=<batchKey>/dt=…/appid=…/storeid=…/part-*.parquet   (+ key=…/_SUCCESS)
    read/gen=<genId>/dt=…/appid=…/part-*.parquet                 (+ gen=…/_SUCCESS)
    state/v0000000000.json  {"version", "gens", "folded", "spec"[, "evolved", "gen_specs"]}
    specs/<version>/<batchKey>   empty marker of a key written after a schema change
    lineage/<genId>.json  {"keys", "gens", "spec_version"}: what a gen was made of
    index/…    optional manifests of gens and keys, see tidelog.plans.skipping

* An ingest batch writes one key directory; the key is committed once its
  ``_SUCCESS`` marker exists, and a committed key never changes.
* A compaction folds a frozen set of committed keys into a new gen and then
  publishes state ``v{N+1}`` (more gens, more folded keys) in one atomic,
  exclusive step. That single publish replaces the four pointer swaps and
  the lock of a pointer-based design; a gen that is not listed in the
  latest state is never read, whatever happened to the job that wrote it.
* The snapshot is ``read(gens of the state) UNION ALL write(committed keys
  not folded)``: every ingested row is visible exactly once at every moment.
  The state is read before the commit markers are listed, so a batch that
  commits while a compaction runs is still seen (in the write leg).

Both legs are read with the declared schema (never inferred: ``appid=007``
stays ``'007'``) and by explicit paths, so the listing of data files is
proportional to the live data, not to retained history.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidelog.operators.union import view_steady
from tidelog.plans import fs
from tidelog.plans.evolve import Columns, key_versions, reconciled
from tidelog.sources.schema import TableSpec

WRITE_AREA = "write"
READ_AREA = "read"
STATE_AREA = "state"
LINEAGE_AREA = "lineage"
KEY_COL = "key"
GEN_COL = "gen"
INGEST_ONLY = "storeid"


class TableMissing(RuntimeError):
    """The logical table (its state) does not exist: nothing may be written."""


class PublishConflict(RuntimeError):
    """Another writer published the same state version first."""


@dataclass(frozen=True)
class State:
    version: int
    gens: tuple[str, ...] = ()
    folded: tuple[str, ...] = ()
    spec: dict = field(default_factory=dict, compare=False)
    created: float = field(default_factory=time.time, compare=False)
    # column lists after the first, oldest first, and the gens written under one of them
    evolved: tuple[dict, ...] = field(default=(), compare=False)
    gen_specs: dict = field(default_factory=dict, compare=False)

    @property
    def spec_version(self) -> int:
        return len(self.evolved)

    def columns(self, version: int) -> Columns:
        """The column list of a version of the schema."""
        return (Columns.from_document(self.evolved[version - 1]) if version
                else Columns.first(TableSpec.from_document(self.spec).columns))

    def to_json(self) -> str:
        doc = {"version": self.version, "gens": list(self.gens), "folded": list(self.folded), "spec": self.spec,
               "created": self.created}
        if self.evolved:
            doc |= {"evolved": list(self.evolved), "gen_specs": self.gen_specs}
        return json.dumps(doc, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "State":
        d = json.loads(text)
        return State(int(d["version"]), tuple(d.get("gens", [])),
                     tuple(d.get("folded", [])), d.get("spec", {}),
                     float(d.get("created", 0.0)), tuple(d.get("evolved", [])), d.get("gen_specs", {}))


def _state_name(version: int) -> str:
    return f"v{version:010d}.json"


class LogicalTable:
    """Handle on one logical table rooted at ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, columns: Columns | None = None,
                 spec_version: int = 0):
        self.spark = spark
        self.root = fs.qualified(spark, root.rstrip("/"))
        self.spec = spec
        self.columns = columns or Columns.first(spec.columns)
        self.spec_version = spec_version
        if not spec.partition_names:
            raise ValueError("a log table needs partition columns")

    # -- creation (bootstrap) -------------------------------------------------
    @classmethod
    def create(cls, spark: SparkSession, root: str, spec: TableSpec) -> "LogicalTable":
        """Create directories and state v0 with empty lists. Safe to rerun:
        an existing table with the same spec is opened as it is."""
        t = cls(spark, root, spec)
        for area in (WRITE_AREA, READ_AREA, STATE_AREA):
            fs.mkdirs(spark, f"{t.root}/{area}")
        v0 = State(0, (), (), spec.to_document())
        there = cls._versions(spark, t.root) or not fs.create_exclusive(spark, t.state_path(0), v0.to_json())
        if there:
            t = t.at(t.state())
            if (t.spec.columns, t.spec.partitions) != (spec.columns, spec.partitions):
                raise ValueError(f"{root} already holds a table with another schema; see tidelog.plans.evolve")
        return t

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "LogicalTable":
        root = root.rstrip("/")
        names = cls._versions(spark, root)
        if not names:
            raise TableMissing(f"no logical table at {root}")
        st = State.from_json(fs.read_text(spark, f"{root}/{STATE_AREA}/{_state_name(names[-1])}"))
        return cls(spark, root, TableSpec.from_document(st.spec)).at(st)

    def at(self, st: State) -> "LogicalTable":
        """A handle on the schema version of ``st``."""
        spec = TableSpec.from_document(st.spec)
        cols = st.columns(st.spec_version)
        spec = TableSpec(cols.struct, spec.partitions, spec.location, self.spec.name)
        return LogicalTable(self.spark, self.root, spec, cols, st.spec_version)

    # -- state ----------------------------------------------------------------
    def state_path(self, version: int) -> str:
        return f"{self.root}/{STATE_AREA}/{_state_name(version)}"

    @staticmethod
    def _versions(spark: SparkSession, root: str) -> list[int]:
        out = []
        for n in fs.list_names(spark, f"{root}/{STATE_AREA}"):
            if n.startswith("v") and n.endswith(".json"):
                out.append(int(n[1:-5]))
        return sorted(out)

    def state(self, version: int | None = None) -> State:
        """The latest published state (or a given version)."""
        if version is None:
            versions = self._versions(self.spark, self.root)
            if not versions:
                raise TableMissing(f"no logical table at {self.root}")
            version = versions[-1]
        return State.from_json(fs.read_text(self.spark, self.state_path(version)))

    def publish(self, base: State, gens: list[str], folded: list[str]) -> State:
        """Publish ``base.version + 1`` atomically; fail if someone else did.
        Gens that ``base`` doesn't list were written by this handle."""
        under = {g: base.gen_specs.get(g, 0) if g in base.gens else self.spec_version for g in gens}
        new = [g for g in gens if g not in base.gens]
        if len(new) == 1:       # the sources of several could not be told apart
            self._record_lineage(new[0], sorted(set(folded) - set(base.folded)),
                                 [g for g in base.gens if g not in set(gens)])
        return self._publish(State(base.version + 1, tuple(gens), tuple(folded), base.spec, evolved=base.evolved,
                                   gen_specs={g: v for g, v in under.items() if v}))

    def publish_columns(self, base: State, columns: Columns) -> State:
        """Publish a new column list over the same data."""
        return self._publish(State(base.version + 1, base.gens, base.folded, base.spec,
                                   evolved=(*base.evolved, columns.to_document()), gen_specs=base.gen_specs))

    def _publish(self, nxt: State) -> State:
        if not fs.create_exclusive(self.spark, self.state_path(nxt.version), nxt.to_json()):
            raise PublishConflict(f"state v{nxt.version} of {self.root} exists already")
        return nxt

    def lineage_path(self, gen: str) -> str:
        return f"{self.root}/{LINEAGE_AREA}/{gen}.json"

    def _record_lineage(self, gen: str, keys: list[str], gens: list[str]) -> None:
        """Written before the gen is published; another attempt to publish the
        same gen has the same sources."""
        doc = {"keys": keys, "gens": gens, "spec_version": self.spec_version}
        fs.create_exclusive(self.spark, self.lineage_path(gen), json.dumps(doc, sort_keys=True))

    def lineage(self, gen: str) -> dict | None:
        """What a gen was made of; None if no document says so."""
        path = self.lineage_path(gen)
        return json.loads(fs.read_text(self.spark, path)) if fs.exists(self.spark, path) else None

    # -- areas and keys ---------------------------------------------------------
    @property
    def write_path(self) -> str:
        return f"{self.root}/{WRITE_AREA}"

    @property
    def read_path(self) -> str:
        return f"{self.root}/{READ_AREA}"

    def key_path(self, key: str) -> str:
        return f"{self.write_path}/{KEY_COL}={key}"

    def gen_path(self, gen: str) -> str:
        return f"{self.read_path}/{GEN_COL}={gen}"

    def committed_keys(self) -> list[str]:
        """Keys whose write finished (marker present)."""
        return [n.split("=", 1)[1] for n in fs.marked_children(self.spark, self.write_path, "_SUCCESS")
                if n.startswith(f"{KEY_COL}=")]

    def is_committed(self, key: str) -> bool:
        return fs.exists(self.spark, f"{self.key_path(key)}/_SUCCESS")

    def delta_keys(self, state: State | None = None) -> list[str]:
        st = state or self.state()
        folded = set(st.folded)
        return [k for k in self.committed_keys() if k not in folded]

    # -- schemas ----------------------------------------------------------------
    def write_schema(self, columns: StructType | None = None) -> StructType:
        return StructType(list((columns or self.spec.columns).fields)
                          + [StructField(KEY_COL, StringType())]
                          + list(self.spec.partitions.fields))

    def read_partitions(self) -> list[str]:
        return [p for p in self.spec.partition_names if p != INGEST_ONLY]

    def read_schema(self, columns: StructType | None = None) -> StructType:
        parts = [f for f in self.spec.partitions.fields if f.name != INGEST_ONLY]
        return StructType(list((columns or self.spec.columns).fields)
                          + [StructField(GEN_COL, StringType())] + parts)

    # -- legs -------------------------------------------------------------------
    def _read_paths(self, base: str, paths: list[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", base)
                .parquet(*[fs.literal(p) for p in paths]))

    def _by_version(self, st: State | None, names: list[str], versions: dict[str, int], path, base: str,
                    schema, files: dict[str, list[str]] | None = None) -> DataFrame:
        """Rows of keys or gens: each schema version in a scan of its own,
        reconciled to this handle's. ``files`` names the paths to read of each."""
        def paths(some: list[str]) -> list[str]:
            return [p for n in some for p in (files[n] if files else [path(n)])]

        if not any(versions.get(n, 0) != self.spec_version for n in names):
            return self._read_paths(base, paths(names), schema())
        legs = []
        for v in sorted({versions.get(n, 0) for n in names}):
            cols = st.columns(v)
            leg = self._read_paths(base, paths([n for n in names if versions.get(n, 0) == v]), schema(cols.struct))
            legs.append(reconciled(leg, cols, self.columns, [f.name for f in schema().fields[len(self.columns.fields):]]))
        return reduce(DataFrame.unionByName, legs)

    def write_leg(self, keys: list[str], files: dict[str, list[str]] | None = None) -> DataFrame:
        """Rows of the given batch keys (columns, key, partitions), or of the
        given files of each."""
        # a key may be of a later version than the state it is read with
        st = self._latest() if keys else None
        versions = key_versions(self.spark, self.root, list(range(1, st.spec_version + 1))) if st else {}
        return self._by_version(st, keys, versions, self.key_path, self.write_path, self.write_schema, files)

    def read_leg(self, gens: list[str], state: State | None = None,
                 files: dict[str, list[str]] | None = None) -> DataFrame:
        """Rows of the given compacted gens (columns, gen, dt, appid), or of the
        given files of each."""
        st = (state or self._latest()) if gens else None
        # a gen that is not listed was written by this handle
        versions = {g: st.gen_specs.get(g, 0) if g in st.gens else self.spec_version for g in gens} if st else {}
        return self._by_version(st, gens, versions, self.gen_path, self.read_path, self.read_schema, files)

    def _latest(self) -> State | None:
        return self.state() if self._versions(self.spark, self.root) else None

    def view_columns(self, reference_columns: bool = False) -> list[str]:
        """Columns the logical view exposes: data columns, then the read
        partitions (``dt``, ``appid``) so users can prune on them."""
        cols = list(self.spec.column_names)
        return cols if reference_columns else cols + self.read_partitions()

    def legs(self, state: State | None = None) -> tuple[DataFrame, DataFrame]:
        st = state or self.state()
        now, delta = self.at(st), self.delta_keys(st)
        return now.read_leg(list(st.gens), st), now.write_leg(delta)

    def snapshot(self, reference_columns: bool = False, state: State | None = None) -> DataFrame:
        """Every committed row exactly once: compacted gens ∪ unfolded keys,
        in the columns of the state's schema version."""
        st = state or self.state()
        read, write = self.legs(st)
        return view_steady(read, write, self.at(st).view_columns(reference_columns))

    def register_view(self, name: str, reference_columns: bool = False,
                      global_view: bool = False) -> DataFrame:
        """(Re)define the view ``name`` over the current snapshot.

        The snapshot is resolved now; define the view again to see later
        commits (as the pointer design redefines its view per stage).
        """
        df = self.snapshot(reference_columns)
        if global_view:
            df.createOrReplaceGlobalTempView(name)
        else:
            df.createOrReplaceTempView(name)
        return df
