"""Rows that became visible between two moments, from lineage.

A :class:`Mark` names a moment: a published state and the committed keys that
it doesn't fold. Every published gen has a document of its sources,
``lineage/<gen>.json``: the keys it folds, the gens it merges. The rows between
two marks are those of the later mark's gens and keys without those of the
earlier one; compaction and merges only move rows, so they cancel out.

Gens that both marks list are not looked at. Another gen is followed to its
sources until they are known: a gen of the earlier mark is old, a key is old if
it stood in the earlier mark's delta. A gen of new rows only is read whole; of a
gen that holds both, the new sources are read from their own directories, which
:func:`~tidelog.plans.compact.vacuum` keeps for its retention. Beyond that the
change raises :class:`ChangesGone`; nothing is guessed. The work on metadata
grows with the folds and merges between the marks, not with the table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidelog.operators.union import view_steady
from tidelog.plans import fs
from tidelog.plans.table import LogicalTable


class ChangesGone(RuntimeError):
    """What would tell the rows apart was removed after its retention."""


@dataclass(frozen=True)
class Mark:
    """What a reader has seen: a state's version and the keys beside it."""
    version: int
    delta: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "delta": list(self.delta)})

    @staticmethod
    def from_json(text: str) -> "Mark":
        d = json.loads(text)
        return Mark(int(d["version"]), tuple(d["delta"]))


def mark(table: LogicalTable) -> Mark:
    """The present moment. The state is read before the keys are listed, as a
    snapshot does."""
    st = table.state()
    return Mark(st.version, tuple(sorted(table.delta_keys(st))))


def _gens(table: LogicalTable, m: Mark | None) -> set[str]:
    if m is None:
        return set()
    if not fs.exists(table.spark, table.state_path(m.version)):
        raise ChangesGone(f"state v{m.version} of {table.root} was forgotten")
    return set(table.state(m.version).gens)


class _Sources:
    """New gens and keys between two marks."""

    def __init__(self, table: LogicalTable, old_gens: set[str], old_keys: set[str]):
        self.table, self.old_gens, self.old_keys = table, old_gens, old_keys
        self.documents: dict[str, dict] = {}

    def of(self, gen: str) -> dict:
        if gen not in self.documents:
            doc = self.table.lineage(gen)
            if doc is None:
                raise ChangesGone(f"gen {gen} of {self.table.root} has no lineage")
            self.documents[gen] = doc
        return self.documents[gen]

    def share(self, gen: str) -> str:
        """``new``, ``old`` or ``both``: whose rows the gen holds."""
        if gen in self.old_gens:
            return "old"
        doc = self.of(gen)
        found = {"old" if k in self.old_keys else "new" for k in doc["keys"]}
        found |= {self.share(g) for g in doc["gens"]}
        return found.pop() if len(found) == 1 else "both" if found else "new"

    def cover(self, gens: list[str], keys: list[str]) -> tuple[list[str], list[str]]:
        """Fewest gens and keys that hold the new rows and no others."""
        whole, single = [], [k for k in keys if k not in self.old_keys]
        for g in gens:
            kind = self.share(g)
            if kind == "new":
                whole.append(g)
            elif kind == "both":
                more, keys_of = self.cover(self.of(g)["gens"], self.of(g)["keys"])
                whole += more
                single += keys_of
        return whole, single


def changes(table: LogicalTable, since: Mark | None, until: Mark | None = None) -> DataFrame:
    """Rows visible at ``until`` (now if None) and not at ``since`` (the empty
    table if None), each once, in the view's columns under the latest schema.

    A mark of no delta keys, ``Mark(version)``, is the compacted area of that
    state alone. ``since`` must not be the later one."""
    until = until or mark(table)
    if since is not None and since.version > until.version:
        raise ValueError(f"mark v{since.version} is later than v{until.version}")
    table = table.at(table.state())
    src = _Sources(table, _gens(table, since), set(since.delta) if since else set())
    # a key beside the later state was folded by none before it
    gens, keys = src.cover(sorted(_gens(table, until)), list(until.delta))
    for name, path in [*((g, table.gen_path(g)) for g in gens), *((k, table.key_path(k)) for k in keys)]:
        if not fs.exists(table.spark, f"{path}/_SUCCESS"):
            raise ChangesGone(f"{name} of {table.root} was removed")
    return view_steady(_read_gens(table, src, gens), table.write_leg(keys), table.view_columns())


def _read_gens(table: LogicalTable, src: _Sources, gens: list[str]) -> DataFrame:
    """Gens, listed or not, under the schema versions their lineage names."""
    versions = {g: src.of(g)["spec_version"] for g in gens}
    return table._by_version(table.state(), gens, versions, table.gen_path, table.read_path, table.read_schema)
