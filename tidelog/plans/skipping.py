"""Data skipping: reads that open only the files that may hold matching rows.

A gen or key can have a manifest: one row per data file with its partition,
size and rows and, per indexed column, smallest and largest value, nulls and a
mergeable distinct sketch, and beside it Bloom filters of whole-number and
string columns. :func:`select_where` plans a snapshot from them: conditions are tested
against manifest rows by Spark, the files left are read by name (no directory
of an indexed gen or key is listed), and the same conditions filter the rows.

    compact(table, index_columns=["userid", "ts"])
    select_where(table, one_of("userid", "4711"), between("ts", "2024-01-03", "2024-01-04"))

Layout under the table root, written by the job that writes the data::

    index/files/of=<gen-…|key-…>/part-*.parquet
    index/blooms/of=<gen-…|key-…>/col=<column id>/part-*.parquet
    index/done/<gen-…|key-…>       marker: the manifest is whole

Data do not change once visible, so a manifest never goes stale. It goes with its
gen or key (``vacuum``). One that is missing, or lacks a column, only costs reads:
those gens, keys or files are read whole. The result is that of filtering
the snapshot, always.

Columns are known by id (:mod:`tidelog.plans.evolve`): a renamed column keeps its
manifest, of a widened one bounds are cast, an added one is null in
older files.

Bounds of strings are cut to 64 characters below and left open above when the
largest is longer. Nulls are in no bound and no filter. NaN is the largest number, as
in Spark's comparisons.

A Bloom filter of a file is a set of blocks, a value's block being taken from its
hash; a block holds two bitmaps of 32,768 bits, for 4,096 values on average
(16 bits a value, about 1.4 % false positives). The number of blocks is a power of
two, by the distinct values of the largest file of the gen or key. Blocks are stored
in order, so a search for a few values reads few pages.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from tidelog.operators.union import view_steady
from tidelog.operators.write import quoted
from tidelog.plans import fs
from tidelog.plans.evolve import Columns, key_versions

INDEX_AREA = "index"
BITMAP_BITS = 32768             # what one bitmap of Spark's bitmap functions holds
BLOCK_VALUES = 4096
MAX_BLOCK_POWER = 20
CUT = 64
SKETCH_LOG2 = 11
# Files named one by one in a plan; beyond it their gens and keys are read whole.
MAX_FILES = 10_000
# Values of a condition that are also pushed into the scan of the filters.
PUSHED_VALUES = 16

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_ORDERED = (*_WHOLE, DecimalType, FloatType, DoubleType, StringType, BooleanType, DateType, TimestampType,
            TimestampNTZType)


# -- conditions ---------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    """A condition on one column; several are all to hold."""

    column: str
    kind: str
    values: tuple = ()

    def rows(self, type_: DataType) -> Column:
        """The condition on rows; null counts as not met."""
        c = F.col(quoted(self.column))
        if self.kind == "missing":
            return c.isNull()
        if self.kind == "present":
            return c.isNotNull()
        if self.kind == "one_of":
            return c.isin(*[_value(v, type_) for v in self.values]) if self.values else F.lit(False)
        lo, hi = self.values
        tests = [c.isNotNull()]
        tests += [c >= _value(lo, type_)] if lo is not None else []
        tests += [c <= _value(hi, type_)] if hi is not None else []
        return _all(tests)

    def file(self, i: int, type_: DataType) -> Column:
        """Whether a file may hold a row that meets the condition; ``type_`` is
        the column's now, the file's own may be narrower."""
        s = F.col(f"c{i}")
        lo, hi, values = s["lo"].cast(type_), s["hi"].cast(type_), s["n"] - s["nulls"]
        if self.kind == "missing":
            test = s["nulls"] > 0
        elif self.kind == "present":
            test = values > 0
        elif self.kind == "one_of":
            test = _any([(lo <= v) & (hi.isNull() | (hi >= v)) for v in (_value(v, type_) for v in self.values)])
        else:
            a, b = self.values
            tests = [values > 0]
            tests += [hi.isNull() | (hi >= _value(a, type_))] if a is not None else []
            tests += [lo <= _value(b, type_)] if b is not None else []
            test = _all(tests)
        return s.isNull() | F.coalesce(test, F.lit(False))


def one_of(column: str, *values) -> Condition:
    """The column has one of the values (null is none; no value: no row)."""
    return Condition(column, "one_of", tuple(v for v in values if v is not None))


def between(column: str, lo=None, hi=None) -> Condition:
    """From ``lo`` to ``hi``, both included; None is open."""
    return Condition(column, "between", (lo, hi))


def missing(column: str) -> Condition:
    return Condition(column, "missing")


def present(column: str) -> Condition:
    return Condition(column, "present")


def _value(v, type_: DataType) -> Column:
    return F.lit(v).cast(type_)


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


# -- manifests ----------------------------------------------------------------

def _name(gen: str | None, key: str | None) -> str:
    if (gen is None) == (key is None):
        raise ValueError("either a gen or a key")
    return f"gen-{gen}" if gen is not None else f"key-{key}"


def _path(table, area: str, name: str) -> str:
    return f"{table.root}/{INDEX_AREA}/{area}/" + (name if area == "done" else f"of={name}")


def _hashed(type_: DataType) -> DataType | None:
    """The type that a column's values are hashed as; None: no Bloom filter."""
    return LongType() if isinstance(type_, _WHOLE) else StringType() if isinstance(type_, StringType) else None


def write_manifest(table, columns: list[str], gen: str | None = None, key: str | None = None) -> None:
    """The manifest of a written gen or key over the data columns ``columns``
    (those that its schema version lacks are left out). A whole one stays as it
    is; remains of a failed attempt are overwritten.

    The new data are read twice, in the indexed columns alone: once for bounds
    and sketches, once for the filters, whose size follows from the sketches. Both
    are aggregated where a file is read; what is shuffled is a row per file, and
    8 KB per 4,096 values."""
    spark, name = table.spark, _name(gen, key)
    if fs.exists(spark, _path(table, "done", name)):
        return
    ids = {f.name: (i, f.dataType) for i, f in table.columns.fields}
    for c in columns:
        if c not in ids:
            raise ValueError(f"no data column {c!r}")
        if not isinstance(ids[c][1], _ORDERED):
            raise ValueError(f"{c!r} has no order: {ids[c][1].simpleString()}")
    rows, cols = _own_rows(table, gen, key)
    there = dict(cols.fields)
    indexed = {ids[c][0]: there[ids[c][0]] for c in columns if ids[c][0] in there}
    depth = len(table.spec.partition_names if gen is None else table.read_partitions()) + 1
    file = F.substring_index(F.col("_metadata.file_path"), "/", -depth)
    src = rows.select(file.alias("file"), F.col("_metadata.file_size").alias("size"),
                      *[F.col(quoted(p)).alias(f"p_{p}") for p in table.read_partitions()],
                      *[F.col(quoted(f.name)).alias(f"c{i}") for i, f in indexed.items()])
    n = F.count(F.lit(1))
    stats = [F.struct(n.alias("n"), F.count_if(F.col(f"c{i}").isNull()).alias("nulls"),
                      *_bounds(f"c{i}", f.dataType),
                      F.max(F.length(F.col(f"c{i}").cast("string"))).cast("bigint").alias("max_len"),
                      F.hll_sketch_agg(F.col(f"c{i}").cast(_hashed(f.dataType) or StringType()), F.lit(SKETCH_LOG2))
                      .alias("distinct")).alias(f"c{i}") for i, f in indexed.items()]
    files = (src.groupBy("file", "size", *[f"p_{p}" for p in table.read_partitions()])
             .agg(n.alias("n"), *stats)
             .withColumn("leg", F.lit(name)).withColumn("fid", F.xxhash64("file")))
    files.write.mode("overwrite").parquet(_path(table, "files", name))
    bloomed = {i: _hashed(f.dataType) for i, f in indexed.items() if _hashed(f.dataType)}
    if bloomed:
        # one row: the most distinct values of a file, for each column
        most = spark.read.schema(files.schema).parquet(fs.literal(_path(table, "files", name))).agg(
            *[F.max(F.hll_sketch_estimate(f"c{i}.distinct")).alias(f"c{i}") for i in bloomed]).first()
        _blooms(src, name, bloomed, {i: _n_blocks(most[f"c{i}"]) for i in bloomed}).write.mode(
            "overwrite").partitionBy("col").parquet(_path(table, "blooms", name))
    fs.create_exclusive(spark, _path(table, "done", name), "")


def _bounds(c: str, type_: DataType) -> list[Column]:
    lo, hi = F.min(c), F.max(c)
    if isinstance(type_, StringType):
        lo, hi = F.left(lo, F.lit(CUT)), F.when(F.length(hi) <= CUT, hi)
    return [lo.alias("lo"), hi.alias("hi")]


def _n_blocks(distinct: int | None) -> int:
    power = 0
    while power < MAX_BLOCK_POWER and BLOCK_VALUES << power < (distinct or 0):
        power += 1
    return 1 << power


def _place(h: Column, bitmap: int) -> Column:
    """The bit of a hash in one of the two bitmaps of its block."""
    return F.shiftrightunsigned(h, MAX_BLOCK_POWER + 15 * bitmap).bitwiseAND(F.lit(BITMAP_BITS - 1))


def _blooms(src: DataFrame, name: str, types: dict[int, DataType], blocks: dict[int, int]) -> DataFrame:
    hashes = F.array(*[F.struct(F.lit(i).alias("col"), F.lit(blocks[i]).cast("bigint").alias("blocks"),
                                F.when(F.col(f"c{i}").isNotNull(), F.xxhash64(F.col(f"c{i}").cast(t))).alias("h"))
                       for i, t in types.items()])
    h = F.col("h")
    return (src.select(F.xxhash64("file").alias("fid"), F.inline(F.filter(hashes, lambda x: x["h"].isNotNull())))
            .groupBy("fid", "col", "blocks", h.bitwiseAND(F.col("blocks") - 1).alias("block"))
            .agg(F.bitmap_construct_agg(_place(h, 0)).alias("bits0"), F.bitmap_construct_agg(_place(h, 1)).alias("bits1"))
            .withColumn("leg", F.lit(name))
            .sortWithinPartitions("col", "blocks", "block"))


def _own_rows(table, gen: str | None, key: str | None) -> tuple[DataFrame, Columns]:
    """Rows of a gen or key in its own schema version."""
    st = table.state()
    if gen is not None:
        v = st.gen_specs.get(gen, 0) if gen in st.gens else table.spec_version
        cols = st.columns(v)
        return table._read_paths(table.read_path, [table.gen_path(gen)], table.read_schema(cols.struct)), cols
    v = key_versions(table.spark, table.root, list(range(1, st.spec_version + 1))).get(key, 0)
    cols = st.columns(v)
    return table._read_paths(table.write_path, [table.key_path(key)], table.write_schema(cols.struct)), cols


def index_missing(table, columns: list[str], keys: bool = True) -> list[str]:
    """Writes the manifests that visible gens (and keys) lack; returns their names."""
    st = table.state()
    now, done = table.at(st), set(fs.list_names(table.spark, f"{table.root}/{INDEX_AREA}/done"))
    todo = [(g, None) for g in st.gens] + ([(None, k) for k in table.delta_keys(st)] if keys else [])
    new = [(g, k) for g, k in todo if _name(g, k) not in done]
    for g, k in new:
        write_manifest(now, columns, gen=g, key=k)
    return [_name(g, k) for g, k in new]


def drop_manifest(table, gen: str | None = None, key: str | None = None) -> None:
    """The marker goes first, so that a manifest is whole or not there."""
    for area in ("done", "files", "blooms"):
        fs.delete(table.spark, _path(table, area, _name(gen, key)))


# -- reads --------------------------------------------------------------------

def _legs(table, st) -> tuple[dict[str, tuple], list[tuple]]:
    """Visible gens and keys with a manifest (by its name) and without:
    (is a gen, name, schema version)."""
    delta = table.delta_keys(st)
    latest = table.state() if delta else st
    versions = key_versions(table.spark, table.root, list(range(1, latest.spec_version + 1))) if delta else {}
    done = set(fs.list_names(table.spark, f"{table.root}/{INDEX_AREA}/done"))
    legs = ([(True, g, st.gen_specs.get(g, 0)) for g in st.gens]
            + [(False, k, versions.get(k, 0)) for k in delta])
    names = {_name(x if g else None, None if g else x): (g, x, v) for g, x, v in legs}
    return {n: leg for n, leg in names.items() if n in done}, [leg for n, leg in names.items() if n not in done]


def files_where(table, *conditions: Condition, state=None) -> DataFrame:
    """(leg, file, size, n) of the indexed files that may hold a row that meets
    all conditions; ``file`` is the path below its gen or key, URI-encoded."""
    st = state or table.state()
    return _files_where(table.at(st), conditions, st, _legs(table.at(st), st)[0])


def _files_where(table, conditions, st, legs: dict[str, tuple]) -> DataFrame:
    spark, latest = table.spark, table.state()
    parts = table.read_partitions()
    part_types = {p.name: p.dataType for p in table.spec.partitions.fields}
    ids = {f.name: (i, f.dataType) for i, f in table.columns.fields}
    out = []
    for v in sorted({leg[2] for leg in legs.values()}):
        names = [n for n, leg in legs.items() if leg[2] == v]
        there = dict((latest if v > st.spec_version else st).columns(v).fields)
        used = sorted({ids[c.column][0] for c in conditions if c.column in ids} & set(there))
        schema = StructType.fromDDL(", ".join(
            ["leg string, file string, fid bigint, size bigint, n bigint"]
            + [f"{quoted('p_' + p)} {part_types[p].simpleString()}" for p in parts]
            + [f"c{i} struct<n: bigint, nulls: bigint, lo: {there[i].dataType.simpleString()}, "
               f"hi: {there[i].dataType.simpleString()}>" for i in used]))
        files = spark.read.schema(schema).parquet(*[fs.literal(_path(table, "files", n)) for n in names])
        for c in conditions:
            if c.column in parts:
                test = Condition(f"p_{c.column}", c.kind, c.values).rows(part_types[c.column])
            else:
                i, type_ = ids[c.column]
                test = c.file(i, type_) if i in there else F.lit(c.kind == "missing")
            files = files.where(test)
        for c in conditions:
            i, type_ = ids.get(c.column, (None, None))
            as_ = _hashed(type_) if i in there else None
            if c.kind == "one_of" and c.values and as_ and _hashed(there[i].dataType) == as_:
                hits = _hits(table, names, i, [F.xxhash64(_value(x, type_).cast(as_)) for x in c.values])
                files = (files.join(hits.withColumn("hit", F.lit(True)), ["leg", "fid"], "left")
                         .where(F.col("hit") | F.col(f"c{i}").isNull()).drop("hit"))
        out.append(files.select("leg", "file", "size", "n"))
    return reduce(DataFrame.unionAll, out) if out else spark.createDataFrame(
        [], "leg string, file string, size bigint, n bigint")


def _hits(table, names: list[str], i: int, hashes: list[Column]) -> DataFrame:
    """(leg, fid) of the files whose filter of column ``i`` has one of the hashes."""
    paths = [p for p in (f"{_path(table, 'blooms', n)}/col={i}" for n in names) if fs.exists(table.spark, p)]
    schema = "leg string, fid bigint, blocks bigint, block bigint, bits0 binary, bits1 binary"
    if not paths:       # all values of the column are null
        return table.spark.createDataFrame([], schema).select("leg", "fid")
    blooms = table.spark.read.schema(schema).option("basePath", f"{table.root}/{INDEX_AREA}/blooms").parquet(
        *map(fs.literal, paths))
    if len(hashes) <= PUSHED_VALUES:        # literals that the scan can test
        blooms = blooms.where(_any([
            (F.col("blocks") == (1 << p)) & F.col("block").isin(*[h.bitwiseAND(F.lit((1 << p) - 1)) for h in hashes])
            for p in range(MAX_BLOCK_POWER + 1)]))
    in_block = _any([(F.col("block") == h.bitwiseAND(F.col("blocks") - 1)) & _bit("bits0", _place(h, 0))
                     & _bit("bits1", _place(h, 1)) for h in hashes])
    return blooms.where(in_block).select("leg", "fid").distinct()


def _bit(bits: str, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", byte.cast("int"), F.pmod(place, F.lit(8)).cast("int"))
    return bit.bitwiseAND(F.lit(1)) == 1


def select_where(table, *conditions: Condition, state=None, reference_columns: bool = False,
                 max_files: int = MAX_FILES) -> DataFrame:
    """The snapshot's rows that meet all conditions (on data columns or read
    partitions).

    At most ``max_files`` file names come to the driver. If more may match, the
    gens and keys that they are in are read whole, and the names of these alone
    are gathered: a condition that skips little is a plain scan."""
    st = state or table.state()
    table = table.at(st)
    types = {f.name: f.dataType for f in (*table.spec.columns.fields, *table.spec.partitions.fields)}
    for c in conditions:
        if c.column not in (*table.spec.column_names, *table.read_partitions()):
            raise ValueError(f"the view has no column {c.column!r}")
    indexed, plain = _legs(table, st)
    gens = {x: [table.gen_path(x)] for g, x, _ in plain if g}
    keys = {x: [table.key_path(x)] for g, x, _ in plain if not g}
    if indexed:
        files = _files_where(table, conditions, st, indexed)
        found = files.select("leg", "file").limit(max_files + 1).collect()
        if len(found) > max_files:
            found = [(n, None) for n, in files.select("leg").distinct().collect()]
        for n, file in found:
            is_gen, x, _ = indexed[n]
            root, to = (table.gen_path(x), gens) if is_gen else (table.key_path(x), keys)
            to.setdefault(x, []).append(f"{root}/{unquote(file)}" if file else root)
    read = table.read_leg([g for g in st.gens if g in gens], st, files=gens)
    write = table.write_leg(sorted(keys), files=keys)
    rows = view_steady(read, write, table.view_columns(reference_columns=False))
    if conditions:
        rows = rows.where(_all([c.rows(types[c.column]) for c in conditions]))
    return rows.select(*map(quoted, table.view_columns(reference_columns)))


# -- statistics ---------------------------------------------------------------

def manifest_stats(table, columns: list[str], state=None) -> DataFrame:
    """(col, n, nulls, ndv, min, max, max_len) of indexed columns, merged from
    manifests; no data file is read. ``n``, ``nulls`` and ``max_len`` are exact;
    ``min`` and ``max`` (as strings, in the column's own order) are, too, but for strings
    beyond 64 characters: the smallest is cut, the largest null. ``ndv`` is a
    HyperLogLog estimate with a relative standard error of 2.3 %.

    Every visible gen and key needs a manifest (:func:`index_missing` writes
    those that lack one); else, and where a manifest lacks a column, a ValueError."""
    st = state or table.state()
    table = table.at(st)
    indexed, plain = _legs(table, st)
    if plain:
        raise ValueError(f"{len(plain)} gens or keys have no manifest; see index_missing")
    ids = {f.name: (i, f.dataType) for i, f in table.columns.fields}
    latest, parts = table.state(), []
    for v in sorted({leg[2] for leg in indexed.values()}):
        there = dict((latest if v > st.spec_version else st).columns(v).fields)
        names = [n for n, leg in indexed.items() if leg[2] == v]
        used = {c: ids[c] for c in columns if ids[c][0] in there}
        schema = StructType.fromDDL(", ".join(["n bigint"] + [
            f"c{i} struct<n: bigint, nulls: bigint, lo: {t}, hi: {t}, max_len: bigint, distinct: binary>"
            for i, t in ((i, there[i].dataType.simpleString()) for i, _ in used.values())]))
        files = table.spark.read.schema(schema).parquet(*[fs.literal(_path(table, "files", x)) for x in names])
        cells = []
        for c in columns:
            i, type_ = ids[c]
            s = F.col(f"c{i}") if c in used else None
            # a widened column's sketches may be of another type's values: they would not merge
            if s is not None and _hashed(there[i].dataType) != _hashed(type_):
                raise ValueError(f"sketches of {c!r} were made under another type; fold or merge first")
            cells.append(F.struct((s["n"] if s is not None else F.lit(0)).cast("bigint").alias("n"),
                                  (s["nulls"] if s is not None else F.col("n")).cast("bigint").alias("nulls"),
                                  (s["lo"] if s is not None else F.lit(None)).cast(type_).alias("lo"),
                                  (s["hi"] if s is not None else F.lit(None)).cast(type_).alias("hi"),
                                  (s["max_len"] if s is not None else F.lit(None)).cast("bigint").alias("max_len"),
                                  (s["distinct"] if s is not None else F.lit(None)).cast("binary").alias("distinct"),
                                  (s.isNull() if s is not None else F.lit(False)).alias("lacks")).alias(f"s_{c}"))
        parts.append(files.select("n", *cells))
    if not parts:
        return table.spark.createDataFrame([], "col string, n bigint, nulls bigint, ndv bigint, min string, "
                                               "max string, max_len bigint")
    rows = reduce(DataFrame.unionAll, parts)
    aggs = [F.sum("n").alias("n")]
    for c in columns:
        s = F.col(quoted(f"s_{c}"))
        # an open upper bound of one file leaves the whole one open
        open_ = F.max(s["hi"].isNull() & s["lo"].isNotNull())
        lacks = F.max(s["lacks"])
        aggs.append(F.struct(
            F.when(lacks, F.raise_error(F.lit(f"a manifest lacks {c}"))).otherwise(F.sum(s["nulls"])).alias("nulls"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(s["distinct"])), F.lit(0)).cast("bigint").alias("ndv"),
            F.min(s["lo"]).cast("string").alias("min"),
            F.when(~F.coalesce(open_, F.lit(False)), F.max(s["hi"])).cast("string").alias("max"),
            F.max(s["max_len"]).alias("max_len")).alias(f"s_{c}"))
    one = rows.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col"), F.coalesce("n", F.lit(0)).alias("n"),
                 *[F.col(quoted(f"s_{c}"))[x].alias(x) for x in ("nulls", "ndv", "min", "max", "max_len")])
        for c in columns])))
