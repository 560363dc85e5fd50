"""

Every query replays the whole ``events`` table as a log feed (see
:mod:`tidelog.sources.events_feed`), runs it through the operator it checks
— decode, derive, ingest, stream, snapshot, compaction, catalog upkeep,
statistics — and returns a DataFrame over the result. Tables written on the
way live in a fresh folder under the session's ``spark.checkpoint.dir``.

``G`` below is the per-partition summary most queries end with:
``dt, appid, n = count(*), sv = round(sum(value), 2)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.decode import decode_json, preview
from tidelog.functions.derive import parse_ts
from tidelog.operators.cluster import Cluster
from tidelog.operators.stats import column_stats, offset_gaps, offset_ranges, partition_stats
from tidelog.operators.union import view_extended, view_steady
from tidelog.operators.write import write_partitioned
from tidelog.plans.changes import changes, mark
from tidelog.plans.compact import (compact, files_per_partition, fold, merge_gens, publish_rewrite,
                                   rewrite)
from tidelog.plans.evolve import add_column, evolve, rename_column, widen_column
from tidelog.plans.fs import list_names
from tidelog.plans.ledger import ledger_intervals
from tidelog.plans.maintain import (recover_partitions, recreate_table, refresh, register_areas,
                                    register_catalog_view)
from tidelog.plans.skipping import between, files_where, index_missing, manifest_stats, one_of, select_where
from tidelog.plans.table import LogicalTable, PublishConflict, TableMissing
from tidelog.session import prepare, work_dir
from tidelog.sources.events_feed import EVENTS_SPEC, leg, raw_log, raw_log_dirty
from tidelog.sources.schema import TableSpec, from_catalog, from_template
from tidelog.sources.stream import keep_from_offsets, read_file_stream
from tidelog.streaming.apps import compaction_app, ingest_app
from tidelog.streaming.ingest import (decode_and_derive, ingest_batch, offset_reports,
                                      start_ingest)
from tidelog.streaming.rejects import ingest_with_rejects, rejects

# The training-data operators and their pipeline are optional; a part of them
# that is there but fails to import is an error.
try:
    from tidelog.llm.registry import ORACLES as LLM_ORACLES
    from tidelog.llm.registry import QUERIES as LLM_QUERIES
except ModuleNotFoundError as e:
    if e.name not in ("tidelog.llm", "tidelog.llm.registry"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
try:
    import corpus_pipeline
except ModuleNotFoundError as e:
    if e.name != "corpus_pipeline" and not (e.name or "").startswith("tidelog.llm"):
        raise
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
# Zone the contract derives dates in, whatever the session zone is (fixed value).
CONTRACT_TZ = "UTC"
COMPACTION_FILES = 4


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _g(df: DataFrame) -> DataFrame:
    return df.groupBy("dt", "appid").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("value").cast("double")), 2).alias("sv"))


def _table(spark: SparkSession, name: str, spec: TableSpec = EVENTS_SPEC) -> LogicalTable:
    return LogicalTable.create(spark, work_dir(spark, name), spec)


def _rows(table: LogicalTable, ev: DataFrame, mode: str = "lower_all") -> DataFrame:
    return decode_and_derive(raw_log(ev), table, mode=mode, tz=CONTRACT_TZ)


def _ingest(table: LogicalTable, ev: DataFrame, key: str, **kw) -> None:
    ingest_batch(table, _rows(table, ev), key, **kw)


def _three_leg_table(spark: SparkSession, ev: DataFrame, name: str) -> LogicalTable:
    """R ingested and compacted; W_a and W_b ingested, still in the write area."""
    t = _table(spark, name)
    _ingest(t, leg(ev, "R"), "r")
    compact(t)
    _ingest(t, leg(ev, "W_a"), "w_a")
    _ingest(t, leg(ev, "W_b"), "w_b")
    return t


def _field_counts(df: DataFrame, fields: list[tuple[int, str, str, bool]],
                  alias: str = "n_values") -> DataFrame:
    """One row per declared field: position, name, type, partition flag and
    the number of non-null values of that field in ``df`` (one aggregate)."""
    counts = df.agg(*[F.count(F.col(f"`{n}`")).alias(f"c{p}") for p, n, _, _ in fields])
    rows = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(n).alias("name"),
                              F.lit(t).alias("type"), F.lit(part).alias("is_partition"),
                              F.col(f"c{p}").alias(alias))
                     for p, n, t, part in fields])
    return counts.select(F.inline(rows))


# ---------------------------------------------------------------------------
# decode and derive
# ---------------------------------------------------------------------------

def q_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_json(raw_log(_events(spark, sf_dir)), EVENTS_SPEC.row_schema, mode="lower_all")
    return d.select("eventid", "userid", "appid", "ts",
                    F.col("value").cast("double").alias("value"), "props")


def q_decode_keep_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_json(raw_log(_events(spark, sf_dir)), EVENTS_SPEC.row_schema, mode="keep_values")
    return d.select("eventid", "userid", "appid", "ts",
                    F.col("value").cast("double").alias("value"), "props")


def q_decode_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode_json(raw_log_dirty(_events(spark, sf_dir)), EVENTS_SPEC.row_schema)
    return d.groupBy("appid").agg(F.count(F.lit(1)).alias("n"))


def _derived(spark: SparkSession, sf_dir: str, tz: str, clock=None) -> DataFrame:
    return decode_and_derive(raw_log(_events(spark, sf_dir)), EVENTS_SPEC, tz=tz, clock=clock)


def q_derive_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, CONTRACT_TZ).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def q_derive_dt_tz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, "Asia/Seoul").groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


def q_derive_storeid(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the batch clock is the event time itself, so every minute of the day occurs
    d = _derived(spark, sf_dir, CONTRACT_TZ, clock=parse_ts(spark, F.col("ts")))
    return d.groupBy("storeid").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# ingest and streaming
# ---------------------------------------------------------------------------

def q_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "ingest_roundtrip")
    _ingest(t, _events(spark, sf_dir), "batch-0")
    return _g(t.snapshot())


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    base = work_dir(spark, "stream_ingest")
    src = f"{base}/source"
    raw_log(ev).write.parquet(src)          # one file per split of the feed
    n_files = sum(1 for f in list_names(spark, src) if f.endswith(".parquet"))
    t = LogicalTable.create(spark, f"{base}/table", EVENTS_SPEC)
    # two micro-batches, whatever the number of files
    stream = read_file_stream(spark, src, "parquet", max_files_per_trigger=max(1, -(-n_files // 2)))
    q = start_ingest(t, stream, f"{base}/checkpoint", available_now=True, tz=CONTRACT_TZ)
    q.awaitTermination()
    return _g(t.snapshot())


def q_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "replay_idempotent")
    ev = _events(spark, sf_dir)
    _ingest(t, leg(ev, "R"), "q-0")
    _ingest(t, leg(ev, "W_a", "W_b"), "q-1")
    _ingest(t, leg(ev, "R"), "q-0")  # the same batch delivered again
    compact(t)
    _ingest(t, leg(ev, "W_a", "W_b"), "q-1")  # and once more after it was folded
    return t.write_leg(t.committed_keys()).groupBy("key", "appid").agg(F.count(F.lit(1)).alias("n"))


def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _table(spark, "late_rows")
    ev = _events(spark, sf_dir)
    cut = F.lit("2024-01-04").cast("timestamp_ntz")
    late = F.coalesce(F.col("ts") < cut, F.lit(False))
    _ingest(t, ev.where(~late), "q-0")
    _ingest(t, ev.where(late), "q-1")  # rows of the first three days, late
    return t.write_leg(t.committed_keys()).groupBy("key", "dt").agg(F.count(F.lit(1)).alias("n"))


def q_start_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    offsets = {("events", p): 10 * p for p in range(13)}
    kept = keep_from_offsets(raw_log(_events(spark, sf_dir)), offsets)
    return kept.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))


def q_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_ranges(raw_log(_events(spark, sf_dir)))


def q_decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged feed: rows by application, rejects by reason with their offsets;
    the batch comes twice, and is folded before it comes a third time."""
    env = raw_log_dirty(_events(spark, sf_dir))
    t = _table(spark, "decode_rejects")
    for again in range(3):
        ingest_with_rejects(t, env, "batch", tz=CONTRACT_TZ)
        if again:
            compact(t)
    rows = t.snapshot().groupBy("appid").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("row").alias("kind"), F.col("appid").alias("name"), "n", F.lit(None).cast("bigint").alias("offsets"))
    bad = rejects(t).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("offsets")).select(
        F.lit("reject").alias("kind"), F.col("reason").alias("name"), "n", "offsets")
    return rows.unionByName(bad)


def q_offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with ranges of offsets left out and some records sent thrice."""
    env = raw_log(_events(spark, sf_dir))
    kept = env.where(~(F.pmod("offset", F.lit(50)).between(7, 9)))
    again = kept.where("CAST(key AS BIGINT) % 97 = 0")
    return offset_gaps(kept.unionByName(again).unionByName(again))


# ---------------------------------------------------------------------------
# logical view
# ---------------------------------------------------------------------------

def q_view_steady(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    t = _table(spark, "view_steady")
    _ingest(t, leg(ev, "R", "W_a"), "old")
    compact(t)
    _ingest(t, leg(ev, "W_b"), "active")
    st = t.state()
    read, write = t.read_leg(list(st.gens)), t.write_leg(["active"])
    return _g(view_steady(read, write, t.view_columns()))


def q_view_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _three_leg_table(spark, _events(spark, sf_dir), "view_extended")
    st = t.state()
    name = f"v_events_{uuid.uuid4().hex[:8]}"
    legs = [t.read_leg(list(st.gens)), t.write_leg(["w_a"]), t.write_leg(["w_b"])]
    named = [d.withColumn("leg", F.lit(n)) for d, n in zip(legs, ("R", "W_a", "W_b"), strict=True)]
    view_extended(*named, [*t.view_columns(), "leg"]).createOrReplaceTempView(name)
    return spark.sql(f"SELECT leg, dt, appid, count(*) AS n, round(sum(CAST(value AS DOUBLE)), 2) AS sv "
                     f"FROM {name} GROUP BY leg, dt, appid")


PRUNE_DTS = ("20240105", "20240115", "20240125")


def q_view_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _three_leg_table(spark, _events(spark, sf_dir), "view_pruned")
    v = t.snapshot().where(F.col("dt").isin(*PRUNE_DTS) & (F.col("appid") == "click"))
    return _g(v)


# ---------------------------------------------------------------------------
# compaction
# ---------------------------------------------------------------------------

def q_compact_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    t = _table(spark, "compact_fold")
    for name in ("R", "W_a", "W_b"):
        _ingest(t, leg(ev, name), name)
        compact(t)
    st = t.state()
    # one gen per fold, in the order of the folds
    by_gen = t.read_leg(list(st.gens)).withColumn(
        "fold", F.array_position(F.array(*map(F.lit, st.gens)), F.col("gen")))
    return by_gen.groupBy("fold", "dt").agg(F.count(F.lit(1)).alias("n"))


def q_compact_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    t = _table(spark, "compact_invariant")
    _ingest(t, leg(ev, "R"), "R")
    compact(t)
    _ingest(t, leg(ev, "W_a"), "W_a")
    # a compaction freezes W_a; W_b commits while it runs and stays in the delta
    keys = t.delta_keys()
    _ingest(t, leg(ev, "W_b"), "W_b")
    base = t.state()
    gen = f"{base.version + 1:010d}-manual"
    fold(t, keys, gen)
    t.publish(base, list(base.gens) + [gen], list(base.folded) + keys)
    return _g(t.snapshot())


def q_compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    t = _table(spark, "compact_files")
    names = ("R", "W_a", "W_b")
    for name in names:
        _ingest(t, leg(ev, name), name, files_per_partition=1)
    before = (t.write_leg(list(names)).select("dt", "appid", F.col("_metadata.file_path").alias("f"))
              .groupBy("dt", "appid").agg(F.count_distinct("f").alias("files_before")))
    whole = f"{t.state().version + 1:010d}-whole"
    fold(t, list(names), whole, files_per_partition=1)
    split = f"{t.state().version + 1:010d}-split"
    fold(t, list(names), split, files_per_partition=COMPACTION_FILES)
    one = files_per_partition(t, whole).select("dt", "appid", "n", F.col("n_files").alias("files_after"))
    many = files_per_partition(t, split).select("dt", "appid", F.col("n_files").alias("files_split"))
    # two salts of a directory may meet in one writer, but not those of every directory
    some = many.agg((F.max("files_split") > 1).alias("split_ok"))
    return one.join(before, ["dt", "appid"]).join(many, ["dt", "appid"]).crossJoin(some).select(
        "dt", "appid", "n", "files_before", "files_after",
        (F.col("files_split") <= COMPACTION_FILES).alias("bound_ok"), "split_ok")


# ---------------------------------------------------------------------------
# statistics
# ---------------------------------------------------------------------------

STAT_COLUMNS = ["eventid", "userid", "ts", "value", "props", "dt", "appid"]


def q_partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _three_leg_table(spark, _events(spark, sf_dir), "partition_stats")
    return partition_stats(t.snapshot())


def q_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _three_leg_table(spark, _events(spark, sf_dir), "column_stats")
    return column_stats(t.snapshot(), STAT_COLUMNS, exact=True)


# ---------------------------------------------------------------------------
# catalog upkeep and schemas
# ---------------------------------------------------------------------------

def _suffix() -> str:
    return uuid.uuid4().hex[:10]


def q_catalog_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    t = _table(spark, "catalog_recover")
    _ingest(t, leg(ev, "R"), "R")
    w_name, r_name = f"tidelog_write_{_suffix()}", f"tidelog_read_{_suffix()}"
    register_areas(t, w_name, r_name)
    # later batches land by path: invisible to the catalog until recovered
    _ingest(t, leg(ev, "W_a"), "W_a")
    _ingest(t, leg(ev, "W_b"), "W_b")
    recover_partitions(spark, w_name)
    refresh(spark, w_name)
    return _g(spark.table(w_name))


def _physical_write_table(spark: SparkSession, ev: DataFrame, spec: TableSpec) -> str:
    """One physical write table (dt/appid/storeid) holding the whole feed."""
    path = work_dir(spark, "write_table")
    rows = decode_and_derive(raw_log(ev), spec, tz=CONTRACT_TZ)
    write_partitioned(rows, path, spec.partition_names)
    return path


def q_schema_from_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = from_template("demo", "events")
    path = _physical_write_table(spark, _events(spark, sf_dir), spec)
    df = spark.read.schema(spec.row_schema).parquet(path)
    return _field_counts(df, spec.field_list())


def _catalog_table(spark: SparkSession, sf_dir: str) -> str:
    path = _physical_write_table(spark, _events(spark, sf_dir), EVENTS_SPEC)
    name = f"tidelog_events_{_suffix()}"
    spark.sql(EVENTS_SPEC.create_table_sql(name, path))
    recover_partitions(spark, name)
    return name


def q_schema_from_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _catalog_table(spark, sf_dir)
    spec = from_catalog(spark, name)
    return _field_counts(spark.table(name), spec.field_list())


def q_recreate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _catalog_table(spark, sf_dir)
    spec = from_catalog(spark, name)
    # one aggregate row per declared field (bounded by the schema width)
    counts_before = _field_counts(spark.table(name), spec.field_list(), "n_before").collect()
    new_spec = recreate_table(spark, name)
    after = _field_counts(spark.table(name), new_spec.field_list(), "n_after")
    pre = spark.createDataFrame([(r.pos, r.n_before) for r in counts_before], "pos int, n_before bigint")
    return after.join(F.broadcast(pre), "pos")


def q_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "bootstrap")
    LogicalTable.create(spark, root, EVENTS_SPEC)
    t = LogicalTable.create(spark, root, EVENTS_SPEC)  # rerun is harmless
    st = t.state()
    if (st.version, st.gens, st.folded) != (0, (), ()):
        raise AssertionError(f"bootstrap state is not v0 with empty lists: {st}")
    t = LogicalTable.open(spark, root)
    _ingest(t, _events(spark, sf_dir), "first")
    return _g(t.snapshot())


# ---------------------------------------------------------------------------
# contract
# ---------------------------------------------------------------------------

def q_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by application, one of them empty: it leaves no key."""
    t = _table(spark, "skip_empty")
    ev = _events(spark, sf_dir)
    for app in ("click", "no-such-type", "view", "purchase", "signup", "error"):
        _ingest(t, ev.where(F.col("event_type") == app), app, skip_empty=True)
    keys = spark.createDataFrame([(k,) for k in t.committed_keys()], "key string")
    return keys.join(t.snapshot().groupBy(F.col("appid").alias("key")).agg(F.count(F.lit(1)).alias("n")),
                     "key", "full")


def q_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest and compaction without a table raise and leave nothing; the
    same batch is taken once the table is there."""
    ev = _events(spark, sf_dir)
    root = work_dir(spark, "missing_table")
    t = LogicalTable(spark, root, EVENTS_SPEC)
    raised = 0
    for job in (lambda: _ingest(t, ev, "b-0"), lambda: compact(t), lambda: LogicalTable.open(spark, root)):
        try:
            job()
        except TableMissing:
            raised += 1
    left = len(list_names(spark, root))
    t = LogicalTable.create(spark, root, EVENTS_SPEC)
    _ingest(t, ev, "b-0")
    return t.snapshot().groupBy("appid").agg(
        F.count(F.lit(1)).alias("n"), F.lit(raised).alias("raised"), F.lit(left).alias("left_behind"))


def q_batch_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clock per batch, kept by a replay and by a later batch."""
    t = _table(spark, "batch_clock")
    ev = _events(spark, sf_dir)
    for key, at in (("b-0", "2024-03-01 09:05:30"), ("b-1", "2024-03-01 23:59:59"), ("b-0", "2024-03-01 10:00:00")):
        rows = decode_and_derive(raw_log(leg(ev, *(("R",) if key == "b-0" else ("W_a", "W_b")))), t, tz=CONTRACT_TZ,
                                 clock=F.to_timestamp(F.lit(f"{at}Z")))
        ingest_batch(t, rows, key)
    return t.write_leg(t.committed_keys()).groupBy("key", "storeid").agg(F.count(F.lit(1)).alias("n"))


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview has ten rows, all of them decoded rows of the feed."""
    d = decode_json(raw_log(_events(spark, sf_dir)), EVENTS_SPEC.row_schema, mode="lower_all")
    shown = preview(d.select("eventid")).select(F.col("eventid").alias("id")).distinct()
    known = d.join(shown, F.col("eventid") == F.col("id"), "left_semi").select("eventid").distinct()
    return known.agg(F.count(F.lit(1)).alias("n_shown")).crossJoin(d.agg(F.count(F.lit(1)).alias("n")))


def q_offset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The durable report of a stream of several batches, over all of them."""
    ev = _events(spark, sf_dir)
    base = work_dir(spark, "offset_report")
    src = f"{base}/source"
    raw_log(ev).repartition(6, "offset").write.parquet(src)
    t = LogicalTable.create(spark, f"{base}/table", EVENTS_SPEC)
    stream = read_file_stream(spark, src, "parquet", max_files_per_trigger=1)
    q = start_ingest(t, stream, f"{base}/checkpoint", available_now=True, tz=CONTRACT_TZ, offset_report=True)
    q.awaitTermination()
    return offset_reports(t).groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"),
        F.sum("n").alias("n"))


def q_apps_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both applications with their catalog steps, read back by table name."""
    ev = _events(spark, sf_dir)
    base = work_dir(spark, "apps_by_name")
    w_name, r_name, view = (f"tidelog_{n}_{_suffix()}" for n in ("w", "r", "v"))
    t = LogicalTable.create(spark, f"{base}/table", EVENTS_SPEC)
    register_areas(t, w_name, r_name)
    for part in ("R", "W_a"):
        raw_log(leg(ev, part)).write.parquet(f"{base}/{part}")
        ingest_app(spark, t.root, source_path=f"{base}/{part}", checkpoint=f"{base}/checkpoint-{part}",
                   available_now=True, tz=CONTRACT_TZ, catalog_table=w_name).awaitTermination()
        if part == "R":
            compaction_app(spark, t.root, catalog_table=r_name, analyze=True, analyze_columns=True)
    _ingest(t, leg(ev, "W_b"), "direct", catalog_table=w_name)
    register_catalog_view(t, view, w_name, r_name, recover=False)
    return _g(spark.table(view))


def _typed_rows(ev: DataFrame, version: int) -> DataFrame:
    """The feed as clients of three releases send it (the payload's fields are
    strings), in the columns and types of that release."""
    types = [{"eventid": "int", "userid": "int", "ts": "string", "value": "float"},
             {"eventid": "int", "userid": "int", "ts": "string", "value": "float", "props": "string"},
             {"eventid": "bigint", "userid": "bigint", "ts": "string", "value": "double", "attrs": "string"}][version]
    spec = TableSpec.from_ddl(", ".join(f"{c} string" for c in types), "dt string, appid string, storeid string")
    env = raw_log(ev)
    if version == 2:
        env = env.withColumn("value", F.regexp_replace("value", '"props":', '"attrs":'))
    rows = decode_and_derive(env, spec, tz=CONTRACT_TZ)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()], *spec.partition_names)


def q_schema_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added, then one renamed and three widened, between batches and a
    fold; a late writer still sends the first release."""
    ev = _events(spark, sf_dir)
    first = TableSpec.from_ddl("eventid int, userid int, ts string, value float",
                               "dt string, appid string, storeid string")
    t0 = _table(spark, "schema_evolved", first)
    late = F.coalesce(F.pmod(F.col("event_id"), F.lit(7)) == 0, F.lit(False))
    ingest_batch(t0, _typed_rows(leg(ev, "R"), 0), "r")
    t1 = evolve(t0, add_column("props", "string"))
    ingest_batch(t1, _typed_rows(leg(ev, "W_a"), 1), "w_a")
    compact(t0)
    t2 = evolve(t1, rename_column("props", "attrs"), widen_column("eventid", "bigint"),
                widen_column("userid", "bigint"), widen_column("value", "double"))
    ingest_batch(t2, _typed_rows(leg(ev, "W_b").where(~late), 2), "w_b")
    ingest_batch(t0, _typed_rows(leg(ev, "W_b").where(late), 0), "late")
    return t2.snapshot().groupBy("dt", "appid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("eventid").alias("sum_id"), F.sum("userid").alias("sum_user"),
        F.round(F.sum(F.round("value", 2)), 2).alias("sv"), F.count("attrs").alias("n_attrs"),
        F.max("attrs").alias("max_attrs"))


def q_ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed under three checkpoints: explicit late start offsets, then a lost
    checkpoint that reads all of it again, then once more after a fold."""
    ev = _events(spark, sf_dir)
    base = work_dir(spark, "ingest_ledger")
    # as many files as a shuffle has parts, so that every batch is read by many tasks
    writers = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    raw_log(ev).repartition(writers, "offset").write.parquet(f"{base}/source")
    n_files = sum(1 for f in list_names(spark, f"{base}/source") if f.endswith(".parquet"))
    t = LogicalTable.create(spark, f"{base}/table", EVENTS_SPEC)
    for name in ("late", "lost", "again"):
        # two micro-batches, whatever the number of files
        stream = read_file_stream(spark, f"{base}/source", "parquet", max_files_per_trigger=max(1, -(-n_files // 2)))
        if name == "late":
            stream = keep_from_offsets(stream, {("events", p): 10 * p for p in range(13)})
        start_ingest(t, stream, f"{base}/checkpoint-{name}", available_now=True, tz=CONTRACT_TZ,
                     ledger=True).awaitTermination()
        compact(t)
    taken = ledger_intervals(t).groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"),
        F.count(F.lit(1)).alias("intervals"))
    rows = t.snapshot().groupBy((F.col("eventid").cast("bigint") % 13).cast("int").alias("partition")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("eventid").alias("n_ids"))
    return taken.join(rows, "partition", "full")


def q_view_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows new since three moments, read after folds and a merge of what was
    old then with what came later."""
    ev = _events(spark, sf_dir)
    t = _table(spark, "view_changes")
    marks = {"nothing": None}
    _ingest(t, leg(ev, "R"), "r")
    marks["R"] = mark(t)                  # beside the state, folded later
    compact(t)
    _ingest(t, leg(ev, "W_a"), "w_a")
    marks["W_a"] = mark(t)
    _ingest(t, leg(ev, "W_b").where("event_id % 2 = 0"), "w_b0")
    compact(t)                            # one gen of old and new keys
    merge_gens(t)
    _ingest(t, leg(ev, "W_b").where("event_id % 2 = 1 OR event_id IS NULL"), "w_b1")
    parts = [_g(changes(t, m)).withColumn("since", F.lit(n)) for n, m in marks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_publish_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folds and a merge made on one state are all published; a second fold
    of the same batch is refused."""
    ev = _events(spark, sf_dir)
    t = _table(spark, "publish_race")
    for k in (0, 1):
        _ingest(t, leg(ev, "R").where(F.coalesce(F.pmod("event_id", F.lit(2)), F.lit(0)) == k), f"r{k}")
        compact(t)
    _ingest(t, leg(ev, "W_a"), "w_a")
    _ingest(t, leg(ev, "W_b"), "w_b")
    base = t.state()
    rewrite(t, list(base.gens), "merged")
    for gen, key in (("fold-a", "w_a"), ("fold-b", "w_b"), ("fold-again", "w_a")):
        fold(t, [key], gen)
    publish_rewrite(t, base, "fold-a", keys=["w_a"])
    publish_rewrite(t, base, "merged", merged=list(base.gens))
    publish_rewrite(t, base, "fold-b", keys=["w_b"])
    refused = 0
    try:
        publish_rewrite(t, base, "fold-again", keys=["w_a"])
    except PublishConflict:
        refused = 1
    st = t.state()
    rows = t.read_leg(list(st.gens), st)
    return rows.groupBy("gen", "dt", "appid").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "refused", F.lit(refused)).withColumn("left_beside", F.lit(len(t.delta_keys(st))))


# Conditions of view_skipping (fixed values): columns and the SQL of the same.
SKIP_IDS = ("17", "256", "511", "777")
SKIP_TS = ("2024-01-07t00:00:00", "2024-01-09t12:00:00")


def q_view_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point and range reads of two indexed gens and an indexed key by their
    manifests; each opens fewer files than there are."""
    ev = _events(spark, sf_dir)
    t, columns = _table(spark, "view_skipping"), ["eventid", "userid", "ts"]
    for name in ("R", "W_a"):
        _ingest(t, leg(ev, name), name.lower())
        compact(t, index_columns=columns)
    _ingest(t, leg(ev, "W_b"), "w_b", index_columns=columns)
    every, parts = files_where(t).count(), []
    for name, conditions in (("point", [one_of("eventid", *SKIP_IDS)]), ("range", [between("ts", *SKIP_TS)]),
                             ("both", [one_of("appid", "click"), between("ts", SKIP_TS[0]), one_of("eventid", *SKIP_IDS)])):
        rows = select_where(t, *conditions)
        parts.append(rows.select(F.lit(name).alias("read"), "eventid", "userid", "dt", "appid",
                                 F.lit(len(rows.inputFiles()) < every).alias("fewer")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics of gens and a key merged from their manifests; the
    estimate of distinct values is held against the exact count."""
    ev = _events(spark, sf_dir)
    t, columns = _table(spark, "stats_incremental"), ["eventid", "userid", "ts", "props"]
    for name in ("R", "W_a"):
        _ingest(t, leg(ev, name), name.lower())
        compact(t, index_columns=columns)
    _ingest(t, leg(ev, "W_b"), "w_b")
    index_missing(t, columns)
    exact = column_stats(t.snapshot().select(*columns), exact=True).select("col", F.col("ndv").alias("n_distinct"))
    near = F.abs(F.col("ndv") - F.col("n_distinct")) * 10 <= F.col("n_distinct")
    return manifest_stats(t, columns).join(exact, "col").withColumn("near", near).drop("ndv")


def q_compact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed folded into two tables of one directory, one of them clustered
    by event and user: the same rows, and for a box of both columns the files
    opened hold at most a third as many."""
    ev = _events(spark, sf_dir)
    spec = TableSpec.from_ddl("event bigint, member bigint, value string", "kind string, storeid string")
    rows = _derived(spark, sf_dir, CONTRACT_TZ).select(
        F.col("eventid").cast("bigint").alias("event"), F.col("userid").cast("bigint").alias("member"), "value",
        F.lit("all").alias("kind"), "storeid")
    # the box is a sixth of either column's range
    top = ev.agg(F.max("event_id").alias("event"), F.max("user_id").alias("member")).first()
    box = [between("event", top.event // 6, top.event // 3), between("member", top.member // 6, top.member // 3)]
    found, opened = [], []
    for name, layout in (("plain", {"files_per_partition": 32}),
                         ("clustered", {"cluster": Cluster(("event", "member"), ranges=32)})):
        t = _table(spark, f"compact_{name}", spec)
        ingest_batch(t, rows.withColumn("storeid", F.lit("0000")), "k")
        compact(t, index_columns=["event", "member"], **layout)
        inside = select_where(t, *box)
        opened.append(files_where(t, *box).agg(F.sum("n")).first()[0] or 0)
        for part, df in (("all", t.snapshot()), ("box", inside)):
            found.append(df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("event"), F.lit(0)).alias("sum_event"),
                                F.round(F.sum(F.col("value").cast("double")), 2).alias("sv"))
                         .withColumn("layout", F.lit(name)).withColumn("part", F.lit(part)))
    every = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    return every.withColumn("third", F.lit(3 * opened[1] <= opened[0]))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: replay the events feed, decode, derive partitions, append as
    partitioned Parquet, read the logical table back and summarise it."""
    return q_ingest_roundtrip(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **LLM_QUERIES,
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
        "decode_json": q_decode_json,
        "decode_keep_case": q_decode_keep_case,
        "decode_dirty": q_decode_dirty,
        "derive_dt": q_derive_dt,
        "derive_dt_tz": q_derive_dt_tz,
        "derive_storeid": q_derive_storeid,
        "ingest_roundtrip": q_ingest_roundtrip,
        "stream_ingest": q_stream_ingest,
        "replay_idempotent": q_replay_idempotent,
        "late_rows": q_late_rows,
        "start_offsets": q_start_offsets,
        "offset_ranges": q_offset_ranges,
        "view_steady": q_view_steady,
        "view_extended": q_view_extended,
        "view_pruned": q_view_pruned,
        "compact_fold": q_compact_fold,
        "compact_invariant": q_compact_invariant,
        "compact_files": q_compact_files,
        "partition_stats": q_partition_stats,
        "column_stats": q_column_stats,
        "catalog_recover": q_catalog_recover,
        "schema_from_template": q_schema_from_template,
        "schema_from_catalog": q_schema_from_catalog,
        "recreate_table": q_recreate_table,
        "bootstrap": q_bootstrap,
        "skip_empty": q_skip_empty,
        "missing_table": q_missing_table,
        "batch_clock": q_batch_clock,
        "preview": q_preview,
        "offset_report": q_offset_report,
        "apps_by_name": q_apps_by_name,
        "schema_evolved": q_schema_evolved,
        "ingest_ledger": q_ingest_ledger,
        "view_changes": q_view_changes,
        "publish_race": q_publish_race,
        "offset_gaps": q_offset_gaps,
        "decode_rejects": q_decode_rejects,
        "view_skipping": q_view_skipping,
        "stats_incremental": q_stats_incremental,
        "compact_clustered": q_compact_clustered,
    }


_G = ("SELECT strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, "
      "round(sum(value), 2) AS sv FROM events{where} GROUP BY ALL")


def _gsql(where: str = "") -> str:
    return _G.format(where=f" WHERE {where}" if where else "")


_FIELDS = [(0, "eventid", "event_id", False), (1, "userid", "user_id", False),
           (2, "ts", "ts", False), (3, "value", "value", False), (4, "props", "props", False),
           (5, "dt", "ts", True), (6, "appid", "event_type", True), (7, "storeid", "ts", True)]


def _fields_sql(alias: str, zero: bool = False) -> str:
    parts = []
    for pos, name, src, part in _FIELDS:
        n = "0" if zero else f"count({src})"
        parts.append(f"SELECT {pos} AS pos, '{name}' AS name, 'string' AS type, "
                     f"{str(part).lower()} AS is_partition, CAST({n} AS BIGINT) AS {alias} FROM events")
    return " UNION ALL ".join(parts)


def _column_stats_sql() -> str:
    exprs = {
        "eventid": "CAST(event_id AS VARCHAR)",
        "userid": "CAST(user_id AS VARCHAR)",
        "ts": "strftime(ts, '%Y-%m-%dt%H:%M:%S.%fz')",
        "value": "CAST(value AS VARCHAR)",
        "props": "lower(props)",
        "dt": "strftime(ts, '%Y%m%d')",
        "appid": "event_type",
    }
    parts = []
    for name in STAT_COLUMNS:
        e = exprs[name]
        parts.append(f"SELECT '{name}' AS col, count(*) AS n, count(*) FILTER (WHERE {e} IS NULL) AS nulls, "
                     f"count(DISTINCT {e}) AS ndv, CAST(max(length({e})) AS BIGINT) AS max_len FROM events")
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    dts = ", ".join(f"'{d}'" for d in PRUNE_DTS)
    ids = f"event_id IN ({', '.join(SKIP_IDS)})"
    iso = "strftime(ts, '%Y-%m-%dt%H:%M:%S.%fz')"
    return {
        **LLM_ORACLES,
        **({"pipeline": corpus_pipeline.ORACLE_SQL}
           if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
        "decode_json": (
            "SELECT CAST(event_id AS VARCHAR) AS eventid, CAST(user_id AS VARCHAR) AS userid, "
            "event_type AS appid, strftime(ts, '%Y-%m-%dt%H:%M:%S.%fz') AS ts, value, "
            "lower(props) AS props FROM events"),
        "decode_keep_case": (
            "SELECT CAST(event_id AS VARCHAR) AS eventid, CAST(user_id AS VARCHAR) AS userid, "
            "upper(event_type) AS appid, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, value, "
            "props FROM events"),
        "decode_dirty": (
            "SELECT event_type AS appid, CAST(sum(CASE event_id % 100 WHEN 8 THEN 2 ELSE 1 END) AS BIGINT) AS n "
            "FROM events WHERE event_id % 100 NOT IN (7, 9, 10, 11) GROUP BY 1 "
            "UNION ALL SELECT NULL AS appid, count(*) AS n FROM events WHERE event_id % 100 IN (7, 11)"),
        "derive_dt": "SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events GROUP BY 1",
        "derive_dt_tz": ("SELECT strftime(ts + INTERVAL 9 HOUR, '%Y%m%d') AS dt, count(*) AS n "
                         "FROM events GROUP BY 1"),
        "derive_storeid": "SELECT strftime(ts, '%H%M') AS storeid, count(*) AS n FROM events GROUP BY 1",
        "ingest_roundtrip": _gsql(),
        "stream_ingest": _gsql(),
        "replay_idempotent": ("SELECT CASE event_id % 3 WHEN 0 THEN 'q-0' ELSE 'q-1' END AS \"key\", "
                              "event_type AS appid, count(*) AS n FROM events GROUP BY ALL"),
        "late_rows": ("SELECT CASE WHEN ts < TIMESTAMP '2024-01-04' THEN 'q-1' ELSE 'q-0' END AS \"key\", "
                      "strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events GROUP BY ALL"),
        "start_offsets": (
            "SELECT CAST(event_id % 13 AS INTEGER) AS \"partition\", count(*) AS n FROM events "
            "WHERE event_id // 13 >= 10 * (event_id % 13) GROUP BY 1"),
        "offset_ranges": (
            "SELECT 'events' AS topic, CAST(event_id % 13 AS INTEGER) AS \"partition\", "
            "min(event_id // 13) AS from_offset, max(event_id // 13) + 1 AS until_offset, "
            "count(*) AS n FROM events GROUP BY ALL"),
        "view_steady": _gsql(),
        "view_extended": (
            "SELECT CASE event_id % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'W_a' ELSE 'W_b' END AS leg, "
            "strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, round(sum(value), 2) AS sv "
            "FROM events GROUP BY ALL"),
        "view_pruned": _gsql(f"strftime(ts, '%Y%m%d') IN ({dts}) AND event_type = 'click'"),
        "compact_fold": ("SELECT CAST(event_id % 3 + 1 AS BIGINT) AS fold, strftime(ts, '%Y%m%d') AS dt, "
                         "count(*) AS n FROM events GROUP BY ALL"),
        "compact_invariant": _gsql(),
        "compact_files": ("SELECT strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, "
                          "count(DISTINCT event_id % 3) AS files_before, CAST(1 AS BIGINT) AS files_after, "
                          "true AS bound_ok, true AS split_ok FROM events GROUP BY ALL"),
        "partition_stats": ("SELECT strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n "
                            "FROM events GROUP BY ALL"),
        "column_stats": _column_stats_sql(),
        "catalog_recover": _gsql(),
        "schema_from_template": _fields_sql("n_values"),
        "schema_from_catalog": _fields_sql("n_values"),
        "recreate_table": (
            "SELECT a.pos, a.name, a.type, a.is_partition, a.n_values AS n_before, "
            "CAST(0 AS BIGINT) AS n_after FROM (" + _fields_sql("n_values") + ") a"),
        "bootstrap": _gsql(),
        "skip_empty": "SELECT event_type AS \"key\", count(*) AS n FROM events GROUP BY 1",
        "missing_table": ("SELECT event_type AS appid, count(*) AS n, 3 AS raised, 0 AS left_behind "
                          "FROM events GROUP BY 1"),
        "batch_clock": ("SELECT CASE event_id % 3 WHEN 0 THEN 'b-0' ELSE 'b-1' END AS \"key\", "
                        "CASE event_id % 3 WHEN 0 THEN '0905' ELSE '2359' END AS storeid, count(*) AS n "
                        "FROM events GROUP BY ALL"),
        "preview": "SELECT CAST(least(10, count(*)) AS BIGINT) AS n_shown, count(*) AS n FROM events",
        "offset_report": (
            "SELECT 'events' AS topic, CAST(event_id % 13 AS INTEGER) AS \"partition\", "
            "min(event_id // 13) AS from_offset, max(event_id // 13) + 1 AS until_offset, "
            "count(*) AS n FROM events GROUP BY ALL"),
        "apps_by_name": _gsql(),
        "schema_evolved": (
            "SELECT strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, "
            "CAST(sum(event_id) AS BIGINT) AS sum_id, CAST(sum(user_id) AS BIGINT) AS sum_user, "
            "round(sum(round(value, 2)), 2) AS sv, count(attrs) AS n_attrs, max(attrs) AS max_attrs FROM "
            "(SELECT *, CASE WHEN event_id % 3 = 1 OR (event_id % 3 = 2 AND event_id % 7 <> 0) "
            "THEN lower(props) END AS attrs FROM events) GROUP BY ALL"),
        "ingest_ledger": (
            "SELECT 'events' AS topic, CAST(event_id % 13 AS INTEGER) AS \"partition\", "
            "min(event_id // 13) AS from_offset, max(event_id // 13) + 1 AS until_offset, "
            "CAST(1 AS BIGINT) AS intervals, count(*) AS n, count(DISTINCT event_id) AS n_ids "
            "FROM events GROUP BY ALL"),
        "view_changes": " UNION ALL ".join(
            f"SELECT strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, round(sum(value), 2) AS sv, "
            f"'{since}' AS since FROM events WHERE event_id % 3 >= {k} GROUP BY ALL"
            for k, since in enumerate(("nothing", "R", "W_a"))),
        "publish_race": (
            "SELECT CASE event_id % 3 WHEN 0 THEN 'merged' WHEN 1 THEN 'fold-a' ELSE 'fold-b' END AS gen, "
            "strftime(ts, '%Y%m%d') AS dt, event_type AS appid, count(*) AS n, 1 AS refused, 0 AS left_beside "
            "FROM events GROUP BY ALL"),
        "offset_gaps": (
            "WITH e AS (SELECT CAST(event_id % 13 AS INTEGER) AS p, event_id // 13 AS o, "
            "sum(CASE WHEN event_id % 97 = 0 THEN 3 ELSE 1 END) AS c FROM events "
            "WHERE NOT (event_id // 13) % 50 BETWEEN 7 AND 9 GROUP BY ALL), "
            "l AS (SELECT p, o, c, lag(o) OVER (PARTITION BY p ORDER BY o) AS b FROM e) "
            "SELECT 'events' AS topic, p AS \"partition\", 'gap' AS kind, b + 1 AS from_offset, o AS until_offset, "
            "o - b - 1 AS n FROM l WHERE o - b > 1 UNION ALL "
            "SELECT 'events', p, 'duplicate', o, o + 1, CAST(c - 1 AS BIGINT) FROM l WHERE c > 1"),
        "decode_rejects": (
            "SELECT 'row' AS kind, event_type AS name, CAST(sum(CASE event_id % 100 WHEN 8 THEN 2 ELSE 1 END) AS BIGINT) "
            "AS n, CAST(NULL AS BIGINT) AS offsets FROM events WHERE event_id % 100 NOT IN (7, 9, 10, 11) GROUP BY ALL "
            "UNION ALL SELECT 'reject', CASE event_id % 100 WHEN 7 THEN 'malformed' ELSE 'null element' END AS reason, "
            "count(*), CAST(sum(event_id // 13) AS BIGINT) FROM events WHERE event_id % 100 IN (7, 11) GROUP BY reason"),
        "view_skipping": " UNION ALL ".join(
            f"SELECT '{name}' AS \"read\", CAST(event_id AS VARCHAR) AS eventid, CAST(user_id AS VARCHAR) AS userid, "
            f"strftime(ts, '%Y%m%d') AS dt, event_type AS appid, true AS fewer FROM events WHERE {where}"
            for name, where in (("point", ids), ("range", f"{iso} BETWEEN '{SKIP_TS[0]}' AND '{SKIP_TS[1]}'"),
                                ("both", f"{ids} AND event_type = 'click' AND {iso} >= '{SKIP_TS[0]}'"))),
        "stats_incremental": " UNION ALL ".join(
            f"SELECT '{col}' AS col, count(*) AS n, count(*) - count(v) AS nulls, min(v) AS \"min\", max(v) AS \"max\", "
            f"CAST(max(length(v)) AS BIGINT) AS max_len, count(DISTINCT v) AS n_distinct, true AS near "
            f"FROM (SELECT {sql} AS v FROM events)"
            for col, sql in (("eventid", "CAST(event_id AS VARCHAR)"), ("userid", "CAST(user_id AS VARCHAR)"),
                             ("ts", iso), ("props", "lower(props)"))),
        "compact_clustered": " UNION ALL ".join(
            f"SELECT '{layout}' AS layout, '{part}' AS part, count(*) AS n, CAST(coalesce(sum(event_id), 0) AS BIGINT) "
            f"AS sum_event, round(sum(value), 2) AS sv, true AS third FROM events{where}"
            for layout in ("plain", "clustered") for part, where in (
                ("all", ""),
                ("box", " WHERE event_id BETWEEN (SELECT max(event_id) // 6 FROM events) AND (SELECT max(event_id) // 3 "
                        "FROM events) AND user_id BETWEEN (SELECT max(user_id) // 6 FROM events) AND "
                        "(SELECT max(user_id) // 3 FROM events)"))),
    }
