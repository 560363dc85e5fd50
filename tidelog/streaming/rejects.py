"""Reject channel: payloads that do not parse go to a quarantine leg.

The plain decode gives a payload that does not parse one all-null row, so that
no record is lost. Here such a record goes to ``<root>/rejects/key=<key>``
instead, with its raw text, the reason and where it came from. Each payload is
parsed once; the batch, parsed, is kept while both outputs are written.

The rejects of a key are written first, and count once its data are committed,
so one marker commits both. A crash before leaves rejects nobody reads, which
the replay overwrites; a replay of a committed key writes neither. After the
commit a marker of their own keeps them visible when the key is folded, removed
and forgotten; a crash between both markers is mended by the replay.

Reasons: ``malformed`` (no document: broken or cut text, ``null``, a scalar),
``null element`` (a root array with a null, whose other elements are in the raw
text). Blank payloads and empty arrays are no records, and no rejects. Letter
case: ``lower_all`` and ``exact``; the raw text is always as it was sent.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.decode import JSON_SPACE, decode_payload
from tidelog.operators.write import quoted
from tidelog.plans import fs
from tidelog.plans.table import KEY_COL, LogicalTable
from tidelog.streaming.ingest import BatchResult, derived_rows, ingest_batch, payload_schema

REJECTS_AREA = "rejects"
MARKER = "_VISIBLE"
WHERE = ("topic", "partition", "offset")
REJECTS = "topic string, partition int, offset bigint, reason string, raw string"


def decode_or_reject(df: DataFrame, schema: StructType, value_col: str = "value", mode: str = "lower_all",
                     keep: list[str] | None = None) -> DataFrame:
    """``keep``, the fields of ``schema`` in a struct ``row``, ``reason`` and
    ``raw``: one row per document, whose reason is null, and one per reject,
    whose row is null."""
    if mode not in ("lower_all", "exact"):
        raise ValueError(f"rejects are told apart in modes lower_all and exact, not {mode!r}")
    parsed, schema = decode_payload(F.col("__payload"), schema, mode)
    none = F.lit(None).cast(schema)
    entry = lambda row, reason, raw: F.struct(
        row.alias("row"), F.lit(reason).cast("string").alias("reason"), raw.cast("string").alias("raw"))
    reject = lambda reason: F.array(entry(none, reason, F.col("__payload")))

    def entries(p: Column) -> Column:
        return (F.when(p.isNull(), reject("malformed")).when(F.exists(p, lambda x: x.isNull()), reject("null element"))
                .otherwise(F.transform(p, lambda x: entry(x, None, F.lit(None)))))

    blank = F.length(F.btrim(F.col("__payload"), F.lit(JSON_SPACE))) == 0
    # one expression, so that no filter parses the payload again below a shuffle
    listed = F.when(F.col("__payload").isNotNull() & ~blank, F.transform(F.array(parsed), entries)[0])
    kept = [quoted(c) for c in keep or []]
    src = df.select(*kept, F.col(quoted(value_col)).cast("string").alias("__payload"))
    return src.select(*kept, F.explode(listed).alias("__e")).select(*kept, "__e.row", "__e.reason", "__e.raw")


def ingest_with_rejects(table: LogicalTable, envelope: DataFrame, key: str, mode: str = "lower_all", clock=None,
                        tz: str | None = None, ts_zone: str | None = None, **kw) -> BatchResult:
    """Ingest a batch of records as key ``key``, rejects beside it; ``kw`` are
    those of :func:`~tidelog.streaming.ingest.ingest_batch`, which decides
    whether the key is new. The function suits ``foreachBatch``."""
    path = _path(table, key)
    if key not in table.state().folded and not table.is_committed(key):
        schema, app_col = payload_schema(table.spec, mode)
        keep = [c for c in WHERE if c in envelope.columns]
        both = decode_or_reject(envelope, schema, mode=mode, keep=keep).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            where = [F.col(c) if c in keep else F.lit(None).alias(c) for c in WHERE]
            bad = both.where("reason IS NOT NULL").select(*where, "reason", "raw")
            kinds = StructType.fromDDL(REJECTS)
            bad.select(*[F.col(f.name).cast(f.dataType) for f in kinds.fields]).write.mode("overwrite").parquet(path)
            rows = derived_rows(both.where("reason IS NULL").select("row.*"), table.spec, mode, app_col, clock, tz, ts_zone)
            result = ingest_batch(table, rows, key, **kw)
        finally:
            both.unpersist()
    else:
        result = BatchResult(key, False, "folded" if key in table.state().folded else "committed")
    if fs.exists(table.spark, path):
        fs.create_exclusive(table.spark, f"{path}/{MARKER}", "")
    return result


def _path(table: LogicalTable, key: str) -> str:
    return f"{table.root}/{REJECTS_AREA}/{KEY_COL}={key}"


def rejects(table: LogicalTable) -> DataFrame:
    """(topic, partition, offset, reason, raw, key) of all committed keys."""
    area = f"{table.root}/{REJECTS_AREA}"
    schema = StructType.fromDDL(f"{REJECTS}, {KEY_COL} string")
    there = {n.split("=", 1)[1] for n in fs.list_names(table.spark, area) if n.startswith(f"{KEY_COL}=")}
    seen = {n.split("=", 1)[1] for n in fs.marked_children(table.spark, area, MARKER)} if there else set()
    if there - seen:
        seen |= set(table.state().folded) | set(table.committed_keys())
    paths = [fs.literal(_path(table, k)) for k in sorted(there & seen)]
    if not paths:
        return table.spark.createDataFrame([], schema)
    return table.spark.read.schema(schema).option("basePath", area).parquet(*paths)
