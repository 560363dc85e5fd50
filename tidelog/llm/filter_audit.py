"""Filter interaction audit by min-plus removal ranks.

How many documents each of five filters removes depends on the order they run
in. A document's failures are a mask of five bits. For all 32 masks and all 120
orders, the min-plus product of the mask matrix (0 where a mask fails a filter,
infinity elsewhere) and the matrix of positions (the inverse of each order)
gives the step that removes the document: the least position of a failed
filter. So the corpus is read once, for counts of documents, good and toxic ones
by part and mask; removed, kept, redundant and lost counts of every order and step
are scatter sums of those counts by the removal step.

Filter E fails a document whose text some smaller doc_id has. The least id of each
text comes from one aggregate by digest, with partial sums before the shuffle;
documents then look for (digest, id) pairs of least ids, a key that no group of
copies shares, so a text that a third of all rows copy meets in no task.

Defined cases: a null text is empty: it has no words, so only A and E may fail
it. A null source is the empty one. A null doc_id is neither smaller than another
nor has smaller ones: E doesn't fail it, and no label is its own. Rows that share a
doc_id are documents of their own; of equal rows with the least id, none fails E.
A document is good (toxic) if any label row of its id says so. Texts are read whole,
very long ones in slices. Empty ``documents`` give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, text_batches, written

FILTERS = "ABCDE"
# limits of the five filters (fixed values)
MIN_WORDS = 50
MIN_DISTINCT = 65          # percent of the words
MAX_UPPER = 5              # percent of the code points
SPECIAL = b"#$%&*|"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
CONTINUED = bytes(range(0x80, 0xC0))    # bytes that begin no code point
SPACE = b" \t\n\v\f\r"
SLICE = 1 << 22

FAILS_E = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def _slices(raw: bytes):
    """Parts of a text of about ``SLICE`` bytes that cut no word."""
    lo = 0
    while len(raw) - lo > SLICE:
        ends = [at for at in (raw.find(bytes([s]), lo + SLICE, lo + 2 * SLICE) for s in SPACE) if at >= 0]
        if ends:
            hi = min(ends)
        else:       # one word of a slice's length and more
            hi = min((at for at in (raw.find(bytes([s]), lo + 2 * SLICE) for s in SPACE) if at >= 0),
                     default=len(raw))
        yield raw[lo:hi]
        lo = hi
    yield raw[lo:]


def failed(raw: bytes) -> int:
    """Mask of the filters but E that the UTF-8 text ``raw`` fails."""
    if len(raw) <= SLICE:
        words = raw.split()
        n, distinct = len(words), len(set(words))
    else:
        n, seen = 0, set()
        for part in _slices(raw):
            words = part.split()
            n += len(words)
            seen.update(words)
        distinct = len(seen)
    points = len(raw.translate(None, CONTINUED))
    upper = len(raw) - len(raw.translate(None, UPPER))
    return ((n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * n) << 1 | (100 * upper > MAX_UPPER * points) << 2
            | (len(raw.translate(None, SPECIAL)) < len(raw)) << 3)


def text_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of ``docs(doc_id, source, text)``: filters A
    to D, and the SHA-256 that stands for the text in E."""
    text_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            mask, digest = [], []
            for raw in b.column("text").cast(pa.binary()).to_pylist():
                mask.append(failed(raw))
                digest.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(digest, pa.binary()), pa.array(mask, pa.int32())],
                names=["doc_id", "part", "digest", "mask"])
        give_back()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by failures."""
    marked = written(text_failures(docs), "filter-masks")
    first = marked.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select(
        "digest", "doc_id", F.lit(True).alias("is_first"))
    says = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    copied = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    # both sides of either join grow with the table, so none is broadcast
    return (marked.join(first.hint("merge"), ["digest", "doc_id"], "left")
            .select("doc_id", "part", F.when(copied, F.col("mask").bitwiseOR(F.lit(FAILS_E)))
                    .otherwise(F.col("mask")).alias("mask"))
            .join(says.hint("merge"), "doc_id", "left")
            .groupBy("part", "mask").agg(
                F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def positions(orders: list[str] = ORDERS) -> np.ndarray:
    """Step of each filter (row) in each order (column): the inverse permutations."""
    return np.array([[o.index(f) + 1 for o in orders] for f in FILTERS])


def removal_steps(orders: list[str] = ORDERS) -> np.ndarray:
    """Step that removes each mask (row) in each order (column), by the min-plus
    product; beyond the last step where a mask is empty."""
    far = len(FILTERS) + 1
    fails = (np.arange(MASKS)[:, None] >> np.arange(len(FILTERS))) & 1
    cost = np.where(fails == 1, 0, far)
    return np.minimum((cost[:, :, None] + positions(orders)[None, :, :]).min(axis=1), far)


_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def order_counts(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by order and step of one part, from its counts by mask."""
    removed_at, at = removal_steps(), positions()
    steps = len(FILTERS)
    orders = np.arange(len(ORDERS))
    flat = orders * (steps + 2) + removed_at          # (mask, order) → a place for each order and step

    def scatter(weight):
        out = np.zeros(len(ORDERS) * (steps + 2), dtype=np.int64)
        np.add.at(out, flat, np.broadcast_to(weight[:, None], flat.shape))
        return out.reshape(len(ORDERS), steps + 2)[:, 1:steps + 1]

    removed = scatter(n)
    which = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
    fails = (np.arange(MASKS)[:, None] >> np.arange(steps)) & 1
    failing = n @ fails
    by_filter = np.zeros(steps, dtype=np.int64)
    np.add.at(by_filter, which, removed)
    # of those failing a filter, the ones not removed at its own step went earlier
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": failing[which] - removed,
            "unique_fails": n[1 << which], "good_lost": scatter(good), "toxic_lost": scatter(toxic),
            "shapley": by_filter[which]}


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step, zeros included."""
    counts = mask_counts(docs, labels)
    vector = lambda c: F.collect_list(F.struct("mask", c)).alias(c)
    # at most one entry per mask
    by_part = counts.groupBy("part").agg(*[vector(c) for c in ("n", "good", "toxic")])

    def run(batches):
        order = np.repeat(ORDERS, len(FILTERS))
        step = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        for b in batches:
            for row in b.to_pylist():
                vectors = []
                for c in ("n", "good", "toxic"):
                    v = np.zeros(MASKS, dtype=np.int64)
                    for e in row[c]:
                        v[e["mask"]] = e[c]
                    vectors.append(v)
                got = order_counts(*vectors)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(order), pa.string()), pa.array(order.tolist(), pa.string()),
                     pa.array(step)] + [pa.array(got[c].reshape(-1).astype(np.int64)) for c in _COUNTS],
                    names=["part", "filter_order", "step", *_COUNTS])

    return by_part.mapInArrow(run, _REPORT)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return interactions(docs, labels)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY text) AS least FROM d),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS C,
         regexp_matches(text, '[#$%&*|]') AS D,
         coalesce(w.doc_id > least, false) AS E
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (
  SELECT part, A, B, C, D, E, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT o, s, substr(o, s, 1) AS x FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
r AS (
  SELECT m.*, o, least(CASE WHEN A THEN instr(o, 'A') ELSE 6 END, CASE WHEN B THEN instr(o, 'B') ELSE 6 END,
                       CASE WHEN C THEN instr(o, 'C') ELSE 6 END, CASE WHEN D THEN instr(o, 'D') ELSE 6 END,
                       CASE WHEN E THEN instr(o, 'E') ELSE 6 END) AS gone
  FROM m, orders),
t AS (
  SELECT part, o, s, x, n, good, toxic, gone,
         CASE x WHEN 'A' THEN A WHEN 'B' THEN B WHEN 'C' THEN C WHEN 'D' THEN D ELSE E END AS fails,
         A::int + B::int + C::int + D::int + E::int AS failures
  FROM r JOIN steps USING (o)),
u AS (
  SELECT part, o, s, x, sum(CASE WHEN gone > s THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN gone = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails AND gone < s THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = s THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN gone = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM t GROUP BY ALL)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM u
"""
