"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words. Its documents all have the same expected
number of copies, target over size; the whole part is taken, and the fraction
is a copy probability that is rounded to no copy or one more. Rounding is not
independent: two documents with open probabilities meet, and words of
probability mass move from one to the other until one of them is settled at 0
or 1. The direction is drawn so that no probability changes in expectation, and
the mass of both together stays the same, so a source's taken words differ from
its target by less than the one document that stays open to the end.

The meetings form a tree. A source's rows are dealt by hash into blocks of about
``BLOCK_ROWS``, at its leaves; a block leaves at most one open document. The
open ones of ``FAN_IN`` blocks meet at the next level, until one is left for each
source, which is rounded by its own probability. Large documents come first in
a block, so that many small ones settle them. A block is sorted by Spark and read
as a stream with one open document in memory. Draws are hashes of the documents
that meet and blocks are dealt by hash, so a rerun agrees, however the table is
split into files and tasks.

Targets: weights go round over the sources in code point order, null last;
they share ``share`` of all words. A target stops at ``most`` times its source's
size, and the excess goes to the others by weight, until none is above. That is
one water level: sources sorted by size over weight are full up to some place,
found from running sums over range parts, so sources are never gathered either.

Defined cases: a null or empty text, or one of white space, has size 0 and
nothing is taken; a source of such texts has target 0; a null source is a source
of its own, other than the empty one; rows that share a doc_id, or have none, are
documents of their own; equal rows are interchangeable; a very long text is
counted whole, without a list of its words; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_ROWS = 20_000
FAN_IN = 64
SOURCES_SENT = 100_000      # a source table of at most so many rows is broadcast
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_SOURCE = ["no_source", "name"]
_EPS = 1e-12


def word_count(text: Column) -> Column:
    """Number of words, each replaced by one letter rather than listed."""
    from_word = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+", "")
    return F.char_length(F.regexp_replace(from_word, f"{WORD}{SPACE}*", "x")).cast("long")


def _sums_before(df: DataFrame, order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """``df`` with running sums of the rows before each one in ``order``:
    ``sums`` names each and the column it adds up. Only one row of each range
    part meets those of the others."""
    parts = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    own = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    earlier = totals.select("__part", *[F.coalesce(F.sum(f"__{n}").over(across), F.lit(0)).alias(f"__{n}")
                                        for n in sums])
    here = parts.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(n) for n, c in sums.items()])
    return here.join(earlier, "__part").select(
        *df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                   most: int = MOST) -> DataFrame:
    """``sizes(no_source, name, source_size, n)`` with each source's ``target``."""
    ranked = _sums_before(sizes.withColumn("__one", F.lit(1)), _SOURCE, {"__place": "__one"}, "sources")
    per_weight = lcm(*weights)
    weight = F.array(*map(F.lit, weights))[F.pmod("__place", F.lit(len(weights))).cast("int")]
    ranked = ranked.select(*sizes.columns, weight.cast("long").alias("weight"))
    ranked = ranked.withColumn("__full_at", F.col("source_size") * (F.lit(per_weight) / F.col("weight")).cast("long"))
    filled = written(_sums_before(ranked, ["__full_at", *_SOURCE], {"__size": "source_size", "__weight": "weight"},
                                  "fill-order"), "source-fill")
    total = filled.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    # the level if all sources before a row are full; the first row below its own limit gives it
    level = (F.lit(share * (total["size"] or 0)) - most * F.col("__size")) / (F.lit(total["weight"]) - F.col("__weight"))
    below = filled.withColumn("level", level).where(F.col("level") * F.col("weight") <= most * F.col("source_size"))
    found = below.agg(F.min_by("level", F.struct("__full_at", *_SOURCE)).alias("level")).first()["level"]
    limit = (F.col("source_size") * most).cast("double")
    target = limit if found is None else F.least(limit, F.lit(float(found)) * F.col("weight"))
    return filled.select(*sizes.columns, F.greatest(target, F.lit(0.0)).alias("target"))


# ---------------------------------------------------------------------------
# rounding
# ---------------------------------------------------------------------------

def _draw(a: int, b: int, level: int) -> float:
    """A number from 0 to 1 that depends on the two documents and the level."""
    z = (a ^ (b * 0x9E3779B97F4A7C15) ^ (level + 1) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((z ^ (z >> 31)) >> 11) / float(1 << 53)


def meet(mass_a: float, a: float, mass_b: float, b: float, draw: float) -> tuple[float, float]:
    """New probabilities of two open documents: one is settled, and
    ``mass_a * a + mass_b * b`` stays."""
    def give(mx, x, my, y):
        """x gives mass to y until x is 0 or y is 1."""
        have, room = mx * x, my * (1 - y)
        if have <= room:
            return 0.0, min(1.0, y + have / my)
        return max(0.0, x - room / mx), 1.0

    up = min(mass_a * a, mass_b * (1 - b))
    down = min(mass_b * b, mass_a * (1 - a))
    if draw * (up + down) < down:
        a, b = give(mass_a, a, mass_b, b)
    else:
        b, a = give(mass_b, b, mass_a, a)
    return tuple(round(p) * 1.0 if min(p, 1 - p) < _EPS else p for p in (a, b))


def settle(groups: list, mass: list, prob: list, marks: list, level: int) -> int:
    """Rounds ``prob`` in place, row by row; returns the row of the last group
    that stays open, or -1."""
    open_, group = -1, None
    for i, g in enumerate(groups):
        if g != group:
            open_, group = -1, g
        if not 0 < prob[i] < 1:
            continue
        if open_ >= 0:
            o = open_
            prob[o], prob[i] = meet(mass[o], prob[o], mass[i], prob[i], _draw(marks[o], marks[i], level))
            if 0 < prob[o] < 1:
                continue
        open_ = i if 0 < prob[i] < 1 else -1
    return open_


def _level(rows: DataFrame, level: int) -> DataFrame:
    """One level of meetings: rows of a source and block, largest first."""
    names = rows.columns
    at = {c: names.index(c) for c in (*_SOURCE, "block", "size", "prob", "mark")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            if held is not None:
                t = pa.concat_tables([held, t])
            if not t.num_rows:
                continue
            col = lambda c: t.column(at[c]).to_pylist()
            prob = col("prob")
            groups = list(zip(col("no_source"), col("name"), col("block"), strict=True))
            left = settle(groups, col("size"), prob, col("mark"), level)
            t = t.set_column(at["prob"], "prob", pa.array(prob, pa.float64()))
            held = None if left < 0 else t.slice(left, 1)
            done = t if left < 0 else pa.concat_tables([t.slice(0, left), t.slice(left + 1)])
            yield from done.to_batches()
        if held is not None:
            yield from held.to_batches()

    dealt = rows.repartition(*_SOURCE, "block").sortWithinPartitions(
        *_SOURCE, "block", F.desc("size"), "mark", "doc_id")
    return dealt.mapInArrow(run, rows.schema)


def round_copies(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``prob`` settled at 0 or 1. ``blocks`` is the largest
    number of blocks of a source."""
    settled = []
    level, left = 0, rows
    while True:
        after = written(_level(left, level), f"mix-level-{level}")
        is_open = (F.col("prob") > 0) & (F.col("prob") < 1)
        settled.append(after.where(~is_open))
        if blocks <= 1:
            break
        level, blocks = level + 1, ceil(blocks / FAN_IN)
        left = after.where(is_open).withColumn("block", F.floor(F.col("block") / FAN_IN))
    last = after.where(is_open)
    draw = F.shiftrightunsigned(F.xxhash64("mark", F.lit("last")), 11) / float(1 << 53)
    settled.append(last.withColumn("prob", F.when(draw < F.col("prob"), 1.0).otherwise(0.0)))
    return reduce(DataFrame.unionByName, settled)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of ``docs(doc_id,
    text, source)``: how often the mix takes each document, and its words."""
    sized = written(docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"),
        word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("mark")), "mix-sizes")
    sizes = sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + 1e-9)
    targets = written(source_targets(sizes, weights, share, most).select(
        *_SOURCE, "source_size", "target", whole.alias("whole"),
        F.when(rate - whole > 1e-9, rate - whole).otherwise(0.0).alias("prob"),
        F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")), "mix-targets")
    known = targets.agg(F.count(F.lit(1)).alias("n"), F.max("blocks").alias("blocks")).first()
    send = F.broadcast(targets) if known["n"] <= SOURCES_SENT else targets.hint("merge")
    rows = sized.join(send, _SOURCE).withColumn("block", F.pmod("mark", F.col("blocks"))).drop("blocks")
    opened = (F.col("prob") > 0) & (F.col("size") > 0)
    settled = round_copies(rows.where(opened), known["blocks"] or 1)
    fixed = rows.where(~opened).withColumn("prob", F.lit(0.0))
    copies = F.col("whole") + F.col("prob").cast("long")
    return fixed.unionByName(settled).select(
        "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op11_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs)
