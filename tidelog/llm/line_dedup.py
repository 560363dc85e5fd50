"""Line de-duplication by overlapping three-line windows.

Every three consecutive lines of a text form a window. A window's content is
kept where it occurs first in the corpus, by ascending (doc_id, position), and
each later occurrence loses the lines it covers; the covered positions of
overlapping windows merge. Built-in column functions only.

Defined cases: a null text stays null; a text of fewer than three lines has no
window and stays as it is; windows of three blank lines are ignored, so that
layout is no repetition; a window repeated inside one text is a later
occurrence too; rows that share doc_id and text count as one place, none is
later than the other; rows that share a doc_id alone are ordered by a hash of
their text; a null doc_id comes before all others.

Windows are compared by 128 bits of hash. Each line is hashed once and a
window combines three line hashes, so texts are not repeated threefold in the
shuffle; it moves one small row per window, pre-aggregated per task. Windows
that occur once are dropped before the join back, whose skewed keys adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(text: Column) -> Column:
    """Array of (pos, h1, h2), one per window with some non-blank line."""
    hashed = F.transform(_lines(text), lambda l: F.struct(
        F.xxhash64(l).alias("a"), F.xxhash64(F.lit("second"), l).alias("b"),
        (F.trim(l) != "").alias("full")))
    first = lambda h: F.sequence(F.lit(0), F.size(h) - WINDOW)
    one = lambda h, i: F.struct(
        i.alias("pos"),
        F.xxhash64(*[h[i + k]["a"] for k in range(WINDOW)]).alias("h1"),
        F.xxhash64(*[h[i + k]["b"] for k in range(WINDOW)]).alias("h2"),
        (h[i]["full"] | h[i + 1]["full"] | h[i + 2]["full"]).alias("full"))
    # the line hashes are bound once, as the only element of an array
    return F.flatten(F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= WINDOW, F.filter(F.transform(first(h), lambda i: one(h, i)), lambda w: w["full"]))
        .otherwise(F.array().cast("array<struct<pos:int,h1:bigint,h2:bigint,full:boolean>>"))))


def repeated_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, removed): per text the sorted first lines of its later
    occurrences; ``th`` is a hash of the text. Texts without any are absent."""
    w = (docs.where(F.col(text_col).contains("\n"))
         .select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                 F.explode(_windows(F.col(text_col))).alias("w"))
         .select("id", "th", "w.pos", "w.h1", "w.h2"))
    at = F.struct("id", "th", "pos")
    first = (w.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.max(at).alias("last"))
             .where("first < last").select("h1", "h2", "first"))
    later = w.join(first, ["h1", "h2"]).where(at > F.col("first"))
    return later.groupBy("id", "th").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def _kept(lines: Column, removed: Column) -> Column:
    """The lines outside the merged covered ranges: slices between them."""
    start = lambda j: F.when(j == 0, F.lit(0)).otherwise(removed[j - 1] + WINDOW)
    end = lambda j: F.when(j == F.size(removed), F.size(lines)).otherwise(F.get(removed, j))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(removed)), lambda j: F.slice(
        lines, start(j) + 1, F.greatest(F.lit(0), end(j) - start(j)))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut from
    ``text_col``, and the columns ``n_lines`` and ``n_removed`` (long, null
    for a null text) in place of any of these names."""
    rep = repeated_positions(docs, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("removed").alias("__removed"))
    own = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    d = docs.select(*[F.col(f"`{c}`") for c in own], F.xxhash64(text_col).alias("__text"))
    j = d.join(rep, d[id_col].eqNullSafe(rep["__id"]) & (d["__text"] == rep["__th"]), "left")
    j = (j.withColumn("__lines", _lines(F.col(text_col)))
         .withColumn("__kept", F.when(F.col("__removed").isNull(), F.col("__lines"))
                     .otherwise(_kept(F.col("__lines"), F.col("__removed")))))
    out = [F.when(F.col("__removed").isNull(), F.col(text_col))
           .otherwise(F.array_join("__kept", "\n")).alias(c) if c == text_col else F.col(f"`{c}`")
           for c in own]
    count = lambda c: F.when(F.col(text_col).isNotNull(), F.size(c).cast("long"))
    return j.select(*out, count("__lines").alias("n_lines"),
                    (count("__lines") - count("__kept")).alias("n_removed"))


def op3_line_windows(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


ORACLE = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS pos FROM d),
w AS (SELECT doc_id, pos, ls[pos] AS a, ls[pos + 1] AS b, ls[pos + 2] AS c FROM p
      WHERE trim(ls[pos]) <> '' OR trim(ls[pos + 1]) <> '' OR trim(ls[pos + 2]) <> ''),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS rk FROM w),
gone AS (SELECT DISTINCT doc_id, pos + o AS pos FROM r, (VALUES (0), (1), (2)) t(o) WHERE rk > 1),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS kept, count(*) AS n
      FROM l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
       CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(k.n, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
