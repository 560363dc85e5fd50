"""The corpus pipeline: five stages over ``documents``, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet under the shared folder and read back as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import code_points, written
from tidelog.llm.jaccard_join import classes
from tidelog.llm.language_id import UNKNOWN, fit, held_out, predict
from tidelog.llm.line_dedup import dedup_lines
from tidelog.llm.packing import pack
from tidelog.llm.pseudonyms import pseudonymise

ROW = "__row"


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``n_chars`` brought up to its text."""
    return docs.select(*[code_points(F.col("text")).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go: no text, or no letter."""
    model = fit(docs.where(~held_out("doc_id")))
    return predict(docs, model).where(F.col("lang_pred") != UNKNOWN).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; so does a document that
    loses all its lines, or all but blank ones."""
    d = dedup_lines(docs)
    return _with_text(d.where((F.col("n_removed") == 0) | (F.trim("text") != "")), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the smallest id.

    Rows without an id, or whose id others have too, are told apart by numbers
    of their own beyond all ids: such a row goes only if its text is a near copy
    of one that stays, whatever its id."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    shared = written(docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "shared-ids")
    rows = docs.withColumn(ROW, F.col("doc_id").cast("long"))
    if not shared.isEmpty():
        beyond = (docs.agg(F.max("doc_id")).first()[0] or 0) + 1
        own = rows.where("doc_id IS NOT NULL").join(shared, "doc_id", "left_anti")
        other = docs.where("doc_id IS NULL").unionByName(docs.join(shared, "doc_id", "left_semi"))
        # written, so that a row keeps its number
        other = written(other.withColumn(ROW, F.monotonically_increasing_id() + F.lit(beyond)), "rows-without-id")
        rows = own.select(*columns, ROW).unionByName(other.select(*columns, ROW))
    kept = classes(rows.select(F.col(ROW).alias("doc_id"), "text")).where("doc_id = component_id").select(
        F.col("doc_id").alias(ROW))
    return rows.join(kept, ROW).select(*columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms."""
    return _with_text(pseudonymise(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Classifier, tokenizer and keyed permutations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
