"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import work_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    Cuts the lineage at a place every executor sees, so that a lost executor
    costs the running stage only."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TEXTS_PER_BATCH = 1000


def text_batches(spark: SparkSession) -> None:
    """Batches of texts for Python of at most ``TEXTS_PER_BATCH`` rows: the
    engine's default of ten times as many is meant for short rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > TEXTS_PER_BATCH:
        spark.conf.set(name, str(TEXTS_PER_BATCH))


def give_back() -> None:
    """At the end of a task: memory that a reused worker holds but doesn't
    need goes back to the system."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def code_points(c):
    """Length of a text in code points, as a long (null: 0)."""
    return F.coalesce(F.char_length(c), F.lit(0)).cast("long")
