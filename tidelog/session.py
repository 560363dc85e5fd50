"""Session settings and the shared work folder.

Every job in this package reads and writes through the session it is given.
One setting matters for correctness, and is applied at runtime so that it also
holds on a session that someone else built: partition column type inference is
switched off, so that directory values such as ``appid=007`` or ``storeid=0905``
read back unchanged. Nothing else of the caller's session is changed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidelog", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, build your own and
    call :func:`prepare` on it."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package relies on."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a distributed file system
    path). Only when it is unset, as in local tests, a folder under the
    system temp directory is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidelog-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one job."""
    return f"{shared_dir(spark)}/tidelog/{name}-{uuid.uuid4().hex[:12]}"
