"""Small file-system helpers for table metadata (never for row data).

Every path is resolved by the session's Hadoop configuration first, so a path
without a scheme means the cluster's default file system, as it does for
Spark's readers and writers. ``os`` is used only where the resolved file
system is the local one; everything else goes through the Hadoop
``FileSystem``. Only names, markers and small JSON state documents pass
through here.
"""

from __future__ import annotations

import glob as _glob
import os
import re
import shutil
import uuid

from pyspark.sql import SparkSession


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority of the file system it is on."""
    fs, p = hadoop_fs(spark, path)
    return fs.makeQualified(p).toString()


def _local(spark: SparkSession, path: str) -> str | None:
    """The path for ``os`` if ``path`` is on the local file system, else None."""
    fs, p = hadoop_fs(spark, path)
    q = fs.makeQualified(p)
    return q.toUri().getPath() if q.toUri().getScheme() == "file" else None


def literal(path: str) -> str:
    """``path`` for a reader that takes patterns: pattern characters escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def exists(spark: SparkSession, path: str) -> bool:
    lp = _local(spark, path)
    if lp is not None:
        return os.path.exists(lp)
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty when it is missing)."""
    lp = _local(spark, path)
    if lp is not None:
        return sorted(os.listdir(lp)) if os.path.isdir(lp) else []
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def marked_children(spark: SparkSession, path: str, marker: str) -> list[str]:
    """Names of the direct children of ``path`` that hold a file ``marker``."""
    lp = _local(spark, path)
    if lp is not None:
        return [n for n in list_names(spark, path) if os.path.exists(os.path.join(lp, n, marker))]
    fs, p = hadoop_fs(spark, f"{literal(path)}/*/{marker}")
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(p) or [])


def partition_dirs(spark: SparkSession, base: str, names: list[str]) -> list[str]:
    """Paths of the ``name=value`` directories below ``base``, one level per name."""
    below = "".join(f"/{n}=*" for n in names)
    lp = _local(spark, base)
    if lp is not None:
        return sorted(h for h in _glob.glob(_glob.escape(lp) + below) if os.path.isdir(h))
    fs, p = hadoop_fs(spark, literal(base) + below)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    lp = _local(spark, path)
    if lp is not None:
        with open(lp) as fh:
            return fh.read()
    fs, p = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Publish ``text`` at ``path`` only if nothing is there yet.

    The document is written to a private temporary name first and then moved
    into place by an operation that fails when the target exists (a hard
    link locally; on Hadoop file systems ``FileContext.rename`` without
    overwrite, as Spark's own checkpoint log does, which is atomic on HDFS),
    so a reader sees either no file or the whole document. Returns False
    when another writer won.
    """
    parent = path.rsplit("/", 1)[0]
    tmp = f"{parent}/_tmp-{uuid.uuid4().hex}"
    lp = _local(spark, path)
    if lp is not None:
        lt = _local(spark, tmp)
        os.makedirs(os.path.dirname(lp), exist_ok=True)
        with open(lt, "w") as fh:
            fh.write(text)
            fh.flush()
            os.fsync(fh.fileno())
        try:
            os.link(lt, lp)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(lt)
    fs, p = hadoop_fs(spark, path)
    _, tp = hadoop_fs(spark, tmp)
    fs.mkdirs(p.getParent())
    out = fs.create(tp, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    no_overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        fc.rename(fs.makeQualified(tp), fs.makeQualified(p), no_overwrite)
        return True
    except Exception as e:  # py4j wraps the Java exception
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    finally:
        if fs.exists(tp):
            fs.delete(tp, False)


def delete(spark: SparkSession, path: str) -> None:
    lp = _local(spark, path)
    if lp is not None:
        if os.path.isdir(lp):
            shutil.rmtree(lp)
        elif os.path.exists(lp):
            os.unlink(lp)
        return
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def mtime(spark: SparkSession, path: str) -> float:
    """Modification time in seconds."""
    lp = _local(spark, path)
    if lp is not None:
        return os.path.getmtime(lp)
    fs, p = hadoop_fs(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000.0


def mkdirs(spark: SparkSession, path: str) -> None:
    lp = _local(spark, path)
    if lp is not None:
        os.makedirs(lp, exist_ok=True)
        return
    fs, p = hadoop_fs(spark, path)
    fs.mkdirs(p)
