"""The few file-system calls Spark's readers and writers do not cover."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs_path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs_path(spark, path)
    return fs.exists(target)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _fs_path(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs_path(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty if it does not exist."""
    fs, target = _fs_path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def matching(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths below ``path`` that fit the glob ``pattern``, without ``path`` itself; one listing."""
    fs, target = _fs_path(spark, path)
    if not fs.exists(target):
        return []
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, pattern)) or []
    depth = pattern.count("/") + 1
    return sorted("/".join(status.getPath().toString().split("/")[-depth:]) for status in found)


def matching_since(spark: SparkSession, path: str, pattern: str) -> dict[str, int]:
    """As ``matching``, with the time each was last changed."""
    fs, target = _fs_path(spark, path)
    if not fs.exists(target):
        return {}
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, pattern)) or []
    depth = pattern.count("/") + 1
    return {"/".join(s.getPath().toString().split("/")[-depth:]): s.getModificationTime() for s in found}


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, target = _fs_path(spark, path)
    return fs.getFileStatus(target).getModificationTime()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    fs, target = _fs_path(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Puts one small, new file in place at once: it is written aside and renamed."""
    fs, target = _fs_path(spark, path)
    _, aside = _fs_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(aside, target):
        raise OSError(f"could not put {path} in place")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    A machine-local folder is used only where none is named and Spark runs in local mode.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    folder = tempfile.mkdtemp(prefix="fleetpulse-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared folder, so that no executor's loss undoes it."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/fleetpulse/{name}-{uuid.uuid4().hex[:12]}"
