"""The folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session gets a temporary one; a cluster has none that all machines see, so that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        where = tempfile.mkdtemp(prefix="fieldloom-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def fresh_path(spark: SparkSession, name: str = "") -> str:
    """A path in the shared folder that nothing has yet; what is written there goes when the session's JVM ends, or by remove()."""
    path = f"{shared_dir(spark)}/fieldloom/{uuid.uuid4().hex}{'/' + name if name else ''}"
    fs, where = _located(spark, path)
    fs.deleteOnExit(where)
    return path


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.delete(where, True)


def upload(spark: SparkSession, local: str, path: str) -> None:
    """Moves a file of the driver's into the shared folder."""
    fs, where = _located(spark, path)
    fs.copyFromLocalFile(True, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), where)


def _located(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where
