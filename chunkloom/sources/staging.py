"""Tables written once and read back, to cut lineage at a safe point."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every node sees: ``spark.checkpoint.dir`` of the session.

    Where it is unset a temporary folder is taken, but only in local mode: on
    a cluster the executors could not read each other's files there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="chunkloom-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/chunkloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then start from files: a lost executor costs a re-read, not a
    recomputation, and rows keep the values they were numbered with.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    """A path and its file system, as the session is set up."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared folder, through the session's own file systems."""
    location, system = _located(spark, path)
    system.delete(location, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    location, system = _located(spark, path)
    if not system.exists(location):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(location))


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file; its name is all it says, so it is there whole or not at all."""
    location, system = _located(spark, path)
    system.create(location, True).close()
