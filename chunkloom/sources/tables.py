"""Tables as sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SPLIT_BYTES = 128 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system alone."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(location).getLength()


def read_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Read a parquet table so that every slot gets work.

    A table with fewer splits than the cluster has slots, often a single row
    group, would leave most of them idle while few tasks split and hash all the
    text; such a table is small, and is spread by ``key``.  A larger one is read
    as it lies, without a shuffle.
    """
    table = spark.read.parquet(path)
    slots = spark.sparkContext.defaultParallelism
    if stored_bytes(spark, path) < slots * _SPLIT_BYTES:
        return table.repartition(slots, key)
    return table


def from_table(df: DataFrame, path: str | Column, content: str | Column) -> DataFrame:
    """Any table as files: which columns are the path and the text."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(as_column(path).alias("path"), as_column(content).alias("content"))


def write_index(index: DataFrame, folder: str, mode: str = "append", run_id: int | None = None) -> None:
    """Store index rows as parquet, one partition per status.

    With ``run_id`` the rows go to a folder of that run, whatever the mode, and replace what
    an earlier try of the same run left: a repeated run doubles nothing.  A folder holds
    rows either with runs or without.
    """
    target, how = (folder, mode) if run_id is None else (f"{folder}/run_id={run_id}", "overwrite")
    index.write.mode(how).partitionBy("status").parquet(target)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Stored index rows, with their ``run_id`` where they were written with one."""
    return spark.read.parquet(folder)
