"""Tables the queries read, derived from the given ones by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators import chunk, fingerprint
from chunkloom.sources import read_spread

_PATH = "concat('repo/', source, '/', lang, '/doc_', doc_id, '.py')"

_MIXED_PATH = """
concat(source, CASE doc_id % 4 WHEN 0 THEN '/.git/' WHEN 1 THEN '/pkg.git/' ELSE '/' END,
  'doc_', doc_id, CASE doc_id % 3 WHEN 0 THEN '.txt' WHEN 1 THEN '.PY' ELSE '.py' END)
"""

# Each line of a document becomes code: a function, a class or a plain line.
_CONTENT = r"""
CASE WHEN doc_id % 50 = 7 THEN '  \n' ELSE concat(
  array_join(transform(split(text, '\n', -1), (l, i) ->
    CASE WHEN i % 5 = 0 THEN concat('def fn_', i, '(a, b):\n    ', l)
         WHEN i % 5 = 3 THEN concat('class K', i, ':\n    # ', l)
         ELSE concat('    ', l) END), '\n'),
  CASE WHEN doc_id % 10 = 0 THEN '\n# Erro\n' WHEN doc_id % 2 = 0 THEN '\n' ELSE '' END) END
"""

# The same with definitions inside others, and comments and decorators above classes.
_NESTED = r"""
array_join(transform(split(text, '\n', -1), (l, i) ->
  CASE WHEN i % 5 = 0 THEN concat('def fn_', i, '(a, b):\n    ', l)
       WHEN i % 5 = 2 THEN concat('    def inner_', i, '(self):\n        ', l)
       WHEN i % 5 = 3 THEN concat('# About K', i, '\n@wrap\nclass K', i, ':\n    # ', l)
       ELSE concat('    ', l) END), '\n')
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_spread(spark, f"{sf_dir}/documents.parquet", "doc_id")


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, path, content)``: every document rewritten as a source file.

    Exploding a one-element array computes the text once per row: a filter on
    it is not pushed below, where it would compute it a second time.
    """
    content = F.explode(F.array(F.expr(_CONTENT))).alias("content")
    return documents(spark, sf_dir).select("doc_id", F.expr(_PATH).alias("path"), content)


def nested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.explode(F.array(F.expr(_NESTED))).alias("content")
    return documents(spark, sf_dir).select(F.expr(_PATH).alias("path"), content)


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths of all source files; the texts are not read."""
    return documents(spark, sf_dir).select(F.expr(_PATH).alias("path"))


def mixed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, n_chars)`` with other suffixes and repository folders in between."""
    return documents(spark, sf_dir).select(F.expr(_MIXED_PATH).alias("path"), "n_chars")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_files(spark, sf_dir).select("path", "content")


def fingerprints(files_: DataFrame) -> DataFrame:
    return fingerprint(chunk(files_)).drop("content")


def known_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots in sync: those of every third document."""
    third = code_files(spark, sf_dir).filter("doc_id % 3 = 0")
    return fingerprints(third).select("root_hash")


def old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier state: some files missing, some with a line more."""
    earlier = code_files(spark, sf_dir).filter("doc_id % 11 <> 0")
    return earlier.withColumn(
        "content",
        F.when(F.col("doc_id") % 3 == 1, F.concat("content", F.lit("\n# v0"))).otherwise(
            F.col("content")
        ),
    )


def new_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_files(spark, sf_dir).filter("doc_id % 13 <> 0")


def old_corpus(docs: DataFrame) -> DataFrame:
    """An earlier corpus: the last tenth of the ids missing, some texts with a line more."""
    last = docs.agg((F.max("doc_id") * 9 / 10).alias("_last"))
    earlier = docs.join(F.broadcast(last), F.col("doc_id") <= F.col("_last")).drop("_last")
    older = F.concat("text", F.lit("\n# v0"))
    return earlier.withColumn("text", F.when(F.col("doc_id") % 97 == 5, older).otherwise(F.col("text")))
