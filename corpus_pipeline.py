"""From raw documents to packed sequences, stage by stage.

Each stage gets what the one before kept, and is written to the shared folder and
read back before the next.  Good documents without copies, near copies and benchmark
passages end up as pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkloom.llm.common import table
from chunkloom.llm.decontaminate import decontaminate
from chunkloom.llm.exact_dedup import exact_dedup
from chunkloom.llm.near_dedup import near_dedup
from chunkloom.llm.packing import pack
from chunkloom.llm.quality import keep_good
from chunkloom.sources.staging import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies."""
    return near_dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences."""
    return pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Signatures, models and tokens have no SQL; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
