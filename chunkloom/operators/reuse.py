"""Embed each distinct chunk once, and not at all if it is in the cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sources.staging import fresh_path, stage


def _places(chunks: DataFrame) -> DataFrame:
    """``(chunk_hash, path, chunk_index, n_copies)``: the first place of each hash, no text.

    Aggregated per task before the shuffle, so a chunk that a third of all
    files share still sends one row per task.
    """
    first = F.min(F.struct("path", "chunk_index")).alias("_first")
    return (
        chunks.groupBy("chunk_hash")
        .agg(first, F.count(F.lit(1)).alias("n_copies"))
        .select("chunk_hash", "_first.*", "n_copies")
    )


def _with_text(places: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds the text at each place; rows that stand several times give one."""
    place = ["chunk_hash", "path", "chunk_index"]
    found = chunks.select(*place, "chunk").join(places, place)
    kept = [F.any_value(c).alias(c) for c in found.columns if c != "chunk_hash"]
    one = found.groupBy("chunk_hash").agg(*kept)
    return one.select(*place, "chunk", *[c for c in places.columns if c not in place])


def distinct_chunks(chunks: DataFrame) -> DataFrame:
    """One row per chunk hash: its first place, its text and its copies.

    Aggregated per task before the shuffle, so a chunk that a third of all
    files share still sends one row per task.
    """
    first = F.min(F.struct("path", "chunk_index", "chunk")).alias("_first")
    return (
        chunks.groupBy("chunk_hash")
        .agg(first, F.count(F.lit(1)).alias("n_copies"))
        .select("chunk_hash", "_first.*", "n_copies")
    )


def reuse_embeddings(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct chunks with the cached ``embedding`` where there is one.

    ``cache`` has ``(chunk_hash, embedding)``; if it names a hash twice, the
    smallest embedding is taken.  ``needs_embedding`` marks the work to do.
    """
    cached = cache.groupBy("chunk_hash").agg(
        F.min("embedding").alias("embedding"), F.lit(True).alias("_hit")
    )
    joined = distinct_chunks(chunks).join(cached, "chunk_hash", "left")
    return joined.withColumn("needs_embedding", F.col("_hit").isNull()).drop("_hit")


def pending_chunks(chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Only the distinct chunks that the cache does not hold.

    Hashes alone are compared with the cache, and stored with their places; texts are
    then read for chunks that are pending and for no others.
    """
    missing = _places(chunks).join(cache.select("chunk_hash").distinct(), "chunk_hash", "left_anti")
    return _with_text(stage(missing, "pending"), chunks)


def store_cache(cache: DataFrame, name: str, folder: str | None = None, buckets: int | None = None) -> DataFrame:
    """Store a cache as the table ``name``, bucketed by hash, and return it.

    One row per hash, with its smallest embedding.  With as many buckets as the session has
    shuffle partitions, the default, ``reuse_embeddings`` and ``pending_chunks`` shuffle
    the chunks alone and the cache stays where it lies, run after run.  The files go to ``folder``,
    by default a new one in the shared folder.
    """
    spark: SparkSession = cache.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cache.filter("chunk_hash IS NOT NULL").groupBy("chunk_hash").agg(F.min("embedding").alias("embedding"))
    # Dealt as the buckets are, so that each task writes one file.
    dealt = rows.repartition(buckets, "chunk_hash")
    writer = dealt.write.mode("overwrite").bucketBy(buckets, "chunk_hash").sortBy("chunk_hash")
    writer.option("path", folder or fresh_path(spark, "cache")).saveAsTable(name)
    return spark.table(name)
