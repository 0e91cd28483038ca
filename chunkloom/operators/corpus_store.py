"""A corpus root that is kept up to date: an update refolds only the blocks it touches.

A stored corpus has generations.  The first holds the digest and position of every text
(``leaves``) and the root of every block of positions (``blocks``); each update adds a
generation with the leaves of the blocks it touched and their new roots.  Of a block the
newest generation counts.  A generation is there once its ``blocks`` are written, so
an update that was cut short leaves nothing behind and can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.merkle import leaf_hash
from chunkloom.operators.corpus import BLOCK_BITS, _fold_block, _reduce, number_rows
from chunkloom.sources.staging import names, stage


def _generations(spark: SparkSession, folder: str) -> list[int]:
    """Generations whose blocks were written whole."""
    found = [e for e in names(spark, f"{folder}/blocks") if e.startswith("gen=")]
    done = [e for e in found if "_SUCCESS" in names(spark, f"{folder}/blocks/{e}")]
    return sorted(int(e.removeprefix("gen=")) for e in done)


def _read(spark: SparkSession, folder: str, kind: str, generations: list[int]) -> DataFrame:
    paths = [f"{folder}/{kind}/gen={g}" for g in generations]
    return spark.read.option("basePath", f"{folder}/{kind}").parquet(*paths)


def _newest_blocks(blocks: DataFrame) -> DataFrame:
    fields = [c for c in blocks.columns if c != "block"]
    newest = F.max_by(F.struct(*fields), "gen").alias("_newest")
    return blocks.groupBy("block").agg(newest).select("block", "_newest.*")


def _write(leaves: DataFrame, folder: str, generation: int, bits: int) -> None:
    """Store ``(key, pos, digest)`` rows of whole blocks and the roots of these blocks."""
    spark = leaves.sparkSession
    target = f"{folder}/leaves/gen={generation}"
    # Sorted files: a later update reads the row groups of the blocks it touches.
    leaves.withColumn("block", F.shiftright("pos", bits)).write.mode("overwrite").parquet(target)
    folded = (
        spark.read.parquet(target)
        .groupBy("block")
        .agg(
            F.collect_list(F.struct("pos", "digest")).alias("_entries"),
            F.count(F.lit(1)).alias("n_leaves"),
            F.max("key").alias("last_key"),
        )
        .select(
            "block",
            _fold_block(F.col("block"), F.col("_entries"), bits).alias("digest"),
            "n_leaves",
            "last_key",
            F.lit(bits).alias("bits"),
        )
    )
    folded.write.mode("overwrite").parquet(f"{folder}/blocks/gen={generation}")


def _leaves(df: DataFrame, order_by: str, text: str) -> DataFrame:
    if df.filter(F.col(order_by).isNull()).limit(1).count():
        raise ValueError(f"{order_by} is null in some rows")
    digest = F.unhex(leaf_hash(F.col(text))).alias("digest")
    return df.select(F.col(order_by).alias("key"), digest)


def store_corpus(
    df: DataFrame, folder: str, order_by: str, text: str = "content", bits: int = BLOCK_BITS
) -> None:
    """Store the tree over all texts of a table, in the order of a unique column, in a new folder.

    A null key is an error; null texts have no digest and leave the root null, as
    they do in ``corpus_root``.
    """
    if names(df.sparkSession, folder):
        raise ValueError(f"{folder} is not empty")
    leaves = stage(_leaves(df, order_by, text), "leaves")
    _write(number_rows(leaves, ["key"]), folder, 0, bits)


def update_corpus(delta: DataFrame, folder: str, order_by: str, text: str = "content") -> None:
    """Put changed and appended texts into a stored corpus.

    A row whose key is stored replaces that text; any other is appended and must have a
    greater key than all that are stored, as positions before it stay.  A key that stands
    several times counts once, with its greatest digest.  Only the blocks of these rows are
    read, folded and written; finding them reads the stored keys, not the texts.
    """
    spark = delta.sparkSession
    generations = _generations(spark, folder)
    if not generations:
        raise ValueError(f"no stored corpus in {folder}")
    blocks = stage(_newest_blocks(_read(spark, folder, "blocks", generations)), "blocks")
    leaves = _read(spark, folder, "leaves", generations)
    held = blocks.agg(F.sum("n_leaves").alias("n"), F.max("last_key").alias("last"), F.max("bits").alias("bits"))
    n_held, last, bits = held.first()
    bits = BLOCK_BITS if bits is None else bits

    newest = _leaves(delta, order_by, text).groupBy("key").agg(F.max("digest").alias("digest"))
    # Any generation gives the place of a key: places never change.
    places = leaves.select("key", "pos").join(newest.select("key"), "key", "left_semi").distinct()
    found = stage(newest.join(places, "key", "left").select("key", "pos", "digest"), "delta")
    fresh = found.filter("pos IS NULL").select("key", "digest")
    if last is not None and fresh.filter(F.col("key") <= F.lit(last)).limit(1).count():
        raise ValueError("an appended key lies before stored ones")
    appended = number_rows(fresh, ["key"]).withColumn("pos", F.col("pos") + F.lit(n_held or 0))
    changed = stage(found.filter("pos IS NOT NULL").unionByName(appended), "changed")
    changed = changed.withColumn("block", F.shiftright("pos", bits))
    if not changed.limit(1).count():
        return
    touched = changed.select("block").distinct().join(blocks.select("block", "gen"), "block")
    kept = (
        leaves.join(touched, ["block", "gen"], "left_semi")
        .select("key", "pos", "digest")
        .join(changed.select("pos"), "pos", "left_anti")
    )
    rows = kept.select("key", "pos", "digest").unionByName(changed.select("key", "pos", "digest"))
    _write(rows.repartitionByRange("pos").sortWithinPartitions("pos"), folder, generations[-1] + 1, bits)


def stored_root(spark: SparkSession, folder: str) -> DataFrame:
    """One row ``(root_hash, n_leaves)``, folded from the stored block roots alone."""
    generations = _generations(spark, folder)
    if not generations:
        raise ValueError(f"no stored corpus in {folder}")
    blocks = stage(_newest_blocks(_read(spark, folder, "blocks", generations)), "blocks")
    n_blocks, bits = blocks.agg(F.count(F.lit(1)), F.max("bits")).first()
    level = blocks.select(F.col("block").alias("pos"), "digest", "n_leaves")
    root = _reduce(level, n_blocks, [], bits or BLOCK_BITS)
    return root.agg(
        F.max("root_hash").alias("root_hash"),
        F.coalesce(F.max("n_leaves"), F.lit(0)).cast("bigint").alias("n_leaves"),
    )
