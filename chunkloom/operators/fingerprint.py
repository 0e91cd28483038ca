"""File fingerprints: leaf hashes, hash-tree roots and node tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind
from chunkloom.functions.merkle import leaf_hashes, merkle_levels, merkle_root


def fingerprint(chunked: DataFrame) -> DataFrame:
    """Add ``chunk_hashes`` and ``root_hash`` to files that carry ``chunks``."""
    hashed = chunked.withColumn("chunk_hashes", leaf_hashes(F.col("chunks")))
    return hashed.withColumn("root_hash", merkle_root(F.col("chunk_hashes")))


def with_root(fingerprinted: DataFrame) -> DataFrame:
    """Drop files without a root, that is without any chunk."""
    return fingerprinted.filter(F.col("root_hash").isNotNull())


def file_roots(fingerprinted: DataFrame) -> DataFrame:
    """``(path, root_hash, n_chunks)``, the row that change detection compares.

    The chunk count goes with the root because an odd level repeats its last
    node: ``[a, b, c]`` and ``[a, b, c, c]`` have the same root.
    """
    return fingerprinted.select("path", "root_hash", F.size("chunk_hashes").alias("n_chunks"))


def merkle_nodes(fingerprinted: DataFrame) -> DataFrame:
    """Every node of every file's tree; level 0 holds the leaves.

    The right child of a lone last node is the node itself, as in the hash.
    """

    def with_children(nodes: Column, below: Column, level: Column) -> Column:
        def node(h: Column, pos: Column) -> Column:
            left = F.get(below, pos * 2)
            return F.struct(
                level.alias("level"),
                pos.cast("bigint").alias("pos"),
                h.alias("hash"),
                left.alias("left_hash"),
                F.coalesce(F.get(below, pos * 2 + 1), left).alias("right_hash"),
            )

        return F.transform(nodes, node)

    tree = bind(
        merkle_levels(F.col("chunk_hashes")),
        lambda levels: F.flatten(
            F.transform(
                levels,
                lambda nodes, i: with_children(
                    nodes, F.when(i > 0, F.get(levels, i - 1)), i
                ),
            )
        ),
    )
    return fingerprinted.select("path", F.explode(tree).alias("_node")).select("path", "_node.*")
