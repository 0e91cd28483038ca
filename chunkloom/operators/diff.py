"""What changed between two snapshots, by file and by chunk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.operators.fingerprint import merkle_nodes
from chunkloom.sources.staging import fresh_path, stage

_NODE = "path string, pos bigint, hash binary, n_leaves bigint, is_root boolean, level int"


def _sides(old: DataFrame, new: DataFrame, *columns: str) -> DataFrame:
    left = old.select(F.col("path"), *[F.col(c).alias(f"old_{c}") for c in columns])
    right = new.select(F.col("path"), *[F.col(c).alias(f"new_{c}") for c in columns])
    joined = left.withColumn("_old", F.lit(True)).join(
        right.withColumn("_new", F.lit(True)), "path", "full_outer"
    )
    same = (F.col("old_root_hash") == F.col("new_root_hash")) & (
        F.col("old_n_chunks") == F.col("new_n_chunks")
    )
    return joined.withColumn(
        "change",
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(same, "unchanged")
        .otherwise("changed"),
    ).drop("_old", "_new")


def diff_files(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each path as added, removed, changed or unchanged.

    Both sides have ``(path, root_hash, n_chunks)``, one row per path.
    """
    return _sides(old, new, "root_hash", "n_chunks").select(
        "path", "change", "old_root_hash", "new_root_hash"
    )


def diff_chunks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Kept, added and removed copies of each chunk in files that changed.

    Both sides have ``(path, root_hash, chunk_hashes)``, one row per path.
    Roots are compared first; only hashes of files that differ are unfolded.  Copies
    are counted, not paired, so a chunk repeated any number of times is one
    small sum that is pre-aggregated before the shuffle.
    """
    # Both sides are computed once, in one pass; after that only their hashes are read.
    sides = [
        d.select(
            "path",
            F.lit(is_new).alias("is_new"),
            F.struct(F.unhex("root_hash").alias("root"), F.size("chunk_hashes").alias("n")).alias("tree"),
            F.transform("chunk_hashes", F.unhex).alias("hashes"),
        )
        for is_new, d in enumerate((old, new))
    ]
    stored = stage(sides[0].unionByName(sides[1]), "snapshots")
    differing = (
        stored.groupBy("path")
        .agg(F.count(F.lit(1)).alias("_sides"), F.min("tree").alias("_low"), F.max("tree").alias("_high"))
        .filter("_sides < 2 OR _low <> _high")
        .select("path")
    )
    rows = stored.join(differing, "path", "left_semi").select("path", "is_new", F.explode("hashes").alias("_hash"))
    counts = rows.groupBy("path", "_hash").agg(
        F.sum(1 - F.col("is_new")).alias("n_old"), F.sum("is_new").alias("n_new")
    )
    return counts.select(
        "path",
        F.lower(F.hex("_hash")).alias("chunk_hash"),
        F.least("n_old", "n_new").alias("n_kept"),
        F.greatest(F.col("n_new") - F.col("n_old"), F.lit(0)).alias("n_added"),
        F.greatest(F.col("n_old") - F.col("n_new"), F.lit(0)).alias("n_removed"),
    )


def store_trees(fingerprinted: DataFrame, folder: str | None = None) -> str:
    """Write the trees of files, a folder per level, and return where they are.

    ``(path, pos, hash, n_leaves, is_root, level)``: ``n_leaves`` are the leaves below a
    node, which its hash alone does not tell, as an odd level repeats its last node.
    """
    spark = fingerprinted.sparkSession
    folder = folder or fresh_path(spark, "trees")
    sized = fingerprinted.filter(F.size("chunk_hashes") > 0)
    sizes = sized.select(F.struct("path", F.size("chunk_hashes").alias("n")).alias("path"), "chunk_hashes")
    width = F.expr("shiftleft(1L, level)")
    nodes = merkle_nodes(sizes).select(
        F.col("path.path").alias("path"),
        "pos",
        F.unhex("hash").alias("hash"),
        F.least(width, F.col("path.n") - F.col("pos") * width).alias("n_leaves"),
        ((F.col("pos") == 0) & (width >= F.col("path.n"))).alias("is_root"),
        "level",
    )
    nodes.write.partitionBy("level").parquet(folder)
    return folder


def _top(spark: SparkSession, folder: str) -> int:
    """The highest level stored, told by the names of the folders."""
    names = spark.read.schema(_NODE).parquet(folder).select("level").distinct()
    return names.agg(F.coalesce(F.max("level"), F.lit(-1))).first()[0]


def diff_trees(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``(path, pos, old_hash, new_hash)``: the leaves that differ between stored trees.

    Goes down level by level from the roots that differ.  Of each level only the
    children of nodes that differ are compared, so a subtree that is the same on both
    sides is left out as a whole at its top.  A leaf that one side lacks has a null there.
    """
    trees = [spark.read.schema(_NODE).parquet(folder) for folder in (old, new)]
    top = max(_top(spark, old), _top(spark, new))
    if top < 0:
        return spark.createDataFrame([], "path string, pos bigint, old_hash string, new_hash string")
    frontier = None
    for level in range(top, -1, -1):
        wanted = []
        for side, tree in zip(("old", "new"), trees):
            nodes = tree.filter(F.col("level") == level)
            # Roots begin here; other nodes are looked at below a parent that differs.
            roots = nodes.filter("is_root")
            if frontier is not None:
                below = nodes.filter("NOT is_root").join(frontier, ["path", "pos"], "left_semi")
                # A tree of less height has its root where the other has a differing node.
                roots = roots.unionByName(below)
            wanted.append(
                roots.select("path", "pos", F.col("hash").alias(f"{side}_hash"), F.col("n_leaves").alias(f"{side}_n"))
            )
        same = F.col("old_hash").eqNullSafe(F.col("new_hash")) & F.col("old_n").eqNullSafe(F.col("new_n"))
        differing = stage(wanted[0].join(wanted[1], ["path", "pos"], "full_outer").filter(~same), f"differing-{level}")
        if level:
            child = F.explode(F.array(F.col("pos") * 2, F.col("pos") * 2 + 1)).alias("pos")
            frontier = differing.select("path", child)
    return differing.select(
        "path", "pos", *[F.lower(F.hex(f"{side}_hash")).alias(f"{side}_hash") for side in ("old", "new")]
    )
