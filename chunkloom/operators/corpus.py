"""Hash-tree roots over ordered sets of any size, whole or per group.

An array fold needs the set in one row.  Here the rows are numbered without
gaps, cut into blocks of a fixed number of positions, and each block is folded
on its own; the block roots are the rows of the next round.  No task ever holds
more than one block, whatever the size of the set or of its largest group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind
from chunkloom.functions.merkle import climb_levels, fold_levels, leaf_hash, tree_height
from chunkloom.sources.staging import stage

BLOCK_BITS = 10


def number_rows(
    df: DataFrame, order_by: Sequence[str], within: Sequence[str] = (), name: str = "pos"
) -> DataFrame:
    """Add a 0-based position without gaps, over all rows or per group.

    Rows are range-partitioned and sorted, so a large group is spread over many
    tasks; the rows before each partition come from per-partition counts.  The
    sorted table is staged: positions must not change if a task runs again.
    ``order_by`` should be unique within a group.
    """
    keys = list(within)
    order = keys + [c for c in order_by if c not in keys]
    ordered = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_row", 33))
    counts = ordered.groupBy(*keys, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    # At most one row per key and partition, so this window stays small.
    before = (
        Window.partitionBy(*keys)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = counts.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.col("_part").alias("_base_part"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
    )
    match = F.col("_part") == F.col("_base_part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    # Without keys there is one row per partition: small enough to broadcast.
    joined = ordered.join(bases if keys else F.broadcast(bases), match)
    return joined.select(*df.columns, (F.col("_base") + F.col("_row")).alias(name))


def _fold_block(block: Column, entries: Column, bits: int) -> Column:
    """Root of one block of ``(pos, digest)`` entries, as a binary digest.

    The first block stops at its own root: if it is not full it is the only
    one.  Any other climbs all its levels, to line up with its full siblings.
    """
    return bind(
        F.transform(F.array_sort(entries), lambda e: F.lower(F.hex(e["digest"]))),
        lambda h: F.unhex(
            fold_levels(h, F.when(block == 0, tree_height(F.size(h))).otherwise(F.lit(bits)))
        ),
    )


def _reduce(level: DataFrame, n_rows: int, keys: list[str], bits: int) -> DataFrame:
    """Fold ``(keys, pos, digest, n_leaves)`` until each group is one row."""
    remaining = max(n_rows - 1, 1).bit_length()
    while remaining > 0:
        blocks = (
            level.withColumn("_block", F.shiftright("pos", bits))
            .groupBy(*keys, "_block")
            .agg(
                F.collect_list(F.struct("pos", "digest")).alias("_entries"),
                F.sum("n_leaves").alias("n_leaves"),
            )
        )
        level = blocks.select(
            *keys,
            F.col("_block").alias("pos"),
            _fold_block(F.col("_block"), F.col("_entries"), bits).alias("digest"),
            "n_leaves",
        )
        remaining -= bits
    return level.select(*keys, F.lower(F.hex("digest")).alias("root_hash"), "n_leaves")


def reduce_blocks(
    df: DataFrame, n_rows: int, within: Sequence[str] = (), bits: int = BLOCK_BITS
) -> DataFrame:
    """Fold ``(keys, pos, hash)`` rows to one ``(keys, root_hash, n_leaves)`` row per group.

    ``pos`` counts from 0 without gaps in each group and ``n_rows`` is at least
    the size of the largest group; it decides the number of rounds.
    """
    keys = list(within)
    leaves = df.select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        F.unhex("hash").alias("digest"),
        F.lit(1).cast("bigint").alias("n_leaves"),
    )
    return _reduce(leaves, n_rows, keys, bits)


def _ordered_roots(
    df: DataFrame, keys: list[str], order_by: Sequence[str], text: str, bits: int
) -> DataFrame:
    # Hashed before any shuffle: 32 bytes per text travel on, not the text.
    names = list(dict.fromkeys([*keys, *order_by]))
    leaves = stage(df.select(*names, F.unhex(leaf_hash(F.col(text))).alias("digest")), "leaves")
    numbered = number_rows(leaves, [*order_by, "digest"], within=keys)
    level = numbered.select(*keys, "pos", "digest", F.lit(1).cast("bigint").alias("n_leaves"))
    return _reduce(level, _largest_group(leaves, keys), keys, bits)


def _largest_group(leaves: DataFrame, keys: list[str]) -> int:
    """Size of the largest group, so that small groups get no idle rounds."""
    if not keys:
        return leaves.count()
    sizes = leaves.groupBy(*keys).count()
    return sizes.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def group_roots(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], text: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Root per group over its texts in order: ``(keys, root_hash, n_leaves)``."""
    return _ordered_roots(df, list(keys), order_by, text, bits)


def corpus_root(
    df: DataFrame, order_by: Sequence[str], text: str = "content", bits: int = BLOCK_BITS
) -> DataFrame:
    """One row ``(root_hash, n_leaves)`` over all texts of a table in order.

    The root of an empty table is null.
    """
    root = _ordered_roots(df, [], order_by, text, bits)
    return root.agg(
        F.max("root_hash").alias("root_hash"),
        F.coalesce(F.max("n_leaves"), F.lit(0)).cast("bigint").alias("n_leaves"),
    )


def _block_levels(block: Column, entries: Column, bits: int) -> Column:
    """All levels of one block as hex digests, its entries first.

    The first block stops at its own root, as in :func:`_fold_block`.
    """
    return bind(
        F.transform(F.array_sort(entries), lambda e: F.lower(F.hex(e["digest"]))),
        lambda h: climb_levels(h, F.when(block == 0, tree_height(F.size(h))).otherwise(F.lit(bits))),
    )


def _block_nodes(blocks: DataFrame, keys: list[str], below: int, bits: int) -> DataFrame:
    """The nodes of stored blocks above their entries, at their places in the whole tree."""
    numbered = blocks.select(*keys, "_block", "_levels", F.posexplode("_levels").alias("_up", "_nodes"))
    width = F.expr(f"shiftleft(1L, {bits} - _up)")
    children = numbered.filter("_up > 0").select(
        *keys, "_block", "_up", width.alias("_width"), F.get("_levels", F.col("_up") - 1).alias("_below"),
        F.posexplode("_nodes").alias("_at", "hash"),
    )
    left = F.get("_below", F.col("_at") * 2)
    return children.select(
        *keys,
        (F.col("_up") + below).cast("int").alias("level"),
        (F.col("_block") * F.col("_width") + F.col("_at")).alias("pos"),
        "hash",
        left.alias("left_hash"),
        F.coalesce(F.get("_below", F.col("_at") * 2 + 1), left).alias("right_hash"),
    )


def tree_nodes(
    df: DataFrame,
    order_by: Sequence[str],
    text: str = "content",
    within: Sequence[str] = (),
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Every node of the tree over all texts in order, or of one tree per group.

    ``(keys, level, pos, hash, left_hash, right_hash)``; level 0 holds the leaves, whose
    children are null, and a lone last node is its own right child.  A block of
    ``2**bits`` nodes gives the ``bits`` levels above it, at their positions in the whole
    tree, and its top is one entry of the next round; no row or task holds more
    than a block, whatever the size of a tree.  A group leaves the rounds with its root.
    """
    keys = list(within)
    names = list(dict.fromkeys([*keys, *order_by]))
    leaves = stage(df.select(*names, F.unhex(leaf_hash(F.col(text))).alias("digest")), "leaves")
    numbered = stage(
        number_rows(leaves, [*order_by, "digest"], within=keys).select(*keys, "pos", "digest"), "numbered"
    )
    none = F.lit(None).cast("string")
    nodes = numbered.select(
        *keys, F.lit(0).alias("level"), "pos", F.lower(F.hex("digest")).alias("hash"),
        none.alias("left_hash"), none.alias("right_hash"),
    )
    level, remaining, below = numbered, _largest_group(leaves, keys), 0
    while remaining > 1:
        blocks = stage(
            level.withColumn("_block", F.shiftright("pos", bits))
            .groupBy(*keys, "_block")
            .agg(F.collect_list(F.struct("pos", "digest")).alias("_entries"))
            .select(*keys, "_block", _block_levels(F.col("_block"), F.col("_entries"), bits).alias("_levels")),
            "blocks",
        )
        nodes = nodes.unionByName(_block_nodes(blocks, keys, below, bits))
        top = F.unhex(F.get(F.element_at("_levels", -1), F.lit(0)))
        level = blocks.select(*keys, F.col("_block").alias("pos"), top.alias("digest"))
        if keys:
            going = blocks.filter("_block = 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            level = level.join(going, same, "left_semi")
        remaining = (remaining + (1 << bits) - 1) >> bits
        below += bits
    return nodes


def corpus_nodes(
    df: DataFrame, order_by: Sequence[str], text: str = "content", bits: int = BLOCK_BITS
) -> DataFrame:
    """:func:`tree_nodes` of the one tree over a whole table."""
    return tree_nodes(df, order_by, text, (), bits)
