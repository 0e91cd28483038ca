"""Hash trees over ordered arrays as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind

# No array has more leaves than 2^31, so no tree is higher than this.
_MAX_LEVELS = 31


def leaf_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 text as 64 hex digits."""
    return F.sha2(text, 256)


def leaf_hashes(texts: Column) -> Column:
    return F.transform(texts, leaf_hash)


def _parents(level: Column) -> Column:
    """One level up: hash adjacent pairs, an odd last node with itself.

    Whether there is a right child is told by position: a null leaf makes its
    ancestors null and never takes the place of another.
    """
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")),
        lambda i: F.sha2(
            F.concat(
                F.get(level, 2 * i),
                F.get(level, F.least(2 * i + 1, F.size(level) - 1)),
            ),
            256,
        ),
    )


def tree_height(n_leaves: Column) -> Column:
    """Levels above the leaves: 0 for one leaf, else ceil(log2(n))."""
    return F.when(n_leaves <= 1, 0).otherwise(F.length(F.bin(n_leaves - 1)))


def _steps(height: Column) -> Column:
    return F.slice(F.sequence(F.lit(1), F.lit(_MAX_LEVELS)), F.lit(1), height)


def fold_levels(hashes: Column, height: Column) -> Column:
    """Climb exactly ``height`` levels and return the first node there."""
    top = F.aggregate(_steps(height), hashes, lambda level, _: _parents(level))
    return F.get(top, F.lit(0))


def merkle_root(hashes: Column) -> Column:
    """Root over an ordered array of leaf hashes; null when it is empty or a leaf is null."""
    return bind(
        hashes,
        lambda h: F.when(F.size(h) > 0, fold_levels(h, tree_height(F.size(h)))),
    )


def climb_levels(hashes: Column, height: Column) -> Column:
    """The leaves and the levels above them, exactly ``height`` of these."""
    return F.aggregate(
        _steps(height),
        F.array(hashes),
        lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1)))),
    )


def merkle_levels(hashes: Column) -> Column:
    """All levels of the tree, leaves first; null when there are none."""
    return bind(
        hashes, lambda h: F.when(F.size(h) > 0, climb_levels(h, tree_height(F.size(h))))
    )
