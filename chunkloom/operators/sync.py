"""Which rows does the other side already know?"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.sources.staging import stage

# Fixed value: the one root the simulated service knows, for tests against it.
SIMULATED_KNOWN_ROOTS = ("SIMULATED_KNOWN_HASH",)

# A longer list of roots becomes a table instead of a literal in the plan.
LISTED_ROOTS = 100


def sync(
    rows: DataFrame, known_roots: DataFrame | Iterable[str] = ()
) -> DataFrame:
    """Add ``needs_resync``: false where ``root_hash`` is among the known roots.

    ``known_roots`` is a list of roots, or a DataFrame with ``root_hash`` of any
    size.  Its distinct roots are stored once, so they are computed once and
    Spark sees their size when it chooses between broadcasting them and
    shuffling both sides; in a shuffle it splits roots with many rows.
    """
    if not isinstance(known_roots, DataFrame):
        listed = list(known_roots)
        if len(listed) <= LISTED_ROOTS:
            found = F.col("root_hash").isin(*listed) if listed else F.lit(False)
            return rows.withColumn("needs_resync", ~F.coalesce(found, F.lit(False)))
        known_roots = rows.sparkSession.createDataFrame([(r,) for r in listed], "root_hash string")
    known = stage(known_roots.select(F.col("root_hash").alias("_known")).distinct(), "known-roots")
    joined = rows.join(known, F.col("root_hash") == F.col("_known"), "left")
    return joined.withColumn("needs_resync", F.col("_known").isNull()).drop("_known")
