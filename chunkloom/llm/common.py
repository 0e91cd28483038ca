"""What several of the operators share: tables, folds, Bloom words, removal of rows by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bloom filters have 16 bits for each key, within these bounds: 2**26 bits are at
# most 2**20 words, about 40 MB as a broadcast table.  With more keys than that the
# filter passes more rows to the exact step behind it; results do not change.
MIN_LOG_BITS = 12
MAX_LOG_BITS = 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def log_bits(n_keys: int) -> int:
    """Logarithm of the size of a filter for so many keys."""
    return min(MAX_LOG_BITS, max(MIN_LOG_BITS, (16 * max(n_keys, 1) - 1).bit_length()))


def cell(hashed: Column, bits: int) -> Column:
    """The bit that a 64-bit hash stands for in a filter of ``2**bits`` bits."""
    return F.shiftrightunsigned(hashed, 64 - bits)


def bloom_words(cells: DataFrame) -> DataFrame:
    """``(__llm_word, __llm_mask)`` from a table of one column of cells: 64 bits a row."""
    (name,) = cells.columns
    mask = F.expr(f"bit_or(shiftleft(1L, CAST(`{name}` & 63 AS INT)))")
    return cells.groupBy(F.shiftright(name, 6).alias("__llm_word")).agg(mask.alias("__llm_mask"))


def probe(df: DataFrame, words: DataFrame, cells: Column, name: str) -> DataFrame:
    """Add a boolean: is the row's cell set?  The filter is broadcast, its size is bounded."""
    columns = df.columns
    looked = (
        df.withColumn("__llm_cell", cells)
        .withColumn("__llm_word", F.shiftright("__llm_cell", 6))
        .join(F.broadcast(words), "__llm_word", "left")
    )
    hit = F.expr("coalesce(getbit(__llm_mask, CAST(__llm_cell & 63 AS INT)), 0Y) = 1Y")
    return looked.select(*columns, hit.alias(name))


def rows_among(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` by a filter over ``ids``: (rows that may be among them, rows that are not).

    ``ids`` is a stored table of one column.  Rows are split as they are
    scanned, before any shuffle, so those that cannot match never move.  Keys are
    hashed as the type of ``ids``: equal numbers of other types have other hashes.
    """
    (name,) = ids.columns
    kind = ids.schema[name].dataType
    bits = log_bits(ids.count())
    words = bloom_words(ids.select(cell(F.xxhash64(name), bits).alias("c")))
    marked = probe(df, words, cell(F.xxhash64(F.col(key).cast(kind)), bits), "__llm_may")
    return (
        marked.filter("__llm_may").drop("__llm_may"),
        marked.filter("NOT __llm_may").drop("__llm_may"),
    )


def without_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """``df`` without the rows whose key is in ``ids``, a stored table of one column.

    Only rows that the filter cannot clear shuffle for the anti-join.
    """
    (name,) = ids.columns
    maybe, clear = rows_among(df, ids, key)
    gone = ids.select(F.col(name).alias("__llm_gone")).distinct()
    left = maybe.join(gone, maybe[key] == gone["__llm_gone"], "left_anti")
    return clear.unionByName(left)
