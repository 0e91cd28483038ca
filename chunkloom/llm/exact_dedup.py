"""Exact duplicates by two passes of Bloom filters, with DataFrame functions only.

Texts are read once, to a stored table of ids and SHA-256 digests.  The first
pass counts digests by cell of a filter and keeps the cells that hold more than
one; the second does the same with another hash among the rows the first could
not clear.  Rows cleared by either pass are unique and go straight to the
result.  Only the rest shuffles, to be grouped by whole digest.

Defined cases: a null text equals an empty one; ids may be null (smaller than
all others) or repeated; of rows that agree in id and text exactly one stays; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import bloom_words, cell, log_bits, probe
from chunkloom.sources.staging import stage


def _digest(text: str):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _cells(bits: int):
    """One cell for each pass, by independent hashes of the digest."""
    return (
        cell(F.xxhash64("__llm_sha"), bits),
        cell(F.xxhash64("__llm_sha", F.lit("second pass")), bits),
    )


def _repeated(rows: DataFrame, cells) -> DataFrame:
    """The filter of cells that more than one row falls into."""
    counted = rows.groupBy(cells.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return bloom_words(counted.filter("n > 1").select("c"))


def _passes(rows: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Both filters, the second over what the first lets through."""
    one, two = _cells(bits)
    first = stage(_repeated(rows, one), "bloom-1")
    maybe = probe(rows, first, one, "__llm_one").filter("__llm_one")
    return first, stage(_repeated(maybe, two), "bloom-2")


def _mark(rows: DataFrame, filters: tuple[DataFrame, DataFrame], bits: int) -> DataFrame:
    """Add ``__llm_may``: both filters have the row's cells."""
    one, two = _cells(bits)
    both = probe(probe(rows, filters[0], one, "__llm_one"), filters[1], two, "__llm_two")
    may = F.col("__llm_one") & F.col("__llm_two")
    return both.withColumn("__llm_may", may).drop("__llm_one", "__llm_two")


def _stored_digests(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    rows = stage(
        docs.select(
            F.col(id_col).alias("__llm_id"),
            _digest(text_col).alias("__llm_sha"),
            F.monotonically_increasing_id().alias("__llm_row"),
        ),
        "digests",
    )
    return rows, log_bits(rows.count())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: ``(id, keep_id, group_size, kept, text_sha256)``.

    ``keep_id`` is the largest id with the same text and ``kept`` marks its row.
    """
    rows, bits = _stored_digests(docs, id_col, text_col)
    marked = _mark(rows, _passes(rows, bits), bits)
    # Counted before they meet the rows: a group of a third of all rows is one row of
    # this table, and the join below can be split by Spark where a digest is frequent.
    groups = stage(
        marked.filter("__llm_may")
        .groupBy("__llm_sha")
        .agg(
            F.max(F.struct("__llm_id", "__llm_row")).alias("__llm_top"),
            F.count(F.lit(1)).alias("__llm_n"),
        )
        .filter("__llm_n > 1"),
        "groups",
    )
    maybe = marked.filter("__llm_may").join(groups, "__llm_sha", "left")
    clear = marked.filter("NOT __llm_may").select(
        "*",
        F.lit(None).cast(groups.schema["__llm_top"].dataType).alias("__llm_top"),
        F.lit(None).cast("bigint").alias("__llm_n"),
    )
    repeated = F.col("__llm_n").isNotNull()
    return maybe.unionByName(clear).select(
        F.col("__llm_id").alias(id_col),
        F.when(repeated, F.col("__llm_top.__llm_id")).otherwise(F.col("__llm_id")).alias("keep_id"),
        F.coalesce("__llm_n", F.lit(1).cast("bigint")).alias("group_size"),
        F.when(repeated, F.col("__llm_top.__llm_row") == F.col("__llm_row"))
        .otherwise(True)
        .alias("kept"),
        F.lower(F.hex("__llm_sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies, all columns: of equal texts the largest id stays.

    Whole rows move only where both filters hit.  They are matched by digest and
    id of the row that stays, so no task gets a group of copies.
    """
    rows, bits = _stored_digests(docs, id_col, text_col)
    filters = _passes(rows, bits)
    same = (
        _mark(rows, filters, bits)
        .filter("__llm_may")
        .groupBy("__llm_sha", "__llm_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = stage(
        same.groupBy("__llm_sha").agg(F.max(F.struct("__llm_id", "n")).alias("top")), "winners"
    ).select(
        F.col("__llm_sha").alias("__llm_top_sha"),
        F.col("top.__llm_id").alias("__llm_top_id"),
        F.col("top.n").alias("__llm_top_n"),
    )
    marked = _mark(docs.withColumn("__llm_sha", _digest(text_col)), filters, bits)
    clear = marked.filter("NOT __llm_may").select(*docs.columns)
    won = marked.filter("__llm_may").join(
        top,
        (F.col("__llm_sha") == F.col("__llm_top_sha"))
        & F.col(id_col).eqNullSafe(F.col("__llm_top_id")),
    )
    single = won.filter("__llm_top_n = 1").select(*docs.columns)
    # Rows that repeat id and text: rare, one of each is taken.
    again = (
        won.filter("__llm_top_n > 1")
        .dropDuplicates(["__llm_sha", "__llm_top_id"])
        .select(*docs.columns)
    )
    return clear.unionByName(single).unionByName(again)
