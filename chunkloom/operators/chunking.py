"""From files to chunks: splitting, enumerating, counting and line spans.

Every operator takes and returns a DataFrame, so they chain with
``df.transform``.  All are row-local: a file never leaves its row and nothing
is shuffled, in batch and on a stream alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind, running_totals
from chunkloom.functions.text import (
    PYTHON_DEFS,
    chunk_text,
    has_text,
    is_boundary,
    line_count,
    newline_count,
    only_newlines,
    split_lines,
)


def matching_files(files: DataFrame, suffix: str = ".py", skip: str = ".git") -> DataFrame:
    """Keep files whose name ends in ``suffix`` and that lie in no ``skip`` directory."""
    parts = F.split("path", "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return files.filter(F.endswith(F.col("path"), F.lit(suffix)) & ~F.array_contains(folders, skip))


def nonblank(files: DataFrame) -> DataFrame:
    """Drop files that hold nothing but white space."""
    return files.filter(has_text(F.col("content")))


def chunk(files: DataFrame, mode: str = "line", pattern: str | None = None) -> DataFrame:
    """Add ``chunks``, the ordered chunks of ``content``; blank files are dropped."""
    return nonblank(files).withColumn("chunks", chunk_text(F.col("content"), mode, pattern))


def with_chunks_only(chunked: DataFrame) -> DataFrame:
    """Drop files that gave no chunk."""
    return chunked.filter(F.size("chunks") > 0)


def line_spans(chunked: DataFrame, true: bool = True) -> DataFrame:
    """Add ``spans``, one struct per chunk with its line numbers.

    ``start_line``/``end_line`` are the reported numbers: each chunk counts as
    its newlines plus one, so they run ahead by one line per chunk.
    ``true_start``/``true_end`` are the real 1-based lines in the file.
    """
    counted = chunked.withColumn("_newlines", F.transform("chunks", newline_count))
    totals = running_totals(F.transform("_newlines", lambda n: n + 1))
    if not true:
        started = counted.withColumn("_starts", totals)
        spans = F.transform(F.arrays_zip("_starts", "_newlines"), _reported_span)
        return started.withColumn("spans", spans).drop("_starts", "_newlines")
    # Where LF ends every line, the reported numbers run ahead by exactly one
    # line per earlier chunk; other texts have their lines counted.
    started = counted.withColumns({"_starts": totals, "_plain": only_newlines(F.col("content"))})
    # Every chunk but the last ends with a line; the last may stop inside one.
    open_end = F.when(F.endswith(F.col("content"), F.lit("\n")), 0).otherwise(1)
    last = F.size("chunks") - 1
    plain_lines = bind(
        F.struct(open_end.alias("rest"), last.alias("last")),
        lambda end: F.transform(
            "_newlines", lambda n, k: F.when(k == end["last"], n + end["rest"]).otherwise(n)
        ),
    )
    located = started.withColumn(
        "_lines", F.when(F.col("_plain"), plain_lines).otherwise(F.transform("chunks", line_count))
    ).withColumn(
        "_true_starts",
        F.when(F.col("_plain"), F.transform("_starts", lambda s, k: s - k)).otherwise(
            running_totals(F.col("_lines"))
        ),
    )
    spans = F.transform(
        F.arrays_zip("_starts", "_newlines", "_true_starts", "_lines"), _true_span
    )
    return located.withColumn("spans", spans).drop(
        "_starts", "_newlines", "_true_starts", "_lines", "_plain"
    )


def _reported_span(row: Column) -> Column:
    return F.struct(
        (row["_starts"] + 1).alias("start_line"),
        (row["_starts"] + 1 + row["_newlines"]).alias("end_line"),
    )


def _true_span(row: Column) -> Column:
    return F.struct(
        (row["_starts"] + 1).alias("start_line"),
        (row["_starts"] + 1 + row["_newlines"]).alias("end_line"),
        (row["_true_starts"] + 1).alias("true_start"),
        (row["_true_starts"] + row["_lines"]).alias("true_end"),
    )


def explode_chunks(chunked: DataFrame, *arrays: str) -> DataFrame:
    """One row per chunk with its 0-based ``chunk_index``.

    ``arrays`` names further columns aligned with ``chunks`` to explode along:
    ``chunk_hashes`` becomes ``chunk_hash``, ``spans`` becomes its fields.
    """
    kept = [c for c in chunked.columns if c not in ("content", "chunks", "chunk_hashes", "spans")]
    rows = chunked.select(
        *kept, F.posexplode(F.arrays_zip("chunks", *arrays)).alias("chunk_index", "_row")
    )
    fields = [F.col("_row.chunks").alias("chunk")]
    for name in arrays:
        if name == "spans":
            fields.append(F.col("_row.spans.*"))
        else:
            fields.append(F.col(f"_row.{name}").alias(name.replace("hashes", "hash")))
    return rows.select(*kept, "chunk_index", *fields)


def chunk_counts(chunked: DataFrame) -> DataFrame:
    """``(path, n_chunks)`` per file."""
    return chunked.select("path", F.size("chunks").alias("n_chunks"))


def lines(files: DataFrame, pattern: str = PYTHON_DEFS) -> DataFrame:
    """One row per line, terminator kept, and whether it is a boundary."""
    rows = files.select("path", F.posexplode(split_lines(F.col("content"))).alias("line_index", "line"))
    return rows.withColumn("is_boundary", is_boundary(F.col("line"), pattern))
