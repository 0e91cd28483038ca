"""Chunks of files that come in pieces.

Each piece is chunked on its own.  What came before it, the number of chunks, lines
and newlines, is a running sum over one small row per piece; the text takes no part in
that window.  Only chunks that cross from one piece into the next are put together by a
shuffle; all others are final where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.functions.text import (
    PYTHON_DEFS,
    chunk_text,
    has_text,
    is_boundary,
    line_count,
    newline_count,
    split_lines,
)
from chunkloom.operators.chunking import line_spans
from chunkloom.sources.staging import stage


def _offsets(cut: DataFrame) -> DataFrame:
    """What came before each piece, for files with text; one small row per piece.

    ``joins``: the first chunk goes on from the piece before; ``goes_on``: the last
    one goes on in the piece after.
    """
    ordered = Window.partitionBy("path").orderBy("piece")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.select(
        "path", "piece", "opens", "has_text", "newlines", "lines", F.size("chunks").cast("bigint").alias("size")
    )
    joined = sizes.withColumn("joins", ~F.col("opens") & (F.row_number().over(ordered) > 1))
    own = joined.withColumn("chunks", F.col("size") - F.col("joins").cast("bigint"))
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("chunks", "newlines", "lines")]
    return own.select(
        "path",
        "piece",
        "joins",
        F.coalesce(F.lead("joins").over(ordered), F.lit(False)).alias("goes_on"),
        F.max("has_text").over(Window.partitionBy("path")).alias("has_text"),
        *sums,
    ).filter("has_text")


def chunk_pieces(pieces: DataFrame, pattern: str | None = None) -> DataFrame:
    """The rows that line mode gives for whole files, from ``(path, piece, content)``.

    ``(path, chunk_index, chunk, start_line, end_line, true_start, true_end)``: pieces of
    a path, in order, are its content, and each ends where a line ends.  Files that hold
    nothing but white space give no rows; a null content counts as empty.
    """
    text = F.coalesce("content", F.lit(""))
    # White space alone is no chunk of a file, but it may be a piece of one.
    chunks = F.when(has_text(text), chunk_text(text, "line", pattern)).otherwise(F.array(text))
    chunked = pieces.filter(text != "").select(
        "path", "piece", text.alias("content"), chunks.alias("chunks")
    )
    content = F.col("content")
    cut = stage(
        line_spans(chunked).select(
            "path",
            "piece",
            "chunks",
            "spans",
            F.coalesce(is_boundary(F.get(split_lines(content), F.lit(0)), pattern or PYTHON_DEFS), F.lit(False)).alias("opens"),
            has_text(content).alias("has_text"),
            newline_count(content).cast("bigint").alias("newlines"),
            line_count(content).cast("bigint").alias("lines"),
        ),
        "piece-chunks",
    )
    offsets = stage(_offsets(cut), "piece-offsets")
    rows = cut.select(
        "path", "piece", F.size("chunks").alias("size"), F.posexplode(F.arrays_zip("chunks", "spans")).alias("k", "row")
    ).join(offsets, ["path", "piece"])
    # Reported lines run ahead by one for each chunk before, true lines do not.
    placed = rows.select(
        "path",
        "piece",
        (F.col("chunks_before") + F.col("k") - F.col("joins").cast("int")).alias("chunk_index"),
        F.col("row.chunks").alias("chunk"),
        (F.col("newlines_before") + F.col("row.spans.start_line") - F.col("k")).alias("line"),
        (F.col("row.spans.end_line") - F.col("row.spans.start_line")).cast("bigint").alias("newlines"),
        (F.col("lines_before") + F.col("row.spans.true_start")).alias("true_start"),
        (F.col("lines_before") + F.col("row.spans.true_end")).alias("true_end"),
        ((F.col("joins") & (F.col("k") == 0)) | (F.col("goes_on") & (F.col("k") == F.col("size") - 1))).alias("crosses"),
    )
    fragments = F.array_sort(F.collect_list(F.struct("piece", "chunk")))
    crossing = (
        placed.filter("crosses")
        .groupBy("path", "chunk_index")
        .agg(
            F.array_join(fragments["chunk"], "").alias("chunk"),
            F.min("line").alias("line"),
            F.sum("newlines").alias("newlines"),
            F.min("true_start").alias("true_start"),
            F.max("true_end").alias("true_end"),
        )
    )
    whole = placed.filter("NOT crosses").select(crossing.columns).unionByName(crossing)
    start = F.col("line") + F.col("chunk_index")
    return whole.select(
        "path", "chunk_index", "chunk", start.alias("start_line"), (start + F.col("newlines")).alias("end_line"),
        "true_start", "true_end",
    )
