"""The whole index: from files to one described row per chunk."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.ids import cached_id, embedding_id, line_label
from chunkloom.functions.paths import DEFAULT_KEY, obfuscate_path
from chunkloom.functions.text import content_preview
from chunkloom.operators.chunking import chunk, explode_chunks, line_spans
from chunkloom.operators.fingerprint import fingerprint
from chunkloom.operators.sync import sync

_TRUE_LINES = ("true_start", "true_end")


def describe_chunks(
    files: DataFrame,
    key: str = DEFAULT_KEY,
    mode: str = "line",
    pattern: str | None = None,
    fails: Callable[[Column], Column] | None = None,
    true_lines: bool = False,
) -> DataFrame:
    """One narrow row per chunk with everything that depends on the file alone.

    The text stays behind: ids, hashes, previews and flags are taken from it
    here, before any join, so that no later shuffle carries content.
    ``true_lines`` adds the real line numbers to the reported ones.
    """
    prepared = fingerprint(chunk(files.select("path", "content"), mode, pattern))
    prepared = line_spans(prepared, true=true_lines)
    prepared = prepared.withColumn("pseudonym", obfuscate_path(F.col("path"), key))
    rows = explode_chunks(prepared, "chunk_hashes", "spans")
    text, pseudonym = F.col("chunk"), F.col("pseudonym")
    return rows.select(
        "path",
        "pseudonym",
        "root_hash",
        "chunk_index",
        "chunk_hash",
        content_preview(text).alias("content_preview"),
        "start_line",
        "end_line",
        *(_TRUE_LINES if true_lines else ()),
        (fails(text) if fails else F.lit(False)).alias("fails"),
        embedding_id(text, pseudonym, F.col("start_line"), F.col("end_line")).alias("sent_id"),
        cached_id(text, pseudonym, F.col("chunk_index")).alias("cached_id"),
    )


def route(described: DataFrame) -> DataFrame:
    """Status, id and line label of each chunk, given ``needs_resync``."""
    cached = ~F.col("needs_resync")
    failed = F.col("fails")
    return described.select(
        F.col("path").alias("original_file_path"),
        F.col("pseudonym").alias("obfuscated_file_path"),
        "chunk_index",
        "content_preview",
        F.when(cached, F.col("cached_id"))
        .when(~failed, F.col("sent_id"))
        .alias("embedding_id"),
        F.when(~cached, line_label(F.col("start_line"), F.col("end_line"))).alias("lines"),
        F.when(cached, "cached").when(failed, "failed").otherwise("processed").alias("status"),
        "start_line",
        "end_line",
        *[c for c in _TRUE_LINES if c in described.columns],
        "chunk_hash",
        "root_hash",
    )


def index_chunks(
    files: DataFrame,
    known_roots: DataFrame | Iterable[str] = (),
    key: str = DEFAULT_KEY,
    mode: str = "line",
    pattern: str | None = None,
    fails: Callable[[Column], Column] | None = None,
    true_lines: bool = False,
) -> DataFrame:
    """Index ``(path, content)`` files against the roots already in sync.

    Chunks of a known root are ``cached``.  The others are ``processed``, or
    ``failed`` with a null id where ``fails``, if given, holds for the text.
    """
    described = describe_chunks(files, key, mode, pattern, fails, true_lines)
    return route(sync(described, known_roots))


def merge_indexes(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several index tables, repeated rows included."""
    merged = first
    for other in others:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def summary(index: DataFrame) -> DataFrame:
    """The listing of a run, with the path pseudonym cut to 20 characters."""
    return index.select(
        F.col("original_file_path").alias("file"),
        F.col("chunk_index").alias("chunk"),
        F.concat(F.substring("obfuscated_file_path", 1, 20), F.lit("...")).alias("obf_path"),
        F.col("embedding_id").alias("emb_id"),
        "status",
    )
