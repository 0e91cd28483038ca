"""Deterministic chunk ids and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that makes the simulated service fail.
FAILURE_TEXT = "erro"


def fail_when(text: Column, marker: str = FAILURE_TEXT) -> Column:
    """Failure predicate of the simulated service: the text contains the marker in any case."""
    return F.contains(F.lower(text), F.lit(marker))


def _short_hash(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 16)


def embedding_id(text: Column, pseudonym: Column, start: Column, end: Column) -> Column:
    """Id of a sent chunk, from its text, path pseudonym and reported lines."""
    return _short_hash(text, pseudonym, start.cast("string"), end.cast("string"))


def cached_id(text: Column, pseudonym: Column, index: Column) -> Column:
    """Id of a chunk already in sync, from its text, path pseudonym and index."""
    return _short_hash(text, pseudonym, index.cast("string"))


def line_label(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start, end)
