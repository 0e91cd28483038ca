"""Column-to-column functions."""

from chunkloom.functions.arrays import bind, running_totals
from chunkloom.functions.ids import cached_id, embedding_id, fail_when, line_label
from chunkloom.functions.merkle import leaf_hash, leaf_hashes, merkle_levels, merkle_root
from chunkloom.functions.paths import DEFAULT_KEY, deobfuscate_path, obfuscate_path
from chunkloom.functions.text import (
    PYTHON_DEFS,
    chunk_text,
    content_preview,
    has_text,
    is_boundary,
    line_count,
    newline_count,
    normalize_newlines,
    only_newlines,
    repo_label,
    split_lines,
)

__all__ = [
    "DEFAULT_KEY",
    "PYTHON_DEFS",
    "bind",
    "cached_id",
    "chunk_text",
    "content_preview",
    "deobfuscate_path",
    "embedding_id",
    "fail_when",
    "has_text",
    "is_boundary",
    "leaf_hash",
    "leaf_hashes",
    "line_count",
    "line_label",
    "merkle_levels",
    "merkle_root",
    "newline_count",
    "normalize_newlines",
    "obfuscate_path",
    "only_newlines",
    "repo_label",
    "running_totals",
    "split_lines",
]
