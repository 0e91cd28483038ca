"""Where files come from and where the index goes."""

from chunkloom.sources.pieces import decode_pieces, read_tree_pieces, rejected_pieces
from chunkloom.sources.tables import from_table, read_index, read_spread, write_index
from chunkloom.sources.tree import (
    decode_files,
    list_source_tree,
    read_source_tree,
    rejected_files,
)

__all__ = [
    "decode_files",
    "decode_pieces",
    "from_table",
    "list_source_tree",
    "read_index",
    "read_source_tree",
    "read_spread",
    "read_tree_pieces",
    "rejected_files",
    "rejected_pieces",
    "write_index",
]
