"""DataFrame-to-DataFrame operators."""

from chunkloom.operators.chunking import (
    chunk,
    chunk_counts,
    explode_chunks,
    line_spans,
    lines,
    matching_files,
    nonblank,
    with_chunks_only,
)
from chunkloom.operators.corpus import (
    corpus_nodes,
    corpus_root,
    group_roots,
    number_rows,
    reduce_blocks,
    tree_nodes,
)
from chunkloom.operators.corpus_store import store_corpus, stored_root, update_corpus
from chunkloom.operators.diff import diff_chunks, diff_files, diff_trees, store_trees
from chunkloom.operators.fingerprint import file_roots, fingerprint, merkle_nodes, with_root
from chunkloom.operators.manifest import (
    compact,
    drop_covered,
    file_states,
    latest,
    read_runs,
    synced_roots,
    update_manifest,
    write_run,
)
from chunkloom.operators.pieces import chunk_pieces
from chunkloom.operators.reuse import (
    distinct_chunks,
    pending_chunks,
    reuse_embeddings,
    store_cache,
)
from chunkloom.operators.sync import sync

__all__ = [
    "chunk",
    "chunk_counts",
    "chunk_pieces",
    "compact",
    "corpus_nodes",
    "corpus_root",
    "diff_chunks",
    "diff_files",
    "diff_trees",
    "distinct_chunks",
    "drop_covered",
    "explode_chunks",
    "file_roots",
    "file_states",
    "fingerprint",
    "group_roots",
    "latest",
    "line_spans",
    "lines",
    "matching_files",
    "merkle_nodes",
    "nonblank",
    "number_rows",
    "pending_chunks",
    "read_runs",
    "reduce_blocks",
    "reuse_embeddings",
    "store_cache",
    "store_corpus",
    "store_trees",
    "stored_root",
    "sync",
    "synced_roots",
    "tree_nodes",
    "update_corpus",
    "update_manifest",
    "with_chunks_only",
    "with_root",
    "write_run",
]
