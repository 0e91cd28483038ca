"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions import (
    cached_id,
    content_preview,
    deobfuscate_path,
    embedding_id,
    fail_when,
    line_label,
    obfuscate_path,
    repo_label,
)
from chunkloom.operators import (
    chunk,
    chunk_counts,
    chunk_pieces,
    compact,
    corpus_nodes,
    corpus_root,
    diff_chunks,
    diff_files,
    diff_trees,
    drop_covered,
    explode_chunks,
    file_roots,
    file_states,
    fingerprint,
    group_roots,
    latest,
    line_spans,
    lines,
    matching_files,
    merkle_nodes,
    nonblank,
    pending_chunks,
    read_runs,
    reuse_embeddings,
    store_cache,
    store_corpus,
    store_trees,
    stored_root,
    sync,
    synced_roots,
    update_corpus,
    update_manifest,
    with_chunks_only,
    with_root,
    write_run,
)
from chunkloom.plans import index_chunks, merge_indexes, summary
from chunkloom.sources import (
    decode_files,
    decode_pieces,
    read_index,
    read_source_tree,
    read_spread,
    read_tree_pieces,
    rejected_files,
    write_index,
)
from chunkloom.sources.staging import fresh_path, stage
from chunkloom.sources.tree import BATCH_BYTES
from chunkloom.streaming import read_file_stream, read_stream_index, stream_index
from workload import inputs

_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def matched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching_files(inputs.mixed_paths(spark, sf_dir))


def nonblank_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nonblank(inputs.files(spark, sf_dir))


def boundary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(nonblank(inputs.files(spark, sf_dir)))


def chunks_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(chunk(inputs.files(spark, sf_dir)))


def chunks_custom_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(chunk(inputs.files(spark, sf_dir), pattern=r"class\s"))


def chunks_top_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(chunk(inputs.files(spark, sf_dir), mode="top_level"))


def nested_top_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indented definitions open no chunk, and decorators and comments stay with theirs."""
    return explode_chunks(chunk(inputs.nested_files(spark, sf_dir), mode="top_level"))


def nested_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_chunks(chunk(inputs.nested_files(spark, sf_dir)))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_counts(chunk(inputs.files(spark, sf_dir)))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spanned = line_spans(chunk(inputs.files(spark, sf_dir)))
    return explode_chunks(spanned, "spans").drop("chunk")


def leaf_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = fingerprint(chunk(inputs.files(spark, sf_dir)))
    return explode_chunks(hashed, "chunk_hashes").drop("chunk", "root_hash")


def merkle_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_roots(inputs.fingerprints(inputs.files(spark, sf_dir)))


def tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_nodes(inputs.fingerprints(inputs.files(spark, sf_dir)))


def conversation_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return group_roots(turns, ["conv_id"], ["turn"], "text")


def root_of_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_root(inputs.documents(spark, sf_dir), ["doc_id"], "text")


def nodes_of_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of one tree over all documents, in blocks of 64."""
    return corpus_nodes(inputs.documents(spark, sf_dir), ["doc_id"], "text", bits=6)


def updated_corpus_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root of an earlier corpus, and the one after texts were changed and appended."""
    docs = inputs.documents(spark, sf_dir).select("doc_id", "text")
    old = inputs.old_corpus(docs)
    # Rows as they are now of texts that changed or were not there yet.
    same = old.withColumnsRenamed({"doc_id": "_id", "text": "_text"})
    delta = docs.join(same, (F.col("doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text")), "left_anti")
    folder = fresh_path(spark, "corpus")
    store_corpus(old, folder, "doc_id", "text", bits=6)
    before = stage(stored_root(spark, folder).withColumn("state", F.lit("old")), "root")
    update_corpus(delta, folder, "doc_id", "text")
    return before.unionByName(stored_root(spark, folder).withColumn("state", F.lit("new")))


def obfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.paths(spark, sf_dir).withColumn("pseudonym", obfuscate_path(F.col("path")))


def deobfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = obfuscated(spark, sf_dir).select("pseudonym")
    return hidden.withColumn("path", deobfuscate_path(F.col("pseudonym")))


def _with_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = chunk(inputs.files(spark, sf_dir))
    return chunked.withColumn("pseudonym", obfuscate_path(F.col("path")))


def embedding_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_chunks(line_spans(_with_pseudonyms(spark, sf_dir), true=False), "spans")
    text, start, end = F.col("chunk"), F.col("start_line"), F.col("end_line")
    sent = F.when(~fail_when(text), embedding_id(text, F.col("pseudonym"), start, end))
    return rows.select(
        "path", "chunk_index", sent.alias("embedding_id"), line_label(start, end).alias("lines")
    )


def cached_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_chunks(_with_pseudonyms(spark, sf_dir))
    cached = cached_id(F.col("chunk"), F.col("pseudonym"), F.col("chunk_index"))
    return rows.select("path", "chunk_index", cached.alias("cached_id"))


def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks_line(spark, sf_dir).select(
        "path", "chunk_index", content_preview(F.col("chunk")).alias("content_preview")
    )


def repo_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", repo_label(F.col("url")).alias("label"))


def sync_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = inputs.fingerprints(inputs.files(spark, sf_dir)).select("path", "root_hash")
    return sync(roots, inputs.known_roots(spark, sf_dir))


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.known_roots(spark, sf_dir)
    return index_chunks(inputs.files(spark, sf_dir), known, fails=fail_when)


def index_true_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.known_roots(spark, sf_dir)
    return index_chunks(inputs.files(spark, sf_dir), known, fails=fail_when, true_lines=True)


def stored_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index written twice under one run, as after a failed try."""
    folder = fresh_path(spark, "index")
    for _ in range(2):
        write_index(index(spark, sf_dir), folder, run_id=1)
    return read_index(spark, folder).groupBy("status").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.count("embedding_id").alias("n_ids"),
        F.countDistinct("original_file_path").alias("n_files"),
    )


def merged_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = index(spark, sf_dir)
    return merge_indexes(run, run).select(
        "original_file_path", "chunk_index", "embedding_id", "status"
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(index(spark, sf_dir))


def file_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = inputs.fingerprints(inputs.old_snapshot(spark, sf_dir))
    new = inputs.fingerprints(inputs.new_snapshot(spark, sf_dir))
    return diff_files(file_roots(old), file_roots(new))


def chunk_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = inputs.fingerprints(inputs.old_snapshot(spark, sf_dir))
    new = inputs.fingerprints(inputs.new_snapshot(spark, sf_dir))
    return diff_chunks(old, new)


def tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of chunks that differ, found from the stored trees of both snapshots."""
    snapshots = (inputs.old_snapshot(spark, sf_dir), inputs.new_snapshot(spark, sf_dir))
    return diff_trees(spark, *(store_trees(inputs.fingerprints(s)) for s in snapshots))


def _chunks_and_cache(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All chunks, and a cache that holds those of every third document."""

    def hashed(files: DataFrame) -> DataFrame:
        named = fingerprint(chunk(files)).withColumn("pseudonym", obfuscate_path(F.col("path")))
        return explode_chunks(named, "chunk_hashes")

    third = inputs.code_files(spark, sf_dir).filter("doc_id % 3 = 0").drop("doc_id")
    cached = cached_id(F.col("chunk"), F.col("pseudonym"), F.col("chunk_index"))
    cache = hashed(third).select("chunk_hash", cached.alias("embedding"))
    return hashed(inputs.files(spark, sf_dir)).drop("pseudonym", "root_hash"), cache


def reused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse_embeddings(*_chunks_and_cache(spark, sf_dir))


def reused_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reuse, from a cache that is stored by hash."""
    chunks, cache = _chunks_and_cache(spark, sf_dir)
    return reuse_embeddings(chunks, store_cache(cache, f"chunkloom_cache_{uuid.uuid4().hex}"))


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_chunks(*_chunks_and_cache(spark, sf_dir)).select("chunk_hash", "n_copies")


def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(files: DataFrame, run_id: int) -> DataFrame:
        roots = file_roots(inputs.fingerprints(files))
        return roots.withColumn("run_id", F.lit(run_id).cast("bigint"))

    first = run(inputs.old_snapshot(spark, sf_dir), 1)
    return update_manifest(first, run(inputs.new_snapshot(spark, sf_dir), 2))


def _writer(root: str):
    """A task function that writes each row of ``(path, content BINARY)`` as a file below ``root``."""

    def write(rows: Iterator) -> None:
        import os

        if "://" in root:
            import pyarrow.fs as pafs

            store, base = pafs.FileSystem.from_uri(root)
            make_dir, create = store.create_dir, store.open_output_stream
        else:
            base, make_dir, create = root, partial(os.makedirs, exist_ok=True), partial(open, mode="wb")
        for row in rows:
            target = os.path.join(base, row["path"])
            make_dir(os.path.dirname(target))
            with create(target) as f:
                f.write(row["content"])

    return write


def _write_tree(files: DataFrame, root: str) -> None:
    """Write each row of ``(path, content BINARY)`` as a file below ``root``.

    Rows reach the tasks in Arrow batches that end at 1 MB of content.  Batches of pickled rows
    are sized by the rows before them: they outgrow this where longer texts follow short ones.
    """
    write_rows, conf = _writer(root), files.sparkSession.conf

    def write(batches: Iterator) -> Iterator:
        columns = (zip(batch.column("path"), batch.column("content")) for batch in batches)
        write_rows({"path": p.as_py(), "content": c.as_buffer()} for rows in columns for p, c in rows)
        return iter(())

    before = conf.get(_BATCH_CONF, None)
    conf.set(_BATCH_CONF, BATCH_BYTES)
    try:
        files.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    finally:
        if before is None:
            conf.unset(_BATCH_CONF)
        else:
            conf.set(_BATCH_CONF, before)


def _below(root: str, rows: DataFrame) -> DataFrame:
    return rows.withColumn("path", F.substring("path", len(root) + 2, 1 << 30))


def source_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of a tree, found, read and decoded again."""
    root = fresh_path(spark, "tree").removeprefix("file:")
    files = inputs.files(spark, sf_dir).select("path", F.col("content").cast("binary").alias("content"))
    _write_tree(files, root)
    return _below(root, decode_files(read_source_tree(spark, root)))


def pieced_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of every document as a file of a tree that is read in pieces of two kilobytes."""
    root = fresh_path(spark, "tree").removeprefix("file:")
    files = inputs.files(spark, sf_dir).select("path", F.col("content").cast("binary").alias("content"))
    _write_tree(files, root)
    return _below(root, chunk_pieces(decode_pieces(read_tree_pieces(spark, root, piece_bytes=2048))))


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file, some behind two bytes that are not UTF-8."""
    root = fresh_path(spark, "tree").removeprefix("file:")
    bad = F.when(F.col("doc_id") % 7 == 3, F.unhex(F.lit("FFFE"))).otherwise(F.unhex(F.lit("")))
    files = inputs.documents(spark, sf_dir).select(
        F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".py")).alias("path"),
        F.concat(bad, F.col("text").cast("binary")).alias("content"),
    )
    _write_tree(files, root)
    return _below(root, rejected_files(read_source_tree(spark, root)))


def streamed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches from a drop folder: an earlier state, the new one, and that again."""
    drop, out, checkpoint = (fresh_path(spark, n) for n in ("drop", "stream", "progress"))
    states = (inputs.old_snapshot, inputs.new_snapshot, inputs.new_snapshot)
    for state in states:
        state(spark, sf_dir).select("path", "content").write.mode("append").parquet(drop)
        files = read_file_stream(spark, drop)
        stream_index(files, out, checkpoint, fails=fail_when, compact_every=1).awaitTermination()
    return read_stream_index(spark, out).select(
        F.col("batch_id").cast("int").alias("batch_id"),
        *("original_file_path", "chunk_index", "embedding_id", "lines", "status", "root_hash"),
    )


def _second_index(spark: SparkSession, sf_dir: str, manifest: str) -> DataFrame:
    """The new state indexed against the stored run of the earlier one; both runs are stored."""

    def run(files: DataFrame, run_id: int) -> DataFrame:
        known = synced_roots(read_runs(spark, manifest, before=run_id))
        rows = stage(index_chunks(files, known, fails=fail_when), "run")
        write_run(file_states(rows), manifest, run_id)
        return rows

    run(inputs.old_snapshot(spark, sf_dir), 1)
    return run(inputs.new_snapshot(spark, sf_dir), 2)


def stored_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two runs that know each other by the stored manifest alone."""
    rows = _second_index(spark, sf_dir, fresh_path(spark, "manifest"))
    return rows.select("original_file_path", "chunk_index", "embedding_id", "lines", "status")


def compacted_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest state of each path from a snapshot, the runs behind it removed."""
    manifest = fresh_path(spark, "manifest")
    _second_index(spark, sf_dir, manifest)
    compact(spark, manifest)
    drop_covered(spark, manifest)
    return latest(read_runs(spark, manifest)).drop("stream")


def _class_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with only those of their chunks that define a class; many have none."""
    with_class = F.filter("chunks", lambda c: F.contains(c, F.lit("class ")))
    return chunk(inputs.files(spark, sf_dir)).withColumn("chunks", with_class)


def files_with_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_counts(with_chunks_only(_class_chunks(spark, sf_dir)))


def files_with_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_roots(with_root(fingerprint(_class_chunks(spark, sf_dir))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "matching_files": matched_files,
        "nonblank_files": nonblank_files,
        "boundary_lines": boundary_lines,
        "chunks_line": chunks_line,
        "chunks_custom_pattern": chunks_custom_pattern,
        "chunks_top_level": chunks_top_level,
        "chunks_nested_top_level": nested_top_level,
        "chunks_nested_line": nested_line,
        "chunk_counts": counts,
        "line_spans": spans,
        "leaf_hashes": leaf_hashes,
        "merkle_roots": merkle_roots,
        "merkle_nodes": tree_nodes,
        "conversation_roots": conversation_roots,
        "corpus_root": root_of_corpus,
        "corpus_nodes": nodes_of_corpus,
        "updated_corpus_root": updated_corpus_root,
        "obfuscated": obfuscated,
        "deobfuscated": deobfuscated,
        "embedding_ids": embedding_ids,
        "cached_ids": cached_ids,
        "previews": previews,
        "repo_labels": repo_labels,
        "sync_status": sync_status,
        "index_chunks": index,
        "index_true_lines": index_true_lines,
        "stored_index": stored_index,
        "merged_indexes": merged_indexes,
        "summary": run_summary,
        "file_diff": file_diff,
        "chunk_diff": chunk_diff,
        "tree_diff": tree_diff,
        "reuse_embeddings": reused,
        "stored_cache": reused_from_table,
        "pending_chunks": pending,
        "manifest_latest": manifest_latest,
        "source_tree": source_tree,
        "pieced_chunks": pieced_chunks,
        "rejected_files": rejected,
        "stream_index": streamed_index,
        "stored_manifest": stored_manifest,
        "compacted_manifest": compacted_manifest,
        "files_with_chunks": files_with_chunks,
        "files_with_root": files_with_root,
    }
