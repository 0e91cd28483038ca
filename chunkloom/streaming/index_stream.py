"""The index as a stream of arriving files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chunkloom.functions.paths import DEFAULT_KEY
from chunkloom.operators.manifest import (
    compact,
    file_states,
    read_runs,
    synced_roots,
    write_run,
)
from chunkloom.operators.sync import sync
from chunkloom.plans.index import describe_chunks, route

FILES_SCHEMA = "path string, content string"


def read_file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of ``(path, content)`` as they arrive in a folder."""
    reader = spark.readStream.schema(FILES_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream that a checkpoint belongs to: an id kept in a folder inside it."""
    folder = f"{checkpoint.rstrip('/')}/stream-id"
    try:
        stored = spark.read.schema("id string").json(folder).first()
    except AnalysisException:
        stored = None
    if stored:
        return stored["id"]
    # None yet, or a folder that a crash left empty: no batch can have run.
    found = uuid.uuid4().hex
    rows = spark.createDataFrame([(found,)], "id string").coalesce(1)
    rows.write.mode("overwrite").json(folder)
    return found


def stream_index(
    files: DataFrame,
    out: str,
    checkpoint: str,
    key: str = DEFAULT_KEY,
    mode: str = "line",
    pattern: str | None = None,
    fails: Callable[[Column], Column] | None = None,
    trigger: dict | None = None,
    compact_every: int = 16,
) -> StreamingQuery:
    """Index a stream of files into ``out/chunks`` and ``out/manifest``.

    Chunking and hashing are row-local and run as part of the stream; only the
    sync with the manifest happens per batch.  A batch sees the runs before it
    and writes to folders that carry its id and that of its stream, which the
    checkpoint keeps: a batch that runs again after a failure replaces its own
    output, and a stream with another checkpoint never that of an earlier one.
    After ``compact_every`` runs a batch first folds those before it into a snapshot of
    the manifest, so it reads the snapshot and fewer runs than that.
    ``trigger`` has the arguments of ``DataStreamWriter.trigger``; by default
    what there is gets indexed and the stream ends.
    """
    described = describe_chunks(files, key, mode, pattern, fails)
    stream = _stream_id(files.sparkSession, checkpoint)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        manifest = f"{out}/manifest"
        compact(spark, manifest, stream, before=batch_id, at_least=compact_every)
        runs = read_runs(spark, manifest, before=batch_id, stream=stream)
        synced = sync(batch, synced_roots(runs))
        target = f"{out}/chunks/stream={stream}/batch_id={batch_id}"
        route(synced).write.mode("overwrite").parquet(target)
        written = spark.read.parquet(target)
        write_run(file_states(written), manifest, batch_id, stream)

    return (
        described.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_stream_index(spark: SparkSession, out: str) -> DataFrame:
    """All chunks written so far, with the batch that wrote them."""
    return spark.read.parquet(f"{out}/chunks")
