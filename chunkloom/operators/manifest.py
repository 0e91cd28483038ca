"""The manifest: which root each path had in which run.

Runs are a log, one folder each; a snapshot stands for the runs before it, so that
reading costs the snapshot and the few runs since, however many there were.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sources.staging import create_empty, discard, names

SCHEMA = "path string, root_hash string, n_chunks int, n_failed bigint"
_STORED = f"{SCHEMA}, stream string, run_id bigint"
_FIELDS = ("path", "root_hash", "n_chunks", "n_failed")


def latest(history: DataFrame) -> DataFrame:
    """The newest row of each path; an aggregate, so no path is sorted whole."""
    fields = [c for c in history.columns if c not in ("path", "run_id")]
    newest = F.max(F.struct("run_id", *fields)).alias("_newest")
    return history.groupBy("path").agg(newest).select("path", "_newest.*")


def update_manifest(manifest: DataFrame, run: DataFrame) -> DataFrame:
    """The manifest after a run: rows of ``run`` replace older ones by path.

    Both have ``path``, ``run_id`` and the same further columns.
    """
    return latest(manifest.unionByName(run, allowMissingColumns=True))


def file_states(index: DataFrame) -> DataFrame:
    """Manifest rows of an index table: root, chunks and failures per path.

    A chunk that the table holds several times counts once.  A path with two
    contents gives a row for each; ``latest`` then takes the greater root.
    """
    chunks = index.groupBy(
        F.col("original_file_path").alias("path"), "root_hash", "chunk_index"
    ).agg(F.max(F.col("status") == "failed").alias("failed"))
    return chunks.groupBy("path", "root_hash").agg(
        F.count(F.lit(1)).cast("int").alias("n_chunks"),
        F.count_if("failed").alias("n_failed"),
    )


def write_run(states: DataFrame, folder: str, run_id: int, stream: str = "batch") -> None:
    """Store one run of a stream; writing the same run again replaces it.

    A run that a snapshot holds already can no longer be replaced.
    """
    covered = _covered(states.sparkSession, folder, stream)
    if covered and run_id < covered[-1][0]:
        raise ValueError(f"run {run_id} of {stream} is part of a snapshot")
    target = f"{folder}/stream={stream}/run_id={run_id}"
    states.select(*_FIELDS).write.mode("overwrite").parquet(target)


def _numbered(spark: SparkSession, folder: str, prefix: str) -> list[tuple[int, str]]:
    """Entries ``<prefix><number>`` or ``<prefix><number>.<rest>`` of a folder, by number."""
    found = (e.removeprefix(prefix) for e in names(spark, folder) if e.startswith(prefix))
    parts = (e.partition(".") for e in found)
    return sorted((int(number), rest) for number, _, rest in parts if number.isdecimal())


def _covered(spark: SparkSession, folder: str, stream: str) -> list[tuple[int, str]]:
    """``(first run not covered, snapshot)`` of each published snapshot of a stream."""
    return _numbered(spark, f"{folder}/_current/{stream}", "upto=")


def _stream_rows(spark: SparkSession, folder: str, stream: str, before: int | None) -> DataFrame:
    """The newest snapshot that holds no run from ``before`` on, and the runs after it."""
    dropped = _numbered(spark, f"{folder}/_current/{stream}", "dropped=")
    if before is not None and dropped and before < dropped[-1][0]:
        raise ValueError(f"runs of {stream} before {dropped[-1][0]} are only kept as a snapshot")
    usable = [s for s in _covered(spark, folder, stream) if before is None or s[0] <= before]
    start, snapshot = usable[-1] if usable else (None, None)
    runs = [
        f"{folder}/stream={stream}/run_id={n}"
        for n, _ in _numbered(spark, f"{folder}/stream={stream}", "run_id=")
        if (start is None or n >= start) and (before is None or n < before)
    ]
    rows = spark.createDataFrame([], _STORED)
    if runs:
        rows = spark.read.schema(_STORED).option("basePath", folder).parquet(*runs)
    if snapshot:
        held = spark.read.schema(_STORED).parquet(f"{folder}/_snapshots/{stream}/{snapshot}")
        rows = held.unionByName(rows) if runs else held
    return rows


def read_runs(
    spark: SparkSession, folder: str, before: int | None = None, stream: str = "batch"
) -> DataFrame:
    """All stored runs; empty if there are none.

    With ``before`` only the runs of ``stream`` before that one, and those of all
    other streams.  Where a stream has a snapshot, its rows stand for the runs it covers.
    """
    found = {e.removeprefix("stream=") for e in names(spark, folder) if e.startswith("stream=")}
    rows = [
        _stream_rows(spark, folder, s, before if s == stream else None)
        for s in sorted(found | set(names(spark, f"{folder}/_current")))
    ]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], _STORED)


def compact(
    spark: SparkSession, folder: str, stream: str = "batch", before: int | None = None, at_least: int = 1
) -> bool:
    """Fold the runs of a stream, those before ``before`` if given, into a snapshot.

    The snapshot has one row for each distinct state of a path, with the newest run that
    saw it: ``latest`` and ``synced_roots`` give what they give over the runs.  It is
    written under a name of its own and then published by an empty file whose name holds
    that name and the first run not covered; creating it is the only step readers can see,
    and the highest one is current.  Nothing is done for fewer than ``at_least`` runs since
    the last snapshot.  Returns whether a snapshot was published.
    """
    covered = _covered(spark, folder, stream)
    start = covered[-1][0] if covered else None
    runs = [n for n, _ in _numbered(spark, f"{folder}/stream={stream}", "run_id=")]
    later = [n for n in runs if (start is None or n >= start) and (before is None or n < before)]
    if len(later) < max(at_least, 1):
        return False
    upto, name = later[-1] + 1, uuid.uuid4().hex
    rows = _stream_rows(spark, folder, stream, upto)
    newest = rows.groupBy(*_FIELDS).agg(F.max("run_id").alias("run_id"))
    snapshot = newest.withColumn("stream", F.lit(stream))
    snapshot.write.parquet(f"{folder}/_snapshots/{stream}/{name}")
    create_empty(spark, f"{folder}/_current/{stream}/upto={upto}.{name}")
    return True


def drop_covered(spark: SparkSession, folder: str, stream: str = "batch") -> None:
    """Remove the runs and snapshots that the current snapshot of a stream replaces.

    Queries that still read them fail, so call it when none runs.  Afterwards the stream
    cannot be read as it was before a removed run: asking for that is an error.
    """
    covered = _covered(spark, folder, stream)
    if not covered:
        return
    upto, current = covered[-1]
    create_empty(spark, f"{folder}/_current/{stream}/dropped={upto}")
    for number, name in covered[:-1]:
        discard(spark, f"{folder}/_current/{stream}/upto={number}.{name}")
    for name in names(spark, f"{folder}/_snapshots/{stream}"):
        if name in {s for _, s in covered} - {current}:
            discard(spark, f"{folder}/_snapshots/{stream}/{name}")
    for number, _ in _numbered(spark, f"{folder}/stream={stream}", "run_id="):
        if number < upto:
            discard(spark, f"{folder}/stream={stream}/run_id={number}")


def synced_roots(states: DataFrame) -> DataFrame:
    """Roots the other side holds in full: none of their chunks failed."""
    return states.filter(F.col("n_failed") == 0).select("root_hash").distinct()
