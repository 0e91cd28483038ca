"""A source tree as a DataFrame of files.

Spark's own file sources skip names that begin with ``_`` or ``.``, so
``__init__.py`` would be lost; the tree is listed and read here by small
functions that run inside tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import normalize_newlines
from chunkloom.sources.staging import fresh_path

_LISTING = "path string, is_dir boolean, length bigint, error string"
_CONTENT = "path string, content binary, error string"
BYTES_PER_TASK = 64 << 20
LARGEST = 2**31 - 1
#: Content that one Arrow batch holds, unless a single file has more.  A task holds it a few
#: times over: as values, as a column and as the message to Spark.
BATCH_BYTES = 1 << 20
#: Rows that one Arrow batch holds, whatever they hold.
BATCH_ROWS = 10_000
# The kinds of URI that the readers inside the tasks can open.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")
# Errors that another try would meet again.
LASTING = (FileNotFoundError, PermissionError, NotADirectoryError, IsADirectoryError)


def check_root(root: str) -> None:
    """Refuse roots of other kinds before any task runs.

    Tasks open files through Arrow, which has its own names (``s3``, not ``s3a``) and takes
    credentials from the environment of the executors, not from the session.
    """
    scheme, found, _ = root.partition("://")
    if found and scheme.lower() not in SCHEMES:
        raise ValueError(f"{scheme}:// cannot be read; use a path or one of {', '.join(SCHEMES)}")


def _lister(suffix: str, skip: str):
    """A task function that lists one directory per input row."""

    def is_kind(test) -> bool:
        try:
            return test()
        except OSError:
            # A link that leads back to itself is neither.
            return False

    def size_of(entry) -> int:
        try:
            return entry.stat().st_size
        except OSError:
            # A dangling link or a file just removed: reading it will tell.
            return 0

    def entries(folder: str):
        import os

        import pyarrow.fs as pafs

        if "://" not in folder:
            with os.scandir(folder) as found:
                for e in found:
                    if is_kind(e.is_dir):
                        # Links to directories are not followed: they may loop.
                        if not e.is_symlink():
                            yield e.name, True, 0
                    elif e.name.endswith(suffix) and (is_kind(e.is_file) or e.is_symlink()):
                        yield e.name, False, size_of(e)
        else:
            store, inner = pafs.FileSystem.from_uri(folder)
            for info in store.get_file_info(pafs.FileSelector(inner)):
                is_dir = info.type == pafs.FileType.Directory
                if is_dir or info.base_name.endswith(suffix):
                    yield info.base_name, is_dir, info.size or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import pyarrow as pa

        names = ["path", "is_dir", "length", "error"]

        def pack(rows):
            paths, dirs, sizes, errors = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(paths),
                    pa.array(dirs),
                    pa.array(sizes, pa.int64()),
                    pa.array(errors, pa.string()),
                ],
                names,
            )

        rows = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                try:
                    for name, is_dir, size in entries(folder):
                        if not is_dir or name != skip:
                            rows.append((os.path.join(folder, name), is_dir, size, None))
                        if len(rows) >= BATCH_ROWS:
                            yield pack(rows)
                            rows = []
                except LASTING as e:
                    # Other errors may pass: the task fails and Spark tries it again.
                    rows.append((folder, False, 0, f"{type(e).__name__}: {e}"))
        if rows:
            yield pack(rows)

    return run


def open_file(path: str):
    """The file of a listed path, open for reading and seeking."""
    import pyarrow.fs as pafs

    if "://" not in path:
        return open(path, "rb")
    store, inner = pafs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _reader():
    """A task function that reads one file per input row."""

    def read(path: str) -> bytes:
        with open_file(path) as f:
            return f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        names = ["path", "content", "error"]

        def pack(rows):
            paths, contents, errors = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array(contents, pa.binary()),
                    pa.array(errors, pa.string()),
                ],
                names,
            )

        rows, held = [], 0
        for batch in batches:
            for path, length, error in zip(*(c.to_pylist() for c in batch.columns)):
                content = None
                if error is None and length >= LARGEST:
                    error = "larger than one value can be: read it in pieces"  # known before
                if rows and (held + length > BATCH_BYTES or len(rows) >= BATCH_ROWS):
                    yield pack(rows)
                    rows, held = [], 0
                if error is None:
                    try:
                        content = read(path)
                    except LASTING as e:
                        error = f"{type(e).__name__}: {e}"
                rows.append((path, content, error))
                held += len(content or b"")
        if rows:
            yield pack(rows)

    return run


def listed(spark: SparkSession, root: str, suffix: str, skip: str) -> DataFrame:
    """``(path, length, error)`` of files, and of folders that cannot be listed.

    Goes down one level of directories per job, each directory being a row, so
    that a lopsided tree is still listed by all executors and never by the
    driver.
    """
    check_root(root)
    root = root.rstrip("/") or "/"
    if skip in root.split("/"):
        return spark.createDataFrame([], "path string, length bigint, error string")
    base = fresh_path(spark, "listing")
    slots = spark.sparkContext.defaultParallelism
    # A row that Spark makes itself: one sent from here would start a second set of Python workers.
    frontier = spark.range(1).select(F.lit(root).alias("path"))
    level = 0
    while not frontier.isEmpty():
        folder = f"{base}/level={level}"
        listed = frontier.repartition(slots).mapInArrow(_lister(suffix, skip), _LISTING)
        listed.write.parquet(folder)
        level_rows = spark.read.schema(_LISTING).parquet(folder)
        if level == 0 and (failed := level_rows.filter("error IS NOT NULL").first()):
            raise FileNotFoundError(f"{root} cannot be listed: {failed['error']}")
        frontier = level_rows.filter("is_dir").select("path")
        level += 1
    found = spark.read.schema(_LISTING).parquet(base)
    return found.filter(~F.col("is_dir")).select("path", "length", "error")


def list_source_tree(
    spark: SparkSession, root: str, suffix: str = ".py", skip: str = ".git"
) -> DataFrame:
    """``(path, length)`` of all files below ``root`` whose name ends in ``suffix``.

    Directories named ``skip`` are not entered, and nothing is listed when
    ``root`` itself lies in one.  A root that cannot be listed is an error.
    """
    return listed(spark, root, suffix, skip).filter("error IS NULL").select("path", "length")


def read_source_tree(
    spark: SparkSession, root: str, suffix: str = ".py", skip: str = ".git"
) -> DataFrame:
    """``(path, content BINARY, error)`` of the files below ``root``.

    The listing is spread evenly over enough tasks for its total size, and the
    executors read the files.  A file that cannot be read has an ``error``, and
    so has a folder that cannot be listed.
    """
    files = listed(spark, root, suffix, skip)
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, total // BYTES_PER_TASK)
    return files.repartition(int(tasks)).mapInArrow(_reader(), _CONTENT)


def decode_files(raw: DataFrame) -> DataFrame:
    """``(path, content)`` of the readable UTF-8 files, with LF line ends."""
    text = F.col("content").cast("string")
    return raw.filter(F.col("error").isNull() & F.is_valid_utf8(text)).select(
        "path", normalize_newlines(text).alias("content")
    )


def rejected_files(raw: DataFrame) -> DataFrame:
    """``(path, error)`` of the files that :func:`decode_files` leaves out."""
    text = F.col("content").cast("string")
    reason = F.coalesce("error", F.when(~F.is_valid_utf8(text), F.lit("not valid UTF-8")))
    return raw.select("path", reason.alias("error")).filter(F.col("error").isNotNull())
