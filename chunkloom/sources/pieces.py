"""A source tree read in pieces, for files too large for one row.

A file is cut into ranges of bytes, and each range gives the lines that begin in it,
so pieces end where lines end and no character or line break is cut.  Every piece is a
row that some task reads on its own; a file of any size is only more rows.  What does
not fit into one row is a single line, or a chunk, of 2 GiB.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import normalize_newlines
from chunkloom.sources.tree import BATCH_BYTES, BATCH_ROWS, BYTES_PER_TASK, LARGEST, LASTING, listed, open_file

_PIECE = "path string, piece bigint, content binary, error string"
PIECE_BYTES = 32 << 20
_STEP = 1 << 16


def line_start(file, at: int, size: int) -> int:
    """The first place from ``at`` on where a line begins, or the end of the file.

    Lines end with LF, CRLF or CR.
    """
    if at <= 0:
        return 0
    place, after_cr = at - 1, False
    file.seek(place)
    while place < size:
        block = file.read(min(_STEP, size - place))
        if not block:
            return size
        if after_cr:
            return place + 1 if block[:1] == b"\n" else place
        found = [i for i in (block.find(b"\n"), block.find(b"\r")) if i >= 0]
        if found:
            i = min(found)
            if block[i : i + 1] == b"\n":
                return place + i + 1
            if i + 1 < len(block):
                return place + i + (2 if block[i + 1 : i + 2] == b"\n" else 1)
            after_cr = True
        place += len(block)
    return size


def _piece_reader(piece_bytes: int):
    """A task function that reads one range of a file per input row."""

    def read(path: str, piece: int, size: int) -> tuple[bytes | None, str | None]:
        with open_file(path) as file:
            start = line_start(file, piece * piece_bytes, size)
            end = line_start(file, min((piece + 1) * piece_bytes, size), size)
            if end - start >= LARGEST:
                return None, "a line is larger than one value can be"
            if start >= end and piece:
                return None, None  # the range lies inside a line that began before it
            file.seek(start)
            content = file.read(end - start)
            return (content, None) if len(content) == end - start else (None, "changed while it was read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.binary(), pa.string()]

        def pack(rows):
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["path", "piece", "content", "error"])

        rows, held = [], 0
        for batch in batches:
            for path, piece, size in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    content, error = read(path, piece, size)
                except LASTING as e:
                    content, error = None, f"{type(e).__name__}: {e}"
                if content is None and error is None:
                    continue
                if rows and (held + len(content or b"") > BATCH_BYTES or len(rows) >= BATCH_ROWS):
                    yield pack(rows)
                    rows, held = [], 0
                rows.append((path, piece, content, error))
                held += len(content or b"")
        if rows:
            yield pack(rows)

    return run


def read_tree_pieces(
    spark: SparkSession,
    root: str,
    suffix: str = ".py",
    skip: str = ".git",
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``(path, piece, content BINARY, error)``: the files below ``root`` in pieces.

    Pieces of a file, in the order of ``piece``, join to its content; their numbers
    may have gaps, where a range holds no beginning of a line.  An empty file has one
    empty piece.  Files and folders that cannot be read have an ``error``.
    """
    found = listed(spark, root, suffix, skip)
    files = found.filter("error IS NULL")
    last = F.greatest(F.ceil(F.col("length") / piece_bytes) - 1, F.lit(0)).cast("bigint")
    number = F.sequence(F.lit(0).cast("bigint"), last)
    ranges = files.select("path", F.explode(number).alias("piece"), "length")
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, total // BYTES_PER_TASK)
    read = ranges.repartition(int(tasks)).mapInArrow(_piece_reader(piece_bytes), _PIECE)
    failed = found.filter("error IS NOT NULL").selectExpr("path", "0L", "CAST(NULL AS BINARY)", "error")
    return read.union(failed)


def _errors(raw: DataFrame) -> DataFrame:
    """``(path, error, piece)`` of the bad pieces."""
    text = F.col("content").cast("string")
    reason = F.coalesce("error", F.when(~F.is_valid_utf8(text), F.lit("not valid UTF-8")))
    return raw.select("path", reason.alias("error"), "piece").filter("error IS NOT NULL")


def rejected_pieces(raw: DataFrame) -> DataFrame:
    """``(path, error)``, one row per file that :func:`decode_pieces` leaves out."""
    first = F.min(F.struct("piece", "error"))["error"]
    return _errors(raw).groupBy("path").agg(first.alias("error"))


def decode_pieces(raw: DataFrame) -> DataFrame:
    """``(path, piece, content)`` of the readable UTF-8 files, with LF line ends.

    A file with one bad piece is left out as a whole.
    """
    bad = _errors(raw).select("path").distinct()
    text = normalize_newlines(F.col("content").cast("string"))
    return raw.join(bad, "path", "left_anti").select("path", "piece", text.alias("content"))
