"""Lines that many documents repeat, found with levelled sorted runs of line hashes.

``LineRuns`` is an index of line hashes that grows batch by batch.  A run is a table
of distinct hashes with the number of documents and the largest document of each,
bucketed by hash and sorted within the bucket.  A batch of lines is shuffled once into
such buckets and merge-joined with the runs there are, which themselves neither shuffle
nor sort: hashes that no run holds (left anti) become the batch's own run, the others go
to a small table of recurrences.  So each hash stands in one run only.  When a level has
``FANOUT`` runs they are merged into one run of the next level and removed, so that a
batch meets a logarithmic number of runs and a hash is rewritten as many times.

Only hashes that recur within a batch or between batches can reach the least number of
documents.  Those that do are split by how many documents hold them: the most frequent
ones, fewer than ``FREQUENT`` whatever the corpus, are broadcast and looked up while the
texts are read; the others, of which none is hot, find their documents by a join on the
hash, and only documents that hold one shuffle.

Defined cases: a null text is an empty one, and an empty text is one empty line; lines
whose key is shorter than the least length always stay; a document that holds a line
several times counts once, and rows that share an id are one document; rows without id
count for nothing and keep all lines.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm.common import rows_among
from chunkloom.sources.staging import discard, fresh_path, stage

#: A key is looked at from this many code points on, and repeated from this many documents on.
LEAST_LENGTH, LEAST_DOCS = 40, 5
#: Batches that a table is taken in, and runs of a level that are merged into one.
BATCHES, FANOUT = 4, 2
#: Fewer repeated lines than this are broadcast, some 100 bytes each.
FREQUENT = 1 << 17

RESULT = "kept_text string, n_lines bigint, n_dropped bigint"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
_STRIPPED = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int) -> bytes | None:
    """16 bytes that stand for the key of a line, or None for a short key."""
    import xxhash

    key = line.strip(_STRIPPED).lower()  # bytes change A-Z only
    if len(key) < least or not (key.isascii() or len(key.decode()) >= least):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys(least: int):
    """``(id, key)`` for each distinct long key of a text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at, keys = [], []
            for i, text in enumerate(batch.column(1)):
                found = {line_key(line, least) for line in (text.as_py() or "").encode().split(b"\n")}
                found.discard(None)
                at.extend([i] * len(found))
                keys.extend(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(keys, pa.binary())],
                names=["id", "key"],
            )

    return run


def _without(least: int, frequent):
    """Texts without the lines of ``frequent`` (key: last document) and of ``gone`` (keys)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, lines, dropped = [], [], []
            ids, gone = (batch.column(c).to_pylist() for c in (0, 2))
            for i, text, some in zip(ids, batch.column(1), gone):
                own = set(some or ())
                split = (text.as_py() or "").encode().split(b"\n")
                kept = []
                for line in split:
                    key = line_key(line, least) if i is not None else None
                    if key is None or not (frequent.value.get(key, i) != i or key in own):
                        kept.append(line)
                texts.append(b"\n".join(kept).decode())
                lines.append(len(split))
                dropped.append(len(split) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in range(3, batch.num_columns)),
                    pa.array(texts, pa.string()),
                    pa.array(lines, pa.int64()),
                    pa.array(dropped, pa.int64()),
                ],
                names=[*batch.schema.names[3:], "kept_text", "n_lines", "n_dropped"],
            )

    return run


def _counted(lines: DataFrame) -> DataFrame:
    return lines.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


class LineRuns:
    """Levelled sorted runs of hashes: ``(key, docs, last)``, each key in one run only."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.recurring: list[DataFrame] = []
        self.paths: dict[str, str] = {}

    def _sorted(self, rows: DataFrame) -> str:
        """Store rows as a bucketed table, sorted by key within each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = fresh_path(self.spark, name)
        writer = rows.write.format("parquet").option("path", self.paths[name])
        writer.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        discard(self.spark, self.paths.pop(name))

    def _push(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) < self.fanout:
            return
        merged = self.spark.table(self.levels[level][0])
        for other in self.levels[level][1:]:
            more = self.spark.table(other).toDF("key", "docs_b", "last_b").hint("merge")
            merged = merged.join(more, "key", "full_outer").select(
                "key", *(F.coalesce(c, f"{c}_b").alias(c) for c in ("docs", "last"))
            )
        run = self._sorted(merged)
        for old in self.levels[level]:
            self._remove(old)
        self.levels[level] = []
        self._push(run, level + 1)

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    @contextmanager
    def _in_order(self):
        """Let joins use that the files of a run are sorted."""
        before = self.spark.conf.get(_ORDERED, "false")
        self.spark.conf.set(_ORDERED, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_ORDERED, before)

    def add(self, lines: DataFrame) -> None:
        """Take in ``(id, key)``, distinct lines of documents that no earlier batch held."""
        with self._in_order():
            self._add(lines)

    def _add(self, lines: DataFrame) -> None:
        counted = _counted(lines.select("key", F.lit(1).cast("bigint").alias("docs"), F.col("id").alias("last")))
        if not self.runs():
            self._push(self._sorted(counted), 0)
            return
        batch = self._sorted(counted)
        fresh = self.spark.table(batch)
        for name in self.runs():
            fresh = fresh.join(self.spark.table(name).select("key").hint("merge"), "key", "left_anti")
        run = self._sorted(fresh)
        again = self.spark.table(batch).join(self.spark.table(run).select("key").hint("merge"), "key", "left_anti")
        self.recurring.append(stage(again, "recurring-lines"))
        self._remove(batch)
        self._push(run, 0)

    def repeated(self, least: int = LEAST_DOCS) -> DataFrame:
        """``(key, docs, last)`` of keys that at least so many documents hold, stored."""
        found = None
        for name in self.runs():
            run = self.spark.table(name)
            found = run if found is None else found.unionByName(run)
        if found is None:
            return self.spark.createDataFrame([], "key binary, docs bigint, last bigint")
        if not self.recurring:
            return stage(found.filter(F.col("docs") >= least), "repeated-lines")
        more = self.recurring[0]
        for other in self.recurring[1:]:
            more = more.unionByName(other)
        more = stage(_counted(more), "recurring-lines")
        seen = found.join(more.select("key"), "key", "left_semi").unionByName(more)
        alone = found.filter(F.col("docs") >= least).join(more.select("key"), "key", "left_anti")
        total = _counted(seen).filter(F.col("docs") >= least)
        return stage(alone.unionByName(total), "repeated-lines")

    def close(self) -> None:
        """Remove all runs."""
        for name in self.runs():
            self._remove(name)
        self.levels = []


def distinct_lines(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """``(id, key)``: the long keys of each document, once for each row that holds them."""
    read = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")
    )
    return read.mapInArrow(_keys(least), "id bigint, key binary")


def _shared_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """Ids of several rows, stored."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("id")).filter("id IS NOT NULL")
    return stage(ids.groupBy("id").count().filter("count > 1").select("id"), "shared-ids")


def _once(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """Each line of a document once, also where several rows share its id."""
    if not shared.head(1):
        return lines
    some, alone = rows_among(lines, shared, "id")
    return some.distinct().unionByName(alone)


def dedup_lines(
    docs: DataFrame,
    keep: list[Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_docs: int = LEAST_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """The columns ``keep`` (default: the id) and ``kept_text, n_lines, n_dropped`` of each row.

    Lines whose key stands in at least ``least_docs`` documents stay in the one with
    the largest id only.  ``n_lines`` counts all lines, ``n_dropped`` those that go.
    """
    spark = docs.sparkSession
    number = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    lines = distinct_lines(docs, id_col, text_col, least_length)
    # Rows with the same id come to the same batch, where a line of theirs counts once.
    path = fresh_path(spark, "line-batches")
    lines.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("id bigint, key binary, batch int").parquet(path)
    shared = _shared_ids(docs, id_col)
    index = LineRuns(spark)
    for k in range(batches):
        some = lines.filter(F.col("batch") == k).select("id", "key")
        index.add(_once(some, shared))
    repeated = index.repeated(least_docs)

    # Fewer than FREQUENT keys can hold more than this share of all places.
    share = (repeated.agg(F.sum("docs")).first()[0] or 0) // FREQUENT
    hot = repeated.filter(F.col("docs") > share).select("key", "last").toArrow()
    frequent = spark.sparkContext.broadcast(dict(zip(*(hot.column(c).to_pylist() for c in (0, 1)))))
    rest = repeated.filter(F.col("docs") <= share)

    chosen = keep or [F.col(id_col)]
    names = [f"k{i}" for i in range(len(chosen))]
    read = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).alias("text"),
        *[c.alias(n) for c, n in zip(chosen, names)],
    )
    none = F.lit(None).cast("array<binary>").alias("gone")
    if share >= least_docs:
        pairs = lines.join(rest, "key").filter("id <> last")
        gone = stage(pairs.groupBy("id").agg(F.collect_set("key").alias("gone")), "gone-lines")
        ids = stage(gone.select("id").distinct(), "ids-of-gone-lines")
        some, clear = rows_among(read, ids, "id")
        listed = some.join(gone, "id", "left").select("id", "text", "gone", *names)
        listed = listed.unionByName(clear.select("id", "text", none, *names))
    else:
        listed = read.select("id", "text", none, *names)
        discard(spark, path)
    schema = ", ".join(f"{n} {read.schema[n].dataType.simpleString()}" for n in names)
    result = listed.mapInArrow(_without(least_length, frequent), f"{schema}, {RESULT}")
    index.close()
    return result.toDF(*docs.select(*chosen).columns, "kept_text", "n_lines", "n_dropped")
