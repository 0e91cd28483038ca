"""Hard negatives of anchor vectors, with exact integer scores from float32 products.

Scores are inner products of integer components.  They are computed in a residue
number system: for each of several small primes the matrices of balanced residues are
multiplied in float32, where every partial sum stays below 2**24 and so is exact, and
the signed score is put together by the Chinese remainder theorem.  The primes follow
from the largest squared norm, which bounds every score.

Anchors are a stated query set.  They are taken in batches of bounded size, each of
them broadcast, and every task multiplies its rows with a batch, block by block, and
keeps only the best few rows of each anchor so far.  A window over what the tasks kept
selects the best of all.  A first pass finds the positives; a second one, which then
knows their scores, finds the negatives within a share of each.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part.  Shorter vectors count as filled up with zeros, so an empty
one has scores of 0.  Of anchors that share an id the one with the least label and
vector counts; rows with the id of an anchor are never its partners; other repeated
rows each count, ties between them by label.  Squared norms of 2**62 and more, whose
scores fit no long, are an error.  Without anchors or rows the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.sources.staging import fresh_path, stage

#: Partners that are kept of each kind.
POSITIVES, NEGATIVES = 5, 5
#: Negatives score between these hundredths of the positive.
LOW, HIGH = 80, 100
#: Bytes of the anchors of a batch, which is broadcast.
BATCH_BYTES = 16 << 20
#: Rows of a block, anchors of a block, and components summed before a reduction.
ROWS, ANCHORS, INNER = 4096, 512, 1024
_EXACT = 1 << 24


def primes(components: int, norm: int) -> list[int]:
    """The largest primes whose residues stay exact, enough of them for the scores.

    Scores lie between ``-norm`` and ``norm``; their last digit then tells the sign.
    """
    half = math.isqrt((_EXACT - 1) // min(max(components, 1), INNER))
    found: list[int] = []
    n = 2 * half + 1
    while len(found) < 2 or math.prod(found[:-1]) * (found[-1] // 2) <= norm:
        if all(n % k for k in range(2, math.isqrt(n) + 1)):
            found.append(n)
        n -= 1
    return found


def balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues between ``-prime // 2`` and ``prime // 2`` as float32."""
    return ((values + prime // 2) % prime - prime // 2).astype(np.float32)


def residue_product(one: np.ndarray, two: np.ndarray, prime: int) -> np.ndarray:
    """``one @ two.T`` modulo the prime, as int64 from 0 on."""
    total = np.zeros((len(one), len(two)), np.int64)
    for k in range(0, one.shape[1], INNER):
        total += (one[:, k : k + INNER] @ two[:, k : k + INNER].T).astype(np.int64)
    return total % prime


def reconstruct(residues: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """The signed numbers with these residues, by mixed radix digits.

    The last digit is balanced, so no step leaves 64 bits if the numbers themselves fit.
    """
    digits: list[np.ndarray] = []
    for i, prime in enumerate(moduli):
        digit = residues[i]
        for j in range(i):
            digit = (digit - digits[j]) * pow(moduli[j], -1, prime) % prime
        digits.append(digit)
    digits[-1] = np.where(digits[-1] > moduli[-1] // 2, digits[-1] - moduli[-1], digits[-1])
    value = digits[-1]
    for digit, prime in zip(digits[-2::-1], moduli[-2::-1]):
        value = value * prime + digit
    return value


class Scores:
    """Exact scores of blocks of rows with fixed anchors."""

    def __init__(self, anchors: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.anchors = [balanced(anchors, p) for p in moduli]

    def __call__(self, rows: np.ndarray, some: np.ndarray) -> np.ndarray:
        """A row of scores for each row; ``some`` are places of anchors."""
        found = [
            residue_product(balanced(rows, p), of[some], p)
            for p, of in zip(self.moduli, self.anchors)
        ]
        return reconstruct(found, self.moduli)


class Best:
    """The first few ``(score, id, label)`` of each group: high scores, then small ids."""

    def __init__(self, groups: int, size: int):
        self.size = size
        self.held = tuple(np.empty(0, np.int64) for _ in range(4))
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        near = score >= self.least[group]
        if not near.any():
            return
        new = (group[near], score[near], ids[near], label[near])
        group, score, ids, label = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((label, ids, -score, group))
        group = group[order]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        rank = np.arange(len(group)) - np.repeat(first, np.diff([*first, len(group)]))
        kept = rank < self.size
        order = order[kept]
        self.held = (group[kept], score[order], ids[order], label[order])
        full = rank == self.size - 1
        self.least[group[full]] = self.held[1][np.flatnonzero(rank[kept] == self.size - 1)]


def quantised(vectors, width: int) -> np.ndarray:
    """``floor(256 x)`` of an Arrow list column as int64, filled up with zeros."""
    flat = np.floor(256.0 * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.arange(width)[None, :] < sizes[:, None]] = flat
    return found


def _blocks(batches: Iterator, width: int) -> Iterator:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            ids, labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield ids, labels, quantised(part.column(2), width)


def _held(best: Best):
    import pyarrow as pa

    names = ["anchor", "score", "id", "label"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in best.held], names=names)


def _positives(anchors, moduli: list[int]):
    """Best rows of the same label in a task; anchors are sorted by label."""

    def run(batches: Iterator) -> Iterator:
        ids, labels, vectors = anchors.value
        scores, best = Scores(vectors, moduli), Best(len(ids), POSITIVES)
        for row_ids, row_labels, rows in _blocks(batches, vectors.shape[1]):
            for label in np.unique(row_labels):
                low, high = np.searchsorted(labels, [label, label + 1])
                at = np.flatnonzero(row_labels == label)
                for start in range(low, high, ANCHORS):
                    some = np.arange(start, min(start + ANCHORS, high))
                    found = scores(rows[at], some)
                    row, col = np.nonzero((found >= best.least[some]) & (row_ids[at][:, None] != ids[some]))
                    best.add(some[col], found[row, col], row_ids[at][row], row_labels[at][row])
        yield _held(best)

    return run


def _negatives(anchors, positives, moduli: list[int]):
    """Best rows of another label within each positive's bounds, in a task."""

    def run(batches: Iterator) -> Iterator:
        ids, labels, vectors = anchors.value
        lows, highs = positives.value  # (anchors, POSITIVES), low > high where there is none
        scores, best = Scores(vectors, moduli), Best(len(ids) * POSITIVES, NEGATIVES)
        for row_ids, row_labels, rows in _blocks(batches, vectors.shape[1]):
            for start in range(0, len(ids), ANCHORS):
                some = np.arange(start, min(start + ANCHORS, len(ids)))
                found = scores(rows, some)
                other = (row_labels[:, None] != labels[some]) & (row_ids[:, None] != ids[some])
                for k in range(POSITIVES):
                    least = best.least[some * POSITIVES + k]
                    fits = other & (found >= np.maximum(lows[some, k], least)) & (found <= highs[some, k])
                    row, col = np.nonzero(fits)
                    best.add(some[col] * POSITIVES + k, found[row, col], row_ids[row], row_labels[row])
        yield _held(best)

    return run


def _usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite
    ).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).alias("vector"),
    )


def _ranked(found: DataFrame, size: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "id", "label")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the id column.  An anchor's positives are the best
    ``POSITIVES`` rows of its label; for each of them come the best ``NEGATIVES`` rows
    of other labels that score from ``LOW`` to ``HIGH`` hundredths of the positive.
    """
    spark = rows.sparkSession
    usable = _usable(rows, id_col, label_col, vector_col)
    step = "aggregate(vector, 0D, (s, x) -> s + pow(floor(256D * CAST(x AS DOUBLE)), 2))"
    norm, width = usable.agg(F.max(F.expr(step)), F.max(F.size("vector"))).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if norm is None:
        return spark.createDataFrame([], schema)
    if not norm < 2.0**62:
        raise ValueError("scores of these vectors do not fit into 64 bits")
    width = max(width, 1)
    moduli = primes(width, int(norm * (1 + 1e-9)) + 1)  # norm is a sum of doubles

    chosen = _usable(rows.filter(is_anchor), id_col, label_col, vector_col)
    chosen = stage(
        chosen.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("least")).select("id", "least.*"),
        "anchors",
    )
    batches = -(-chosen.count() * (width + 2) * 8 // batch_bytes)
    path = fresh_path(spark, "hard-negatives")
    context = spark.sparkContext
    of_task = "anchor bigint, score bigint, id bigint, label bigint"
    for number in range(batches):
        # Bounded by batch_bytes on average, whatever the size of the table.
        batch = chosen.filter(F.pmod(F.xxhash64("id"), F.lit(batches)) == number).orderBy("label", "id").toArrow()
        if not batch.num_rows:
            continue
        ids, labels = (batch.column(i).to_numpy() for i in (0, 1))
        vectors = quantised(batch.column(2).combine_chunks(), width)
        anchors = context.broadcast((ids, labels, vectors))
        best = _ranked(usable.mapInArrow(_positives(anchors, moduli), of_task), POSITIVES, "anchor").toArrow()
        place, score, rank = (best.column(c).to_numpy() for c in ("anchor", "score", "rank"))
        lows = np.ones((len(ids), POSITIVES), np.int64)
        highs, partner = np.zeros_like(lows), np.zeros_like(lows)
        # LOW * positive <= 100 * negative <= HIGH * positive, in whole numbers.
        lows[place, rank - 1] = [-(-LOW * s // 100) for s in score.tolist()]
        highs[place, rank - 1] = [HIGH * s // 100 for s in score.tolist()]
        partner[place, rank - 1] = best.column("id").to_numpy()
        scored = np.zeros_like(lows)
        scored[place, rank - 1] = score
        bounds = context.broadcast((lows, highs))
        negatives = _ranked(usable.mapInArrow(_negatives(anchors, bounds, moduli), of_task), NEGATIVES, "anchor")
        at, known = np.nonzero(lows <= highs)
        names = spark.createDataFrame(
            _table(at * POSITIVES + known, ids[at], partner[at, known], scored[at, known])
        )
        (
            negatives.join(F.broadcast(names), "anchor")
            .select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"),
            )
            .write.parquet(f"{path}/batch={number}")
        )
        anchors.destroy()
        bounds.destroy()
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")])


def _table(anchor, anchor_id, positive_id, positive_score):
    import pyarrow as pa

    arrays = (anchor, anchor_id, positive_id, positive_score)
    names = ["anchor", "anchor_id", "positive_id", "positive_score"]
    return pa.table({n: pa.array(np.asarray(a, np.int64)) for n, a in zip(names, arrays)})
