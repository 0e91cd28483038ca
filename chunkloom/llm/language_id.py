"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and their n-grams of one to three characters hashed to a fixed
number of buckets, in numpy and without a loop over characters.  Counts per
language come from a bounded sample of the labelled rows and are added up by Spark;
the driver gets one row of the log-probability matrix for each language.  The matrix
is broadcast, and each text is scored from its own buckets.

Defined cases: null or letterless texts are ``und`` with score 0; rows with a null
language are not learned from; without any language everything is ``und``; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import held_out

LOG_BUCKETS = 15
#: About so many labelled rows are learned from, chosen by a hash of the id.
SAMPLE = 20_000
#: Of a language with fewer sampled rows, about so many are learned from instead.
LEAST = 500
#: So many characters of a text are worked on at a time.
BLOCK = 1 << 16


def _buckets(text: str):
    """Bucket of each n-gram of a text; blocks overlap so that no n-gram is lost."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    shift = np.uint64(64 - LOG_BUCKETS)
    for start in range(0, max(len(codes), 1), BLOCK):
        x = codes[start : start + BLOCK + 2].astype(np.uint64)
        own = min(BLOCK, len(codes) - start)
        code, found = np.zeros(len(x), np.uint64), []
        for n in (1, 2, 3):
            m = min(own, len(x) - n + 1)
            if m <= 0:
                break
            code = code[:m] * np.uint64(0x110000) + x[n - 1 : n - 1 + m]
            found.append((code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> shift)
        if found:
            yield np.concatenate(found).astype(np.int64)


def _count(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    totals: dict = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = totals.setdefault(lang, np.zeros(1 << LOG_BUCKETS, np.int64))
            for buckets in _buckets(text.as_py() or ""):
                counts += np.bincount(buckets, minlength=1 << LOG_BUCKETS)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])],
            names=["lang", "bucket", "n"],
        )


def train(docs: DataFrame, learn: Column, sample: int = SAMPLE):
    """``(languages, log-probabilities, log-priors)`` from the rows where ``learn`` holds."""
    import numpy as np

    labelled = docs.filter(learn & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, sample / max(sum(sizes.values()), 1))
    # A rare language is learned from more of its rows than a frequent one.
    above = F.lit(0)
    for lang, size in sizes.items():
        cut = int(min(1.0, max(share, LEAST / size)) * (1 << 20)) + 1
        above = F.when(F.col("lang") == lang, cut).otherwise(above)
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < above
    rows = (
        (labelled.filter(chosen) if share < 1 else labelled)
        .select("lang", "text")
        .mapInArrow(_count, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
        .collect()
    )
    languages = sorted(sizes)
    counts = np.ones((len(languages), 1 << LOG_BUCKETS))
    for row in rows:
        at = languages.index(row["lang"])
        counts[at, list(row["counts"])] += list(row["counts"].values())
    matrix = np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(sum(sizes.values()), 1))
    return languages, matrix.astype(np.float32), prior


def _score(shared):
    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        languages, matrix, prior = shared.value
        rows = np.ascontiguousarray(matrix.T)
        for batch in batches:
            found, scores = [], []
            for text in batch.column(1):
                value = text.as_py()
                if not languages or not value or not any(map(str.isalpha, value)):
                    found.append("und")
                    scores.append(0.0)
                    continue
                total = prior.copy()
                for buckets in _buckets(value):
                    total += rows[buckets].sum(axis=0, dtype=np.float64)
                best = int(total.argmax())
                found.append(languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return score


def identify_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row for each document: ``(doc_id, held_out, lang_pred, score)``.

    Learns from documents that are not held out; the score is the posterior.
    """
    model = train(docs, ~held_out(), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInArrow(
        _score(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
