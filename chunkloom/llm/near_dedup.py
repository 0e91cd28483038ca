"""Near duplicates: MinHash signatures in a multi-index Hamming join.

A signature has 30 MinHash values of 16 bits in 6 chunks of 5.  Two signatures
that differ in at most 17 values agree, in one of the chunks at least, in all
but 2 of its 5 values (pigeonhole: 6 chunks with 3 errors each would be 18).  So
each chunk is indexed once for every choice of 2 values to leave out: 60 keys of
3 values.  Every pair within distance 17 shares a key.  At a similarity of 0.75
the distance is 7.5 on average, and above 17 for about one pair in 10,000.

Documents with equal shingle sets become one class first.  Members of a bucket
are compared with its leader, the member that shares buckets with most others,
which joins a group of n copies by n comparisons.  Documents of buckets that hold more than one component after that
are compared further, across components only and by a prefix filter, which is
exact: sets within the similarity share one of their rarest quarter of shingles, and
a passage that many documents share is not rare.  So a bucket's members are never
paired with each other.  Links are confirmed on the full shingle sets of the texts.

Defined cases: null and empty texts, and texts without words, have no shingles
and are linked with nothing; a row without id likewise, and it stays; rows that
share an id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from chunkloom.llm.common import rows_among, without_ids
from chunkloom.llm.components import components
from chunkloom.sources.staging import stage

CHUNKS = 6
CHUNK = 5
ERRORS = 2
SIZE = CHUNKS * CHUNK
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Bound of the most frequent shingles that are broadcast, 8 bytes each.
FREQUENT = 1 << 17
#: Shingles that a task counts at a time, 32 bytes each.
COUNTED = 1 << 21
#: Similarity in hundredths.
PERCENT = 75


def _signatures(batches: Iterator) -> Iterator:
    import pyarrow as pa

    from chunkloom.llm.shingles import MinHash, set_digest, shingles

    minhash = MinHash(SIZE)
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for text in batch.column(1):
            value = text.as_py()
            found = shingles(value.encode()) if value else ()
            sizes.append(len(found))
            digests.append(set_digest(found) if len(found) else None)
            signatures.append(minhash(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ],
            names=["id", "n", "digest", "signature"],
        )


def _keys(batches: Iterator) -> Iterator:
    """The 60 keys of each signature: which values were left in, and those values."""
    import numpy as np
    import pyarrow as pa

    kept = [
        [chunk * CHUNK + i for i in some]
        for chunk in range(CHUNKS)
        for some in combinations(range(CHUNK), CHUNK - ERRORS)
    ]
    for batch in batches:
        ids = batch.column(0).to_numpy()
        values = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16)
        values = values.reshape(-1, SIZE).astype(np.int64)
        for start in range(0, len(ids), 2000):
            part = values[start : start + 2000]
            keys = np.stack(
                [
                    (part[:, a] << 32) | (part[:, b] << 16) | part[:, c] | (index << 48)
                    for index, (a, b, c) in enumerate(kept)
                ]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.tile(ids[start : start + 2000], len(kept)))],
                names=["key", "rep"],
            )


def _within_radius(batches: Iterator) -> Iterator:
    """Keep pairs whose signatures are within the radius and whose sizes allow the similarity."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        one, two = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, SIZE)
            for c in ("sig_a", "sig_b")
        )
        near = (one != two).sum(axis=1) <= RADIUS
        small = np.minimum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        large = np.maximum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        near &= 100 * small >= PERCENT * large
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _confirmed(batches: Iterator) -> Iterator:
    """Keep pairs of texts whose sets are similar enough, counted on the words themselves."""
    import re

    import pyarrow as pa

    word = re.compile(rb"[^\x20\x09-\x0D]+")

    def full_set(text: str) -> set:
        words = word.findall(text.encode().lower())
        return set(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else {tuple(words)}

    last: tuple = (None, None)
    for batch in batches:
        flags = []
        for a, left, right in zip(*(batch.column(c) for c in ("a", "text_a", "text_b"))):
            if last[0] != a.as_py():
                last = (a.as_py(), full_set(left.as_py()))
            one, two = last[1], full_set(right.as_py())
            common = len(one & two)
            flags.append(100 * common >= PERCENT * (len(one) + len(two) - common))
        yield batch.select(["a", "b"]).filter(pa.array(flags, pa.bool_()))


def _sets(batches: Iterator) -> Iterator:
    """``(rep, comp, shingles)`` with the distinct shingles of each text."""
    import numpy as np
    import pyarrow as pa

    from chunkloom.llm.shingles import shingles

    for batch in batches:
        for rep, comp, text in zip(*batch.columns):
            found = pa.array([shingles(text.as_py().encode()).view(np.int64)], pa.list_(pa.int64()))
            ends = [pa.array([rep.as_py()], pa.int64()), pa.array([comp.as_py()], pa.int64())]
            yield pa.RecordBatch.from_arrays([*ends, found], names=["rep", "comp", "shingles"])


def _counted(batches: Iterator) -> Iterator:
    """``(shingle, low, high, df)``: components and number of sets, added up within a task."""
    import numpy as np
    import pyarrow as pa

    def summed(parts: list) -> list:
        shingle, low, high, df = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(shingle, kind="stable")
        first = np.flatnonzero(np.diff(shingle[order], prepend=shingle[order[0]] - 1))
        return [
            shingle[order[first]],
            np.minimum.reduceat(low[order], first),
            np.maximum.reduceat(high[order], first),
            np.add.reduceat(df[order], first),
        ]

    names = ["shingle", "low", "high", "df"]
    parts, size = [], 0
    for batch in batches:
        for comp, values in zip(batch.column("comp"), batch.column("shingles")):
            found = values.values.to_numpy()
            same = np.full(len(found), comp.as_py(), np.int64)
            parts.append((found, same, same, np.ones(len(found), np.int64)))
            size += len(found)
            if size >= COUNTED:
                parts = [summed(parts)]
                size = len(parts[0][0])
                if size >= COUNTED // 2:  # few are the same: hand them on
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=names)
                    parts, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(parts)], names=names)


def _prefix_length(n: int) -> int:
    """So many of the rarest of ``n`` shingles meet those of any similar set."""
    return n - -(-n * PERCENT // 100) + 1


def _rarer(frequent):
    """``(rep, comp, n, left_out, shingle)``: shingles without the most frequent ones.

    These come last in the order.  A set keeps them only if its prefix reaches them.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for rep, comp, values in zip(*batch.columns):
                found = values.values.to_numpy()
                n = len(found)
                rare = found[~np.isin(found, frequent.value)]
                if len(rare) < _prefix_length(n):
                    rare = found
                same = [np.full(len(rare), x, np.int64) for x in (rep.as_py(), comp.as_py(), n, n - len(rare))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (*same, rare)], names=["rep", "comp", "n", "left_out", "shingle"]
                )

    return run


def _confirm(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are links, stored.  ``texts`` is ``(id, text)``."""
    side = lambda s: reps.select(
        F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"sig_{s}")
    )
    near = stage(
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .mapInArrow(_within_radius, "a bigint, b bigint"),
        "candidates",
    )
    ids = stage(
        near.select(F.col("a").alias("wanted")).union(near.select("b")).distinct(), "wanted"
    )
    needed, _ = rows_among(texts, ids, "id")
    needed = stage(needed.join(ids, needed["id"] == ids["wanted"]).select("id", "text"), "texts")
    text_of = lambda s: needed.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
    checked = (
        near.join(text_of("b"), "b")
        .join(text_of("a"), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_confirmed, "a bigint, b bigint")
    )
    return stage(checked.distinct(), "links")


def _prefix_pairs(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs across components that a prefix filter cannot exclude.

    Shingles that one component alone holds can make no pair and come first in
    the order, the others by how many of the documents hold them.  Sets of n
    shingles within the similarity share one of the first ``n - ceil(0.75 n) + 1``
    in that order.  The most frequent shingles, fewer than ``FREQUENT`` whatever the
    corpus, are broadcast, so that sets whose prefix ends before them leave them out.
    """
    import numpy as np
    from pyspark.sql import Window

    named = texts.join(rows.select(F.col("rep").alias("id"), "comp"), "id")
    sets = stage(
        named.select("id", "comp", "text").mapInArrow(
            _sets, "rep bigint, comp bigint, shingles array<bigint>"
        ),
        "sets",
    )
    counted = sets.mapInArrow(_counted, "shingle bigint, low bigint, high bigint, df bigint")
    often = stage(
        counted.groupBy("shingle")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("df").alias("df"))
        .filter("low < high")
        .select("shingle", "df"),
        "frequencies",
    )
    # Fewer than FREQUENT shingles can have more than this share of all places.
    share = (often.agg(F.sum("df")).first()[0] or 0) // FREQUENT
    top = often.filter(F.col("df") > share + 1).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    frequent = often.sparkSession.sparkContext.broadcast(top)
    held = sets.mapInArrow(
        _rarer(frequent), "rep bigint, comp bigint, n bigint, left_out bigint, shingle bigint"
    )
    of_text = Window.partitionBy("rep")
    before = F.col("n") - F.col("left_out") - F.count(F.lit(1)).over(of_text)
    rank = before + F.row_number().over(of_text.orderBy("df", "shingle"))
    prefix = (
        held.join(often, "shingle")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    )
    prefix = stage(
        prefix.select("rep", "comp", "n", "shingle", (F.col("n") - F.col("rank")).alias("rest")),
        "prefixes",
    )
    other = prefix.select(
        F.col("rep").alias("b"), F.col("comp").alias("comp_b"), F.col("n").alias("n_b"), "shingle",
        F.col("rest").alias("rest_b"),
    )
    # After their first common shingle sets can have no more in common than what is
    # left of the shorter rest; the first one passes if the pair is similar.
    overlap = (1 + F.least("rest", "rest_b")) * (100 + PERCENT)
    return (
        prefix.join(other, "shingle")
        .filter("rep < b AND comp <> comp_b")
        .filter(overlap >= PERCENT * (F.col("n") + F.col("n_b")))
        .select(F.col("rep").alias("a"), "b")
        .distinct()
    )


def _led(members: DataFrame) -> DataFrame:
    """``(key, rep, leader)``, stored, from ``(key, rep, size)``.

    The leader of a bucket is the member whose own buckets have the most members, and
    of these the least: in a group of near copies that is the text the others stem
    from, or the one most like them, whatever its id.
    """
    weights = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    weighed = stage(members.join(weights, "rep").select("key", "rep", "weight"), "weighed")
    leaders = weighed.groupBy("key").agg(
        F.min(F.struct((-F.col("weight")).alias("rank"), "rep")).alias("first")
    )
    found = leaders.select("key", F.col("first.rep").alias("leader"))
    return stage(weighed.select("key", "rep").join(found, "key"), "led")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``(rep, comp)`` of documents in buckets of several components, stored.

    The leaders of buckets are left out, as their pairs are known.
    """
    named = stage(
        members.filter("rep <> leader")
        .join(labels, F.col("rep") == labels["node"], "left")
        .select("key", "rep", F.coalesce("label", "rep").alias("comp")),
        "members",
    )
    keys = (
        named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        .filter("low < high").select("key")
    )
    return stage(named.join(keys, "key").select("rep", "comp").distinct(), "mixed")


def _shared_ids(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """Links ``(rep, id)`` for ids that stand at several different texts."""
    several = stage(
        signed.filter("digest IS NOT NULL")
        .groupBy("id")
        .agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
        .filter("low <> high AND id IS NOT NULL")
        .select("id"),
        "shared-ids",
    )
    rows = signed.join(several, "id").select("digest", F.col("id").alias("b"))
    return rows.join(reps, "digest").filter("rep <> b").select(F.col("rep").alias("a"), "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: ``(id, n_shingles, component_id, kept)``.

    Documents of a component reach each other by links of a Jaccard similarity
    of 0.75 or more between their sets of five-word shingles; its smallest id
    names it and is the one that stays.  Ids are whole numbers of any size; others,
    such as strings, are an error.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} is {docs.schema[id_col].dataType.simpleString()}, not a whole number")
    read = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = stage(
        read.mapInArrow(
            _signatures, "id bigint, n bigint, digest binary, signature binary"
        ),
        "signatures",
    )
    reps = stage(
        signed.filter("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature")),
        "classes",
    )
    keys = reps.select("rep", "signature").mapInArrow(_keys, "key bigint, rep bigint")
    buckets = stage(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets"
    )
    members = _led(stage(keys.join(buckets, "key"), "bucket-members"))
    texts = read.filter("id IS NOT NULL AND text IS NOT NULL")
    pairs = members.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    links = _confirm(pairs.distinct(), reps, texts).union(_shared_ids(signed, reps))
    labels = components(links)
    mixed = _mixed(members, labels)
    if mixed.head(1):
        needed, _ = rows_among(texts, mixed.select("rep"), "id")
        more = _confirm(_prefix_pairs(mixed, needed), reps, texts)
        if more.head(1):
            labels = components(links.union(more))
    final = stage(
        reps.join(labels, reps["rep"] == labels["node"], "left").select(
            F.col("digest").alias("class"), F.coalesce("label", "rep").alias("component")
        ),
        "class-components",
    )
    joined = signed.join(final, (signed["digest"] == final["class"]) & signed["id"].isNotNull(), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one of each component: the smallest id."""
    gone = near_duplicates(docs, id_col, text_col).filter("NOT kept").select(id_col)
    return without_ids(docs, stage(gone, "near-copies"), id_col)
