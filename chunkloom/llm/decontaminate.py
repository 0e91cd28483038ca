"""Benchmark items that documents repeat, found with DataFrame functions only.

A document's words give one hash per five-word shingle.  A window as long as an item
may stand anywhere, also across the ends of the document.  Only those are laid that
hold as many shingles of items of their length as the wanted similarity takes at
least, wherever in the items these stand, so passages in another order are found.
Each distinct window and each item gets a SimHash of 60 bits in 6 blocks of 10.  Windows
look items of their length up by block, and items are listed under every value
within 3 bit errors of a block of theirs: 6 blocks with 4 errors each would be 24, so
every pair within a Hamming distance of 23 meets.  Candidates within it are verified
by the similarity of the shingle multisets, weighted by how often each occurs: the sum
of the lesser counts over the sum of the greater ones, 0.75 or more.

At that similarity the SimHash distance is 10 on average with a deviation of 3.

Defined cases: null texts, and texts or items with fewer than five words, match
nothing; rows without an id match nothing; rows that share an id count as one
document; a passage cut off by either end of a document is compared as far as it goes;
equal items are all reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import rows_among, without_ids
from chunkloom.sources.staging import stage

BLOCKS = 6
BLOCK_BITS = 10
RADIUS = 23
ERRORS = RADIUS // BLOCKS
#: So many item shingles are broadcast at once, about 10 MB; a larger benchmark goes in rounds.
ROUND = 1 << 17
PERCENT = 75


def shingle_hashes(text: str) -> Column:
    """A hash of each five-word shingle of the text in order; none with fewer words."""
    words = f"array_remove(split(lower(`{text}`), '[\\\\x20\\\\x09-\\\\x0D]+'), '')"
    hashed = f"transform({words}, x -> xxhash64(x))"
    five = ", ".join(f"get(h, i + {k})" for k in range(5))
    # Binds the word hashes to a name, so that they are computed once.
    return F.expr(
        f"""transform(array({hashed}), h -> CASE WHEN size(h) >= 5 THEN
            transform(sequence(0, size(h) - 5), i -> xxhash64({five}))
            ELSE array() END)[0]"""
    )


def simhash(hashes: str) -> Column:
    """60 bits: which bits more than half of the hashes have, each as often as it occurs."""
    # Bits b and b + 32 are counted in one pass, in the halves of a long.
    return F.expr(
        f"""aggregate(sequence(0, {BLOCKS * BLOCK_BITS // 2 - 1}), 0L, (bits, b) -> bits | transform(array(
            aggregate({hashes}, 0L, (n, x) -> n + (shiftrightunsigned(x, b) & {1 << 32 | 1}L))), n ->
            shiftleft(CASE WHEN 2 * (n & {(1 << 32) - 1}L) > size({hashes}) THEN 1L ELSE 0L END, 2 * b)
            | shiftleft(CASE WHEN 2 * shiftright(n, 32) > size({hashes}) THEN 1L ELSE 0L END, 2 * b + 1))[0])"""
    )


def bag(hashes: str) -> Column:
    """A multiset of hashes as a set: each hash together with the number of its occurrence.

    Two of them have as many members in common as the multisets, so that a pair is
    compared in time linear in its length.
    """
    first = "filter(sequence(0, size(s) - 1), i -> i = 0 OR get(s, i) <> get(s, i - 1))"
    numbered = f"""transform(array({first}), f -> flatten(transform(f, (i, k) -> transform(
        sequence(1, coalesce(get(f, k + 1), size(s)) - i), c -> xxhash64(get(s, i), c)))))[0]"""
    return F.expr(
        f"""transform(array(sort_array({hashes})), s -> CASE WHEN size(s) > 0 THEN {numbered}
            ELSE CAST(array() AS array<bigint>) END)[0]"""
    )


def weighted_similarity(a: str, b: str) -> Column:
    """Common weight of two multisets, given as bags, over their joint weight."""
    return F.expr(
        f"""transform(array(size(array_intersect({a}, {b}))),
            c -> c / CAST(size({a}) + size({b}) - c AS DOUBLE))[0]"""
    )


def _block(bits: str) -> str:
    return f"CAST(shiftrightunsigned({bits}, block * {BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1} AS INT)"


def _starts(least: str, where: str) -> str:
    """Starts s with ``where`` of windows of m places that hold ``least`` of the sorted ``ats``.

    The window from s on holds k of them if the k-th from the first one in it is still
    inside.  Each start belongs to its first one, so all take one pass.
    """
    return f"""transform(array(CAST({least} AS INT)), k -> CASE WHEN size(ats) >= k THEN
        filter(flatten(transform(sequence(0, size(ats) - k), i ->
            CASE WHEN get(ats, i + k - 1) - m < get(ats, i) THEN
                sequence(greatest(get(ats, i + k - 1) - m, get(ats, i - 1)) + 1, get(ats, i))
            ELSE CAST(array() AS array<int>) END)), s -> {where})
        ELSE CAST(array() AS array<int>) END)[0]"""


def _windows(docs: DataFrame, marks: DataFrame, rounds: int) -> DataFrame:
    """``(doc_id, start, m, window)``: every place where an item of m shingles may stand.

    A window of w shingles with c common ones is similar if c is P / (100 + P) of w + m
    or more: of 2 m where it is whole, and P % of m at least where an end cuts it.
    """
    keyed = docs.withColumns({"one": F.xxhash64("text"), "two": F.xxhash64("text", F.lit("second"))})
    row = ["doc_id", "one", "two"]
    hashed = keyed.select(*row, shingle_hashes("text").alias("hashes"))
    spread = hashed.select(*row, F.size("hashes").alias("n"), F.posexplode("hashes").alias("at", "shingle"))
    hits = reduce(
        DataFrame.unionByName,
        [
            spread.join(F.broadcast(marks.filter(F.pmod("shingle", F.lit(rounds)) == part)), "shingle")
            .select(*row, "n", "m", "at")
            for part in range(rounds)
        ],
    )
    whole = _starts(f"({2 * PERCENT} * m + {99 + PERCENT}) div {100 + PERCENT}", "s BETWEEN 0 AND n - m")
    cut = _starts(f"({PERCENT} * m + 99) div 100", "s NOT BETWEEN 0 AND n - m")
    starts = stage(
        hits.groupBy(*row, "n", "m")
        .agg(F.array_sort(F.collect_set("at")).alias("ats"))
        .select(*row, "m", F.expr(f"concat({whole}, {cut})").alias("starts"))
        .filter("size(starts) > 0")
        .groupBy(*row)
        .agg(F.collect_list(F.struct("m", "starts")).alias("lengths")),
        "starts",
    )
    # Only texts with such places are read again and hashed whole.
    some, _ = rows_among(keyed, starts.select("doc_id"), "doc_id")
    lengths = (
        some.join(starts, row)
        .select("doc_id", shingle_hashes("text").alias("hashes"), "lengths")
        .select("doc_id", "hashes", F.explode("lengths").alias("length"))
        .select("doc_id", "hashes", F.col("length.m").alias("m"), F.explode("length.starts").alias("start"))
    )
    begin = F.col("start")
    return lengths.select(
        "doc_id",
        "start",
        "m",
        F.slice("hashes", F.greatest(begin, F.lit(0)) + 1, F.col("m") + F.least(begin, F.lit(0))).alias("window"),
    ).distinct()


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word)``, a row for each document and item it repeats.

    ``docs`` has doc_id and text, ``items`` item_id and text.  Of several places
    the most similar one counts, then the first.
    """
    listed = stage(
        items.select("item_id", shingle_hashes("text").alias("item"))
        .filter("size(item) > 0")
        .withColumns({"m": F.size("item"), "item_bits": simhash("item"), "item_bag": bag("item")}),
        "items",
    )
    marks = stage(
        listed.select("m", F.explode("item").alias("shingle")).distinct(), "item-shingles"
    )
    rounds = max(1, -(-marks.count() // ROUND))
    read = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    placed = stage(
        _windows(read, marks, rounds)
        .withColumn("one", F.xxhash64("window"))
        .withColumn("two", F.xxhash64("window", F.lit("second"))),
        "windows",
    )
    # The same passage in many documents is one window from here on.
    distinct = stage(
        placed.select("m", "one", "two", "window")
        .distinct()
        .select("m", "one", "two", simhash("window").alias("bits"), bag("window").alias("bag")),
        "fingerprints",
    )
    each_block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    looked = distinct.select("m", "one", "two", "bits", each_block).withColumn("value", F.expr(_block("bits")))
    near = f"filter(sequence(0, {(1 << BLOCK_BITS) - 1}), x -> bit_count(x ^ own) <= {ERRORS})"
    index = (
        listed.select("m", "item_id", "item_bits", each_block)
        .withColumn("own", F.expr(_block("item_bits")))
        .select("m", "item_id", "item_bits", "block", F.explode(F.expr(near)).alias("value"))
    )
    candidates = (
        looked.join(index, ["m", "block", "value"])
        .filter(F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))) <= RADIUS)
        .select("m", "one", "two", "item_id")
        .distinct()
    )
    compared = candidates.join(distinct.drop("bits"), ["m", "one", "two"]).join(
        listed.select("m", "item_id", "item_bag"), ["m", "item_id"]
    )
    similar = stage(
        compared.withColumn("similarity", weighted_similarity("bag", "item_bag"))
        .filter(F.col("similarity") * 100 >= PERCENT)
        .select("m", "one", "two", "item_id", "similarity"),
        "similar",
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back")))
    return (
        placed.select("doc_id", "start", "m", "one", "two")
        .join(similar, ["m", "one", "two"])
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.similarity").alias("similarity"),
            F.greatest(-F.col("best.back"), F.lit(0)).alias("start_word"),
        )
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, that repeat no item."""
    return without_ids(docs, stage(contaminated(docs, items).select("doc_id").distinct(), "leaks"))
