import models
import pytest
from pyspark.sql import functions as F
from texts import random_texts

from chunkloom.functions import leaf_hashes, merkle_levels, merkle_root
from chunkloom.operators import (
    chunk,
    corpus_root,
    file_roots,
    fingerprint,
    group_roots,
    merkle_nodes,
    number_rows,
    reduce_blocks,
    with_chunks_only,
    with_root,
)

def test_roots_of_words(spark):
    lists = [[], ["ebb"], ["ebb", "flow"], ["ebb", "flow", "ebb"]]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(lists)], "id int, b array<string>")
    got = df.select("id", merkle_root(leaf_hashes(F.col("b"))).alias("r")).orderBy("id").collect()
    assert [r.r for r in got] == [models.root(map(models.sha, b)) if b else None for b in lists]


def test_a_null_leaf_makes_the_root_null(spark):
    lists = [["a", None, "c"], ["a", "a", "c"], [None], ["a", "b", None]]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(lists)], "id int, b array<string>")
    got = df.select("id", merkle_root(leaf_hashes(F.col("b"))).alias("r")).orderBy("id").collect()
    assert [r.r is None for r in got] == [True, False, True, True]


def test_roots_of_many_sizes(spark):
    sizes = [*range(18), 31, 32, 33, 64, 65, 100, 1000]
    df = spark.createDataFrame([(n, [f"t{i}" for i in range(n)]) for n in sizes], "n int, b array<string>")
    got = dict(df.select("n", merkle_root(leaf_hashes(F.col("b")))).collect())
    assert got == {n: models.root([models.sha(f"t{i}") for i in range(n)]) for n in sizes}


def test_root_depends_on_every_leaf_and_on_order(spark):
    base = list("abcdefg")
    variants = [base] + [base[:i] + ["X"] + base[i + 1 :] for i in range(7)]
    variants += [base[:i] + [base[i + 1], base[i]] + base[i + 2 :] for i in range(6)]
    df = spark.createDataFrame([(v,) for v in variants], "b array<string>")
    roots = df.select(merkle_root(leaf_hashes(F.col("b")))).distinct().count()
    assert roots == len(variants)


def test_lone_last_leaf_counts_twice_so_roots_go_with_counts(spark):
    df = spark.createDataFrame([(list("abc"),), (list("abcc"),)], "b array<string>")
    assert df.select(merkle_root(leaf_hashes(F.col("b")))).distinct().count() == 1


def test_nodes_of_three_leaves(spark):
    df = spark.createDataFrame([("p", ["w1", "w2", "w3"])], "path string, chunks array<string>")
    rows = merkle_nodes(fingerprint(df)).orderBy("level", "pos").collect()
    a, b, c = (models.sha(f"w{i}") for i in (1, 2, 3))
    ab, cc = models.sha(a + b), models.sha(c + c)
    assert [tuple(r)[1:] for r in rows] == [
        (0, 0, a, None, None),
        (0, 1, b, None, None),
        (0, 2, c, None, None),
        (1, 0, ab, a, b),
        (1, 1, cc, c, c),
        (2, 0, models.sha(ab + cc), ab, cc),
    ]


def test_levels_end_in_the_root(spark):
    sizes = [1, 2, 5, 9, 40]
    df = spark.createDataFrame([([f"t{i}" for i in range(n)],) for n in sizes], "b array<string>")
    hashes = leaf_hashes(F.col("b"))
    top = F.element_at(merkle_levels(hashes), -1)
    assert df.filter((F.size(top) != 1) | (F.get(top, F.lit(0)) != merkle_root(hashes))).count() == 0


def test_file_roots(spark):
    texts = random_texts(200, seed=3)
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, content string")
    found = file_roots(with_root(with_chunks_only(fingerprint(chunk(df))))).collect()
    got = {r.path: (r.root_hash, r.n_chunks) for r in found}
    chunks = {str(i): models.line_chunks(t) for i, t in enumerate(texts)}
    assert got == {p: (models.root(map(models.sha, c)), len(c)) for p, c in chunks.items() if c}


@pytest.mark.parametrize("bits", [1, 2, 4, 10])
def test_blocks_give_the_same_root(spark, bits):
    sizes = {"a": 1, "b": 2, "c": 5, "d": 17, "e": 64, "f": 65, "g": 300}
    leaves = [(k, i, models.sha(f"{k}{i}")) for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(leaves, "k string, pos bigint, hash string")
    got = {r.k: (r.root_hash, r.n_leaves) for r in reduce_blocks(df, 300, within=["k"], bits=bits).collect()}
    assert got == {
        k: (models.root(models.sha(f"{k}{i}") for i in range(n)), n) for k, n in sizes.items()
    }


def test_numbers_have_no_gaps_even_in_one_large_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 3001).alias("at"),
    )
    rows = number_rows(df, ["at"], within=["k"]).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.k, []).append((r["at"], r.pos))
    assert len(rows) == 3000 and len(groups["hot"]) == 1000
    for members in groups.values():
        assert [p for _, p in sorted(members)] == list(range(len(members)))


def test_numbers_over_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("at"))
    rows = number_rows(df, ["at"]).orderBy("at").collect()
    assert [r.pos for r in rows] == list(range(1000))


def test_group_roots_with_null_key_and_ties(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), (None, 1, "z"), (None, 5, "w"), ("b", 1, "t"), ("b", 1, "t")]
    df = spark.createDataFrame(data, "k string, at int, text string")
    got = {r.k: (r.root_hash, r.n_leaves) for r in group_roots(df, ["k"], ["at"], "text").collect()}
    expect = {"a": ["y", "x"], None: ["z", "w"], "b": ["t", "t"]}
    assert got == {k: (models.root(map(models.sha, v)), len(v)) for k, v in expect.items()}


def test_corpus_root(spark):
    df = spark.range(1500).select("id", F.concat(F.lit("t"), F.col("id")).alias("content"))
    row = corpus_root(df.repartition(7), ["id"], bits=4).first()
    assert tuple(row) == (models.root(models.sha(f"t{i}") for i in range(1500)), 1500)
    assert tuple(corpus_root(df.filter("id < 0"), ["id"]).first()) == (None, 0)
