"""Node tables of trees that span many blocks, against a plain fold."""

import hashlib

import pytest
from pyspark.sql import functions as F

from chunkloom.operators import corpus_nodes, corpus_root, tree_nodes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(texts):
    level = [sha(t) for t in texts]
    found = [(0, i, h, None, None) for i, h in enumerate(level)]
    number = 0
    while len(level) > 1:
        pairs = [(level[i], level[min(i + 1, len(level) - 1)]) for i in range(0, len(level), 2)]
        level, number = [sha(a + b) for a, b in pairs], number + 1
        found += [(number, i, h, *pair) for i, (h, pair) in enumerate(zip(level, pairs))]
    return found


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("n, bits", [(0, 2), (1, 2), (2, 1), (4, 2), (5, 2), (17, 2), (64, 3), (100, 3), (65, 10)])
def test_nodes_of_one_tree(spark, n, bits):
    texts = [f"t{i * 7 % 13}" for i in range(n)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, content string").repartition(3)
    nodes = corpus_nodes(df, ["i"], bits=bits)
    assert sorted(map(tuple, nodes.collect()), key=key) == sorted(plain(texts), key=key)
    if n:
        root = corpus_root(df, ["i"]).first().root_hash
        assert nodes.orderBy(F.desc("level")).first()["hash"] == root


def test_nodes_of_groups(spark):
    sizes = {"a": 1, "b": 3, "c": 4, "d": 40, None: 9, "e": 16}
    rows = [(k, i, f"{k}{i}") for k, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, content string").repartition(5)
    got = sorted(map(tuple, tree_nodes(df, ["i"], within=["k"], bits=2).collect()), key=key)
    want = [(k, *row) for k, n in sizes.items() for row in plain([f"{k}{i}" for i in range(n)])]
    assert got == sorted(want, key=key)
