"""Hard negatives against brute force in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import hard_negatives as hn


def brute(rows):
    """By definition, over ``(id, label, components)`` of unique ids."""
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for i, label, v in usable:
        if i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in usable if j != i]
        first = sorted((-s, j) for s, j, other in scored if other == label)[:5]
        for s, j in first:
            near = sorted((-t, k) for t, k, other in scored if other != label and -80 * s <= 100 * t <= -100 * s)
            out |= {(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(near[:5])}
    return out


def vectors(seed, n=900, width=24):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        v = [float(np.float32(x + rng.gauss(0, 0.5))) for x in c]
        rows.append((i * 5, rng.randrange(4), v))
    same = rows[0][2]
    rows += [(100_000 + 50 * i, i % 3, same) for i in range(60)]  # ties
    rows += [(7, None, same), (8, 1, None), (9, 1, [None, 1.0]), (11, 1, [math.nan]), (12, 1, [math.inf]), (None, 1, same)]
    return rows + [(13, 1, []), (200_100, 2, []), (14, 2, [5000.0, -0.5]), (-300, 3, same[:5]), (200, None, same)]


@pytest.mark.parametrize("batch_bytes", [1 << 24, 3000])
def test_equals_brute_force(spark, batch_bytes):
    rows = [r for r in {r[0]: r for r in vectors(1)}.values()]
    data = [(*r, 1, "clash") for r in rows]
    df = spark.createDataFrame(data, "vec_id bigint, label int, embedding array<float>, rank int, score string")
    got = hn.mine_hard_negatives(df.repartition(5), F.col("vec_id") % 100 == 0, batch_bytes=batch_bytes)
    got = [tuple(r) for r in got.collect()]
    want = brute(rows)
    assert len(want) > 500 and len(got) == len(set(got)) and set(got) == want


def test_odd_tables(spark):
    schema = "vec_id bigint, label int, embedding array<double>"
    anchor = F.col("vec_id") % 100 == 0
    assert hn.mine_hard_negatives(spark.createDataFrame([], schema), anchor).count() == 0
    none = spark.createDataFrame([(1, 1, [1.0]), (2, 2, None)], schema)
    assert hn.mine_hard_negatives(none, anchor).count() == 0
    alone = spark.createDataFrame([(100, 1, [1.0])], schema)
    assert hn.mine_hard_negatives(alone, anchor).count() == 0
    rows = [(100, 1, [1.0]), (100, 1, [1.0]), (100, 2, [1.0]), (1, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.9])]
    got = hn.mine_hard_negatives(spark.createDataFrame(rows, schema), anchor).collect()
    assert {(r.anchor_id, r.positive_id, r.negative_id) for r in got} == {(100, 1, 2)}
    with pytest.raises(ValueError):
        hn.mine_hard_negatives(spark.createDataFrame([(0, 1, [1e30])], schema), anchor)


@pytest.mark.parametrize("width, size", [(1, 10), (64, 300), (64, 1 << 24), (3000, 500), (7, 1 << 28)])
def test_residue_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    one, two = rng.integers(-size, size + 1, (2, 40, width))
    one[0], two[0] = size, size
    two[1] = -size
    norm = max(int((x.astype(object) ** 2).sum(axis=1).max()) for x in (one, two))
    moduli = hn.primes(width, norm)
    half = max(moduli) // 2
    assert min(width, hn.INNER) * half**2 < 1 << 24
    want = one.astype(object) @ two.astype(object).T
    assert (hn.Scores(two, moduli)(one, np.arange(40)) == want).all()
