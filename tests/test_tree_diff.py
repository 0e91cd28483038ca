"""Differing leaves by descent of stored trees, and what the descent looks at."""

import random

from pyspark.sql import functions as F

from chunkloom.functions import leaf_hash
from chunkloom.operators import diff as module
from chunkloom.operators import diff_chunks, diff_trees, fingerprint, store_trees


def snapshot(spark, files):
    rows = [(p, c) for p, c in files.items()]
    return fingerprint(spark.createDataFrame(rows, "path string, chunks array<string>"))


def versions():
    rng = random.Random(4)
    old = {f"p{i}": [f"c{rng.randrange(9)}" for _ in range(rng.randrange(0, 40))] for i in range(40)}
    old |= {"three": ["a", "b", "c"], "one": ["x"], "gone": ["q"] * 5, "big": [f"b{i}" for i in range(1000)]}
    new = {p: list(c) for p, c in old.items() if p != "gone"}
    for path in list(new)[:25]:
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(new[path]) + 1)
            new[path][at:at] = rng.choice([["n"], [], ["n", "m"]])
            if new[path] and rng.random() < 0.5:
                new[path][rng.randrange(len(new[path]))] = "changed"
            if rng.random() < 0.3:
                new[path] = new[path][:-3]
    return old, new | {"three": ["a", "b", "c", "c"], "added": ["z", "z"], "big": [*old["big"][:700], "!", *old["big"][701:]]}


def brute(old, new):
    found = set()
    for path in old | new:
        a, b = old.get(path, []), new.get(path, [])
        for i in range(max(len(a), len(b))):
            one, two = (x[i] if i < len(x) else None for x in (a, b))
            if one != two:
                found.add((path, i, one, two))
    return found


def test_descent_equals_comparing_all_leaves(spark):
    old, new = versions()
    folders = [store_trees(snapshot(spark, v)) for v in (old, new)]
    texts = {x for v in (old, new) for c in v.values() for x in c}
    hashes = spark.createDataFrame([(t,) for t in texts], "t string").select("t", leaf_hash(F.col("t")).alias("h"))
    of = {r.t: r.h for r in hashes.collect()} | {None: None}
    want = {(p, i, of[a], of[b]) for p, i, a, b in brute(old, new)}
    got = [tuple(r) for r in diff_trees(spark, *folders).collect()]
    assert len(got) == len(want) and set(got) == want
    assert diff_trees(spark, folders[0], folders[0]).count() == 0


def test_leaves_are_read_only_below_differing_nodes(spark, monkeypatch):
    old, new = versions()
    folders = [store_trees(snapshot(spark, {"big": v["big"]})) for v in (old, new)]
    plans, compared = [], []
    stage = module.stage

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        stored = stage(df, name)
        compared.append(stored.count())
        return stored

    monkeypatch.setattr(module, "stage", seen)
    assert diff_trees(spark, *folders).count() == 1
    assert compared == [1] * 11  # one node on the way down at each level
    for name, plan in plans[1:]:
        assert plan.count("LeftSemi") == 2, name


def test_empty(spark):
    none = store_trees(snapshot(spark, {"p": []}))
    some = store_trees(snapshot(spark, {"p": ["x"]}))
    assert diff_trees(spark, none, none).count() == 0
    assert [(r.path, r.pos, r.old_hash) for r in diff_trees(spark, none, some).collect()] == [("p", 0, None)]


def test_sides_of_a_chunk_diff_are_read_once(spark, monkeypatch):
    old, new = (snapshot(spark, v) for v in versions())
    names = []
    stage = module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: names.append(name) or stage(df, name))
    plan = diff_chunks(old, new)._jdf.queryExecution().optimizedPlan().toString()
    assert names == ["snapshots"]
    assert "sha2" not in plan and "LogicalRDD" not in plan
