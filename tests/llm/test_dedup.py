"""Exact and near duplicates against brute force, and the cases the docstrings define."""

import random
import re

import pytest

from chunkloom.llm import exact_dedup, near_dedup

WORDS = [f"w{i}" for i in range(400)]


def texts(seed=3):
    """Random texts, copies, near copies, a shared passage and odd ones."""
    rng = random.Random(seed)
    found = [" ".join(rng.choices(WORDS, k=rng.choice([3, 5, 40, 120]))) for _ in range(60)]
    passage = " ".join(rng.choices(WORDS, k=60))
    found += [f"{passage} " + " ".join(rng.choices(WORDS, k=rng.randrange(5, 60))) for _ in range(90)]
    for base in found[2:40]:
        words = base.split()
        words[rng.randrange(len(words))] = "changed"
        found += [base, base.upper(), " ".join(words)]
    return [*found, *[found[5]] * 40, "", None, "  \t\n", "", "x" * 300_000, " ".join(WORDS * 60)]


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", i % 3) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string, n int").repartition(5)


def test_exact(docs):
    rows = exact_dedup.exact_duplicates(docs).collect()
    groups = {}
    for i, t in enumerate(texts()):
        groups.setdefault(t or "", []).append(i)
    of = {i: g for g in groups.values() for i in g}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows} == {
        i: (max(g), len(g), i == max(g)) for i, g in of.items()
    }
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_exact_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, None), (None, ""), (2, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in exact_dedup.exact_dedup(df).collect()) == [
        (0, ""), (1, "a"), (2, "b"),
    ]
    assert exact_dedup.exact_duplicates(df).count() == 6
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0


def components(sets):
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("counted", [1 << 21, 1000])
def test_near(docs, monkeypatch, counted):
    monkeypatch.setattr(near_dedup, "COUNTED", counted)  # 1000: counts are handed on in parts
    sets = [shingles(t) for t in texts()]
    rows = near_dedup.near_duplicates(docs).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, components(sets)))}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_odd_rows(spark):
    long = " ".join(WORDS[:50])
    rows = [(7, long), (None, long), (3, long), (3, "other words"), (9, "other words"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [(0, 0, True), (3, 3, True), (3, 3, True), (5, 5, True), (7, 3, False), (9, 3, False)]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0
    assert near_dedup.near_dedup(df).columns == df.columns
