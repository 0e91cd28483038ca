"""Periodic runs against brute force, and the texts the query makes of documents."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from chunkloom.llm import entry, runs


def brute(words):
    """All runs of a list of words, by definition."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(6, 4 * q) and (start, end) not in seen:
                seen.add((start, end))
                found.append((start, end, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def described(doc_id, words):
    found = brute(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = max(found, key=lambda r: ((r[1] - r[0]) / r[2], -r[0], -r[2])) if found else None
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(found),
        *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def repetitive(rng):
    """Words with runs in runs, near runs and copies."""
    words = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 6)):
        unit = [f"w{rng.randrange(rng.choice([2, 3, 30]))}" for _ in range(rng.randrange(1, 40))]
        words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        if rng.random() < 0.3:
            words += words[-rng.randrange(1, 90) :]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "odd"
    return words


def test_cover_reaches_every_pair():
    shifts = runs.SHIFTS
    assert shifts.min() >= 0 and shifts.max() < runs.COVER
    for a in range(runs.COVER):
        for b in range(runs.COVER):
            assert {(a + shifts[a, b]) % runs.COVER, (b + shifts[a, b]) % runs.COVER} <= set(runs.MEMBERS)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_extensions(alphabet):
    rng = np.random.default_rng(alphabet)
    words = rng.integers(0, alphabet, 700)
    words[300:500] = words[50:250]
    words = np.append(words, alphabet)
    i, j = rng.integers(0, 700, (2, 3000))
    i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
    got = runs.Extensions(words)(i, j)
    for a, b, n in zip(i, j, got):
        assert (words[a : a + n] == words[b : b + n]).all() and words[a + n] != words[b + n]


@pytest.mark.parametrize("together", [200_000, 1])
def test_runs_equal_brute_force(monkeypatch, together):
    rng = random.Random(11)
    texts = [[w.encode() for w in repetitive(rng)] for _ in range(250)]
    texts += [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4, [b"a"] * 3000, list(map(str.encode, "abcabd" * 40))]
    groups = [texts] if together > 1 else [[t] for t in texts]
    got = [row for group in groups for row in runs._described(group)]
    for words, row in zip(texts, got):
        want = brute(words)
        assert row[0] == len(want)
        assert row[5] == "".join(f"{s},{e - s},{q}\n" for s, e, q in want)


def test_copies_among_texts():
    unique = lambda name, n: [f"{name}{i}".encode() for i in range(n)]
    copy = unique("c", 40)
    got = runs._described([copy, unique("a", 100), copy, unique("b", 1000)])
    assert [row[0] for row in got] == [0] * 4
    rng = random.Random(13)
    some = [[w.encode() for w in repetitive(rng)] for _ in range(12)]
    texts = [rng.choice(some) + rng.choice(some) for _ in range(80)] + [unique("d", 9000)]
    for words, row in zip(texts, runs._described(texts)):
        assert row[5] == "".join(f"{s},{e - s},{q}\n" for s, e, q in brute(words))


def test_query(spark, tmp_path):
    rng = random.Random(12)
    texts = [" ".join(repetitive(rng)) for _ in range(300)]
    texts += [None, "", " \t\n", "É x x " * 60, "A a " * 9, "word " * 4000, " ".join(f"u{i}" for i in range(3000))]
    rows = [(i, t, 5, "clash") for i, t in enumerate(texts)] + [(None, "x " * 30, 1, "y"), (3, "p q " * 10, 1, "y")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start int, runs string").repartition(6)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t, _, _ in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        if i is not None and words and (h := zlib.crc32(str(i).encode())) % 10 == 0:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        want.append(described(i, words))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [tuple(r) for r in entry.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert runs.periodic_runs(df.limit(0)).count() == 0
