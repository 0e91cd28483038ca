"""Line dedup against brute force, and what the runs of hashes hold."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chunkloom.llm import line_dedup

UPPER, LOWER = (bytes(range(a, a + 26)) for a in (65, 97))


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").encode().translate(bytes.maketrans(UPPER, LOWER)).decode()


def brute(rows, least=5):
    holders = {}
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= 40:
                    holders.setdefault(key(line), set()).add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or last.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def documents():
    rng = random.Random(8)
    pool = [f"{'repeated line of some length é '[: rng.randrange(20, 31)]} {i:03d} {'x' * rng.randrange(0, 16)}" for i in range(80)]
    pool += ["É" * 39, "É" * 40, "é" * 40, "Ab " * 20, "", "short"]
    hot = "a line that a third of all documents hold, at least"
    rows = []
    for i in range(300):
        lines = rng.choices(pool, k=rng.randrange(0, 9))
        lines = [rng.choice([x, x.upper(), f" \t{x}\r", f"{x}\x0b"]) for x in lines]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), hot)
            lines += [hot] * rng.randrange(3)
        rows.append((rng.choice([i, -i]), "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, f"{hot}\n" * 20_000), (1003, hot), (7, hot), (7, hot)]
    return rows + [(None, hot), (None, hot), (None, None)]


def result(df):
    rows = line_dedup.dedup_lines(df, [F.col("doc_id")])
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))


@pytest.mark.parametrize("frequent", [1 << 17, 8])
def test_lines_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)  # 8: most repeated lines are joined
    rows = documents()
    df = spark.createDataFrame([(i, t, 1, b"x", "y") for i, t in rows], "doc_id bigint, text string, n int, key binary, gone string")
    order = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in result(df.repartition(7)).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert result(df).count() == 0


def test_each_hash_is_in_one_run(spark):
    rng = random.Random(2)
    index = line_dedup.LineRuns(spark)
    docs = {}
    for batch in range(5):
        lines = {(batch * 100 + i, bytes([rng.randrange(60)]) * 16) for i in range(40)}
        for i, k in lines:
            docs.setdefault(k, set()).add(i)
        index.add(spark.createDataFrame(sorted(lines), "id bigint, key binary"))
        assert len(index.runs()) <= 2 + batch // 2
        held = [bytes(r.key) for name in index.runs() for r in spark.table(name).collect()]
        assert sorted(held) == sorted(docs)
    assert [len(level) for level in index.levels] == [1, 0, 1]
    got = {bytes(r.key): (r.docs, r["last"]) for r in index.repeated(3).collect()}
    assert got == {k: (len(v), max(v)) for k, v in docs.items() if len(v) >= 3}
    with index._in_order():
        one, two = (spark.table(name) for name in index.runs())
        plan = one.join(two.hint("merge"), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    index.close()
    assert index.runs() == [] and index.paths == {}
