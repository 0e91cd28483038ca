from collections import Counter

import models
from pyspark.sql import functions as F

from chunkloom.functions import fail_when
from chunkloom.operators import (
    chunk,
    diff_chunks,
    diff_files,
    distinct_chunks,
    explode_chunks,
    file_roots,
    file_states,
    fingerprint,
    latest,
    pending_chunks,
    read_runs,
    reuse_embeddings,
    synced_roots,
    update_manifest,
    write_run,
)
from chunkloom.plans import index_chunks

A, B, C = "def a():\n  1\n", "def b():\n  2\n", "def c():\n  3\n"
OLD = {"same.py": A + B, "gone.py": A, "edit.py": A + B + B + C, "tail.py": A + B + C}
NEW = {"same.py": A + B, "new.py": C, "edit.py": A + B + A, "tail.py": A + B + C + C}


def prints(spark, files):
    df = spark.createDataFrame(list(files.items()), "path string, content string")
    return fingerprint(chunk(df))


def test_file_diff(spark):
    rows = diff_files(file_roots(prints(spark, OLD)), file_roots(prints(spark, NEW))).collect()
    # The root of tail.py stays the same when its last chunk is repeated; its count does not.
    assert {r.path: r.change for r in rows} == {
        "same.py": "unchanged", "gone.py": "removed", "new.py": "added", "edit.py": "changed", "tail.py": "changed",
    }
    tail = next(r for r in rows if r.path == "tail.py")
    assert tail.old_root_hash == tail.new_root_hash


def test_chunk_diff_counts_copies(spark):
    rows = diff_chunks(prints(spark, OLD), prints(spark, NEW)).collect()
    got = {(r.path, r.chunk_hash): (r.n_kept, r.n_added, r.n_removed) for r in rows}
    want = {}
    for p in (OLD.keys() | NEW.keys()) - {"same.py"}:
        old, new = (Counter(models.line_chunks(s.get(p, ""))) for s in (OLD, NEW))
        for c in old | new:
            want[p, models.sha(c)] = (
                min(old[c], new[c]), max(new[c] - old[c], 0), max(old[c] - new[c], 0)
            )
    assert got == want


def test_reuse(spark):
    chunks = explode_chunks(prints(spark, {**OLD, **{f"x{i}.py": B for i in range(50)}}), "chunk_hashes")
    cache = spark.createDataFrame(
        [(models.sha(A), "e2"), (models.sha(A), "e1"), ("unused", "e3")], "chunk_hash string, embedding string"
    )
    rows = {r.chunk: r for r in reuse_embeddings(chunks, cache).collect()}
    assert {c: (r.embedding, r.needs_embedding) for c, r in rows.items()} == {
        A: ("e1", False), B: (None, True), C: (None, True),
    }
    assert rows[B].n_copies == 54 and (rows[B].path, rows[B].chunk_index) == ("edit.py", 1)
    pending = pending_chunks(chunks, cache).collect()
    assert {r.chunk: r.n_copies for r in pending} == {B: 54, C: 2}
    assert distinct_chunks(chunks).count() == 3


def test_manifest(spark):
    old = spark.createDataFrame([("a", 1, "r1"), ("b", 1, "r2")], "path string, run_id bigint, root_hash string")
    run = spark.createDataFrame([("b", 2, "r3"), ("c", 2, "r4")], old.schema)
    rows = update_manifest(old, run).collect()
    assert sorted((r.path, r.run_id, r.root_hash) for r in rows) == [("a", 1, "r1"), ("b", 2, "r3"), ("c", 2, "r4")]
    assert latest(old.union(run).union(run)).count() == 3


def test_repeated_rows_count_once(spark):
    df = spark.createDataFrame([("a", A + "# erro\n" + B)], "path string, content string")
    index = index_chunks(df, fails=fail_when)
    (once,) = file_states(index).collect()
    assert file_states(index.union(index)).collect() == [once] and (once.n_chunks, once.n_failed) == (2, 1)


def test_stored_runs(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    assert read_runs(spark, folder).count() == 0
    df = spark.createDataFrame([("a", A + B), ("b", A + "# erro\n")], "path string, content string")
    states = file_states(index_chunks(df, fails=fail_when))
    write_run(states, folder, 0)
    write_run(states, folder, 0)
    write_run(states.filter("path = 'a'"), folder, 1)
    assert read_runs(spark, folder).count() == 3
    assert read_runs(spark, folder, before=1).count() == 2
    # A file with a failed chunk is not in sync and is sent again next time.
    roots = [r[0] for r in synced_roots(read_runs(spark, folder)).collect()]
    assert roots == [models.root([models.sha(A), models.sha(B)])]
    again = index_chunks(df, synced_roots(read_runs(spark, folder)), fails=fail_when)
    assert dict(again.groupBy("original_file_path").agg(F.max("status")).collect()) == {"a": "cached", "b": "failed"}


def test_no_text_before_the_cache_is_asked(spark, monkeypatch):
    from chunkloom.operators import reuse

    plans = []
    stage = reuse.stage

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(reuse, "stage", seen)
    chunks = spark.createDataFrame([("p", 0, "h", "text")] * 2, "path string, chunk_index int, chunk_hash string, chunk string")
    cache = spark.createDataFrame([("k", "e")], "chunk_hash string, embedding string")
    rows = pending_chunks(chunks, cache).collect()
    assert [(r.path, r.chunk, r.n_copies) for r in rows] == [("p", "text", 2)]
    assert len(plans) == 1 and "Anti" in plans[0]
    for line in plans[0].splitlines():
        assert not (("Exchange" in line or "Sort" in line) and "chunk#" in line), line
