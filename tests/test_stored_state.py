"""Stored manifests, index runs and corpora over several runs."""

import models
import pytest

from chunkloom.operators import (
    compact,
    corpus_root,
    drop_covered,
    latest,
    read_runs,
    store_corpus,
    stored_root,
    synced_roots,
    update_corpus,
    write_run,
)
from chunkloom.sources import read_index, write_index
from chunkloom.sources.staging import names
from chunkloom.streaming.index_stream import _stream_id

STATES = "path string, root_hash string, n_chunks int, n_failed bigint"
RUNS = [
    [("a", "r1", 1, 0), ("b", "r2", 2, 1)],
    [("a", "r1", 1, 0), ("b", "r2", 2, 0), (None, "r9", 1, 0)],
    [("a", "r3", 4, 1), ("c", None, 0, 0)],
    [("b", "r5", 2, 0)],
]


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def views(spark, folder, before=None):
    runs = read_runs(spark, folder, before)
    return bag(latest(runs)), bag(synced_roots(runs))


def stored(spark, folder, runs):
    for i, rows in enumerate(runs):
        write_run(spark.createDataFrame(rows, STATES), folder, i)


def test_snapshots_give_what_the_runs_give(spark, tmp_path):
    plain, folder = str(tmp_path / "plain"), str(tmp_path / "folder")
    stored(spark, plain, RUNS)
    stored(spark, folder, RUNS[:3])
    assert not compact(spark, folder, at_least=4)
    assert compact(spark, folder, before=2)
    assert not compact(spark, folder, before=2)
    write_run(spark.createDataFrame(RUNS[3], STATES), folder, 3)
    for before in (None, 0, 1, 2, 3):
        assert views(spark, folder, before) == views(spark, plain, before)
    # A path and state that two runs saw is one row, with the later run.
    seen = read_runs(spark, folder, before=2).filter("path = 'a'").collect()
    assert [(r.root_hash, r.run_id) for r in seen] == [("r1", 1)]

    compact(spark, folder)
    drop_covered(spark, folder)
    assert not [e for e in names(spark, f"{folder}/stream=batch") if e.startswith("run_id=")]
    assert len(names(spark, f"{folder}/_snapshots/batch")) == 1
    assert views(spark, folder) == views(spark, plain)
    with pytest.raises(ValueError):
        read_runs(spark, folder, before=2)
    with pytest.raises(ValueError):
        write_run(spark.createDataFrame(RUNS[0], STATES), folder, 1)


def test_unpublished_snapshots_do_not_count(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    assert not compact(spark, folder) and read_runs(spark, folder).count() == 0
    stored(spark, folder, RUNS)
    want = views(spark, folder)
    spark.createDataFrame([("x", "lost", 1, 0, "batch", 9)], STATES + ", stream string, run_id bigint").write.parquet(
        f"{folder}/_snapshots/batch/cutshort"
    )
    assert views(spark, folder) == want


def test_streams_keep_their_own_snapshots(spark, tmp_path):
    folder = str(tmp_path / "manifest")
    stored(spark, folder, RUNS[:2])
    write_run(spark.createDataFrame(RUNS[2], STATES), folder, 0, "other")
    compact(spark, folder, "other")
    drop_covered(spark, folder, "other")
    assert read_runs(spark, folder).count() == 7
    assert read_runs(spark, folder, before=0).filter("stream = 'batch'").count() == 0
    assert read_runs(spark, folder, before=0).count() == 2


def test_a_repeated_index_run_replaces_its_rows(spark, tmp_path):
    folder = str(tmp_path / "index")
    rows = [("a", 0, "failed"), ("b", 0, "cached")]
    df = spark.createDataFrame(rows, "path string, chunk_index int, status string")
    write_index(df, folder, run_id=1)
    write_index(df.filter("status = 'cached'"), folder, run_id=2)
    write_index(df.filter("status = 'cached'"), folder, run_id=1)
    assert bag(read_index(spark, folder).select("path", "status", "run_id")) == [("b", "cached", 1), ("b", "cached", 2)]


def test_an_empty_id_folder_is_a_new_stream(spark, tmp_path):
    (tmp_path / "stream-id").mkdir()
    found = _stream_id(spark, str(tmp_path))
    assert found and _stream_id(spark, str(tmp_path)) == found


def texts(spark, rows):
    return spark.createDataFrame(rows, "id bigint, content string")


@pytest.mark.parametrize("n_old, n_new", [(0, 0), (0, 3), (1, 1), (4, 1), (5, 3), (16, 0), (16, 1), (21, 30)])
def test_updated_roots_equal_full_folds(spark, tmp_path, n_old, n_new):
    folder = str(tmp_path / "corpus")
    old = {i: f"text {i % 3}" for i in range(0, 2 * n_old, 2)}
    store_corpus(texts(spark, list(old.items())), folder, "id", bits=2)
    delta = {i: f"new {i}" for i in list(old)[1::5]} | {1000 + i: "more" for i in range(n_new)}
    # A repeated key counts once.
    update_corpus(texts(spark, 2 * list(delta.items())), folder, "id")
    whole = texts(spark, list((old | delta).items()))
    want = corpus_root(whole, ["id"], bits=2).collect()
    assert stored_root(spark, folder).collect() == want
    leaves = [models.sha(t) for _, t in sorted((old | delta).items())]
    assert want[0].root_hash == (models.root(leaves) if leaves else None)


def test_an_update_writes_only_the_blocks_it_touches(spark, tmp_path):
    folder = str(tmp_path / "corpus")
    store_corpus(texts(spark, [(i, str(i)) for i in range(40)]), folder, "id", bits=2)
    update_corpus(texts(spark, [(9, "nine"), (10, "ten"), (40, "forty")]), folder, "id")
    blocks = spark.read.parquet(f"{folder}/blocks").filter("gen = 1")
    assert bag(blocks.select("block", "n_leaves")) == [(10, 1), (2, 4)]
    # An update cut short before its blocks were written is as if it had not been.
    want = stored_root(spark, folder).collect()
    update_corpus(texts(spark, [(0, "zero")]), folder, "id")
    (tmp_path / "corpus" / "blocks" / "gen=2" / "_SUCCESS").unlink()
    assert stored_root(spark, folder).collect() == want
    update_corpus(texts(spark, []), folder, "id")
    assert stored_root(spark, folder).collect() == want


def test_keys_that_cannot_be_placed(spark, tmp_path):
    folder = str(tmp_path / "corpus")
    with pytest.raises(ValueError):
        update_corpus(texts(spark, [(1, "a")]), folder, "id")
    store_corpus(texts(spark, [(1, "a"), (5, "b")]), folder, "id")
    for row in ((3, "between"), (None, "none")):
        with pytest.raises(ValueError):
            update_corpus(texts(spark, [row]), folder, "id")
    with pytest.raises(ValueError):
        store_corpus(texts(spark, [(1, "a")]), folder, "id")
