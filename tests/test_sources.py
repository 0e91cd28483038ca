import os

import models
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chunkloom.operators import matching_files
from chunkloom.plans import index_chunks
from chunkloom.sources import (
    decode_files,
    from_table,
    list_source_tree,
    read_index,
    read_source_tree,
    read_spread,
    rejected_files,
    write_index,
)
from chunkloom.sources.pieces import _piece_reader
from chunkloom.sources.staging import shared_dir, stage
from chunkloom.sources.tree import _reader
from workload import queries
from workload.queries import _writer

TREE = {
    "pkg/__init__.py": b"x = 1\n",
    "pkg/a.py": b"a\r\nb\rdef f():\r\n",
    "pkg/n.txt": b"no",
    "pkg/bad.py": b"\xff\xfe",
    "pkg/blank.py": b" \n",
    "pkg/deep/er/d.py": "é\n".encode(),
    "_priv/p.py": b"p\n",
    ".github/w.py": b"w\n",
    ".git/x/h.py": b"h\n",
    "pkg/.git/y.py": b"y\n",
    "pkg.git/q.py": b"q\n",
    ".py": b"dot\n",
    "A.PY": b"upper\n",
}
KEPT = {
    "pkg/__init__.py", "pkg/a.py", "pkg/bad.py", "pkg/blank.py", "pkg/deep/er/d.py", "_priv/p.py",
    ".github/w.py", "pkg.git/q.py", ".py",
}


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    for name, data in TREE.items():
        target = root / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)
    os.symlink(root, root / "pkg" / "loop")
    return str(root)


def test_listing(spark, tree):
    rows = list_source_tree(spark, tree + "/").collect()
    assert {os.path.relpath(r.path, tree) for r in rows} == KEPT
    assert all(r.length == len(TREE[os.path.relpath(r.path, tree)]) for r in rows)
    assert len(rows) == len(KEPT)


def test_same_choice_on_a_table_of_paths(spark):
    df = spark.createDataFrame([(p,) for p in [*TREE, ".git/z.py", "a.git", "x/.git"]], "path string")
    assert {r.path for r in matching_files(df).collect()} == KEPT


def test_listing_by_address(spark, tree):
    rows = list_source_tree(spark, "file://" + tree + "/pkg.git").collect()
    assert [r.path for r in rows] == ["file://" + tree + "/pkg.git/q.py"]


def test_nothing_inside_git(spark, tree):
    assert list_source_tree(spark, tree + "/.git/x").count() == 0
    with pytest.raises(FileNotFoundError):
        list_source_tree(spark, tree + "/absent")
    assert list_source_tree(spark, tree, suffix=".txt").count() == 1


def test_reading_and_decoding(spark, tree):
    raw = read_source_tree(spark, tree)
    got = {os.path.relpath(r.path, tree): r.content for r in decode_files(raw).collect()}
    want = {
        p: TREE[p].decode().replace("\r\n", "\n").replace("\r", "\n") for p in KEPT - {"pkg/bad.py"}
    }
    assert got == want
    bad = rejected_files(raw).collect()
    assert [(os.path.relpath(r.path, tree), r.error) for r in bad] == [("pkg/bad.py", "not valid UTF-8")]


def test_unreadable_file_is_rejected(spark, tree):
    raw = read_source_tree(spark, tree + "/_priv")
    os.rename(tree + "/_priv/p.py", tree + "/_priv/moved")
    assert decode_files(raw).count() == 0
    (row,) = rejected_files(raw).collect()
    assert row.error.startswith("FileNotFoundError")


def test_dangling_link_and_pipe(spark, tree):
    os.symlink(tree + "/nowhere", tree + "/_priv/dangling.py")
    os.symlink("self.txt", tree + "/_priv/self.txt")
    os.mkfifo(tree + "/_priv/pipe.py")
    raw = read_source_tree(spark, tree + "/_priv")
    assert [r.content for r in decode_files(raw).collect()] == ["p\n"]
    (row,) = rejected_files(raw).collect()
    assert row.path.endswith("dangling.py") and row.error.startswith("FileNotFoundError")


def test_index_of_a_tree(spark, tree):
    index = index_chunks(decode_files(read_source_tree(spark, tree)))
    got = sorted((r.original_file_path, r.chunk_index, r.embedding_id, r.lines, r.status) for r in index.collect())
    want = []
    for p in KEPT - {"pkg/bad.py"}:
        text = TREE[p].decode().replace("\r\n", "\n").replace("\r", "\n")
        full = os.path.join(tree, p)
        want += [(full, *row) for row in models.index(full, text)]
    assert got == sorted(want)


def test_table_and_sink(spark, sf_dir, tmp_path):
    docs = read_spread(spark, f"{sf_dir}/documents.parquet", "doc_id")
    files = from_table(docs, F.concat(F.lit("d/"), F.col("doc_id")), "text")
    index = index_chunks(files)
    folder = str(tmp_path / "index")
    write_index(index, folder)
    write_index(index, folder)
    stored = read_index(spark, folder)
    assert set(stored.columns) == set(index.columns)
    assert stored.count() == 2 * index.count()
    assert "status=processed" in os.listdir(folder)


def test_only_small_tables_are_spread(spark, sf_dir, monkeypatch):
    path = f"{sf_dir}/documents.parquet"
    explain = lambda: read_spread(spark, path, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" in explain()
    monkeypatch.setattr("chunkloom.sources.tables._SPLIT_BYTES", 1)
    assert "Exchange" not in explain()


def test_staging(spark):
    df = spark.range(10).withColumn("r", F.rand())
    staged = stage(df, "t")
    assert sorted(staged.collect()) == sorted(staged.collect())
    assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_dir(spark).removeprefix("file:"))


def test_small_batches(tmp_path):
    """Tasks hold little at a time, however many rows one brings them."""
    content = b"x = 1\n" * 50_000
    (tmp_path / "a.py").write_bytes(content)
    (tmp_path / "empty.py").write_bytes(b"")
    paths = [str(tmp_path / "a.py")] * 40 + [str(tmp_path / "empty.py")] * 12_000
    sizes = [len(content)] * 40 + [0] * 12_000
    listing = pa.RecordBatch.from_arrays(
        [pa.array(paths), pa.array(sizes, pa.int64()), pa.nulls(len(paths), pa.string())], ["path", "length", "error"]
    )
    ranges = pa.RecordBatch.from_arrays(
        [pa.array(paths), pa.array([0] * len(paths), pa.int64()), pa.array(sizes, pa.int64())], ["path", "piece", "length"]
    )
    for got in (list(_reader()(iter([listing]))), list(_piece_reader(1 << 20)(iter([ranges])))):
        assert [p for b in got for p in b.column("path").to_pylist()] == paths
        assert [len(c) for b in got for c in b.column("content").to_pylist()] == sizes
        assert max(b.nbytes for b in got) < 4 << 20
        assert max(b.num_rows for b in got) <= 10_000


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_files_are_written_one_by_one(tmp_path, scheme):
    def rows():
        for k in range(5):
            yield {"path": f"d{k % 2}/e/f{k}.py", "content": bytearray(b"%d" % k)}
            assert (tmp_path / f"d{k % 2}/e/f{k}.py").read_bytes() == b"%d" % k

    _writer(f"{scheme}{tmp_path}")(rows())
    assert len(list(tmp_path.rglob("*.py"))) == 5


def test_long_texts_behind_short_ones_are_written_in_small_batches(spark, tmp_path, monkeypatch):
    """What a task holds depends neither on its rows nor on those before them."""

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def writer(root):
        def write(rows):
            start, most, n = resident(), 0, 0
            for n, row in enumerate(rows, 1):
                most = max(most, resident() - start) if n % 50 == 0 else most
            (tmp_path / "held").write_text(f"{n} {most}")

        return write

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    content = F.when(F.col("id") < 17_000, F.lit("x")).otherwise(F.repeat(F.lit("0123456789"), F.lit(10_000)))
    files = spark.range(0, 19_000, 1, 1).select(
        F.concat("id", F.lit(".py")).alias("path"), content.cast("binary").alias("content")
    )
    monkeypatch.setattr(queries, "_writer", writer)
    queries._write_tree(files, "unused")
    n, most = map(int, (tmp_path / "held").read_text().split())
    assert n == 19_000
    assert most < 100 << 20
    assert spark.conf.get(key) == before


def test_tree_is_written_whole(spark, tmp_path):
    contents = [b"", b"x = 1\n", b"\xff\xfe", b"\x00" * (3 << 20), "# \u00e9\n".encode()]
    files = [(f"d{k % 2}/f{k}.py", bytearray(c)) for k, c in enumerate(contents)]
    queries._write_tree(spark.createDataFrame(files, "path string, content binary"), str(tmp_path))
    assert {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*.py")} == {
        path: bytes(content) for path, content in files
    }
