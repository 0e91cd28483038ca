"""Files read and chunked in pieces against whole files."""

import io
import random

import pytest
from pyspark.sql import functions as F

from chunkloom.operators import chunk, chunk_pieces, explode_chunks, line_spans
from chunkloom.sources import (
    decode_files,
    decode_pieces,
    read_source_tree,
    read_tree_pieces,
    rejected_files,
    rejected_pieces,
)
from chunkloom.sources.pieces import line_start

LINES = ["def f():", "class A(B):", "  def g(self):", "x = 1", "", "é y", "\x0b", "# note", "y" * 90, "\t"]


def texts(rng):
    found = {}
    for i in range(40):
        ends = rng.choice([["\n"], ["\r\n"], ["\r"], ["\n", "\r\n", "\r"]])
        lines = rng.choices(LINES, k=rng.randrange(0, 40))
        found[f"d{i % 5}/f{i}.py"] = "".join(x + rng.choice(ends) for x in lines) + rng.choice(["", "tail", "def z():"])
    found |= {"empty.py": "", "blank.py": " \n" * 50, "long.py": "z" * 700, "late.py": "\n" * 300 + "def a():\n"}
    return {name: text.encode() for name, text in found.items()}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("pieces")
    files = texts(random.Random(6)) | {"bad.py": b"ok = 1\n" * 40 + b"\xff\n" + b"ok = 2\n" * 40}
    for name, data in files.items():
        target = root / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(data)
    return str(root)


def test_line_start():
    rng = random.Random(3)
    for _ in range(200):
        data = b"".join(rng.choice([b"a", b"bc", b"\n", b"\r", b"\r\n"]) for _ in range(40))
        starts, place = [0], 0
        for line in data.decode().splitlines(keepends=True):
            place += len(line)
            starts.append(place)
        for at in range(len(data) + 1):
            assert line_start(io.BytesIO(data), at, len(data)) == min([s for s in starts if s >= at], default=len(data))


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_pieces_equal_whole_files(spark, tree, size):
    raw = read_tree_pieces(spark, tree, piece_bytes=size).cache()
    whole = read_source_tree(spark, tree)
    joined = raw.filter("content IS NOT NULL").orderBy("path", "piece").collect()
    contents = {}
    for r in joined:
        contents[r.path] = contents.get(r.path, b"") + bytes(r.content)
    assert contents == {r.path: bytes(r.content) for r in whole.collect()}
    want = explode_chunks(line_spans(chunk(decode_files(whole))), "spans")
    got = chunk_pieces(decode_pieces(raw))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(rejected_pieces(raw)) == rows(rejected_files(whole)) != []


def test_odd_pieces(spark):
    rows = [("a", 3, "x\n"), ("a", 9, None), ("a", 10, "def f():\n"), ("a", 12, "y\n"), ("b", 0, None), ("c", 0, " \n")]
    df = spark.createDataFrame(rows, "path string, piece bigint, content string")
    got = sorted(map(tuple, chunk_pieces(df).collect()))
    assert got == [("a", 0, "x\n", 1, 2, 1, 1), ("a", 1, "def f():\ny\n", 3, 5, 2, 3)]
    assert chunk_pieces(df.limit(0)).count() == 0


def test_text_takes_no_part_in_windows(spark, monkeypatch):
    from chunkloom.operators import pieces as module

    plans = []
    stage = module.stage

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(module, "stage", seen)
    df = spark.createDataFrame([("a", 0, "x\n")], "path string, piece bigint, content string")
    result = chunk_pieces(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in dict(plans)["piece-offsets"] and "Window" not in result
    window = dict(plans)["piece-offsets"].split("Window")[1].splitlines()[0]
    assert "content" not in window and "chunks#" not in window.replace("chunks_before", "")


def test_rows_are_spread(spark, tree):
    raw = read_tree_pieces(spark, tree, piece_bytes=64)
    assert raw.filter(F.col("path").endswith("late.py")).count() > 3
