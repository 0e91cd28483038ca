import models
import pytest
from pyspark.sql import functions as F
from texts import LARGER, SMALL, random_texts

from chunkloom.functions import fail_when
from chunkloom.operators import chunk, explode_chunks, fingerprint, line_spans, sync
from chunkloom.operators.sync import SIMULATED_KNOWN_ROOTS
from chunkloom.plans import index_chunks, merge_indexes, summary

FILES = {"shop.py": SMALL, "lib/stock.py": LARGER, "blank.py": " \n", "copy.py": SMALL}
FILES |= {f"r/{i}.py": t for i, t in enumerate(random_texts(150, seed=5))}


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame(list(FILES.items()), "path string, content string").cache()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_by_path(index):
    got = {}
    for r in index.collect():
        row = (r.chunk_index, r.embedding_id, r.lines, r.status)
        got.setdefault(r.original_file_path, []).append(row)
        assert r.obfuscated_file_path == models.pseudonym(r.original_file_path)
    return {p: sorted(rows) for p, rows in got.items()}


def expected(known=()):
    found = {p: models.index(p, t, known) for p, t in FILES.items()}
    return {p: rows for p, rows in found.items() if rows}


def root_of(text):
    return models.root(map(models.sha, models.line_chunks(text)))


def test_nothing_known(files):
    assert rows_by_path(index_chunks(files, fails=fail_when)) == expected()


def test_known_roots(spark, files):
    known = [root_of(SMALL), root_of(LARGER), root_of(SMALL), "unrelated"]
    got = rows_by_path(index_chunks(files, spark.createDataFrame([(k,) for k in known], "root_hash string"), fails=fail_when))
    assert got == expected(known)
    assert rows_by_path(index_chunks(files, known, fails=fail_when)) == got
    assert {s for rows in got.values() for _, _, _, s in rows} == {"cached", "failed", "processed"}


def test_columns(files):
    index = index_chunks(files, fails=fail_when, true_lines=True)
    assert index.columns[:7] == [
        "original_file_path", "obfuscated_file_path", "chunk_index", "content_preview",
        "embedding_id", "lines", "status",
    ]
    assert set(index.columns[7:]) == {
        "start_line", "end_line", "true_start", "true_end", "chunk_hash", "root_hash",
    }


def test_other_key_mode_pattern_and_failure(files):
    default = index_chunks(files, fails=fail_when)
    other = index_chunks(files, key="k2", mode="top_level", fails=lambda c: F.length(c) > 40)
    assert other.filter("status = 'failed'").filter(F.length("content_preview") < 40).count() == 0
    assert other.count() < default.count()
    ruby = index_chunks(files, pattern=r"(?:module|end)\b")
    assert ruby.filter("original_file_path = 'shop.py'").count() == 1


def test_spans(files):
    rows = explode_chunks(line_spans(chunk(files)), "spans").collect()
    got = {}
    for r in rows:
        got.setdefault(r.path, {})[r.chunk_index] = (r.start_line, r.end_line, r.true_start, r.true_end)
    want = {p: dict(enumerate(models.spans(models.line_chunks(t)))) for p, t in FILES.items()}
    assert got == {p: s for p, s in want.items() if s}
    reported = explode_chunks(line_spans(chunk(files), true=False), "spans")
    assert "true_start" not in reported.columns
    assert {(r.path, r.chunk_index): (r.start_line, r.end_line) for r in reported.collect()} == {
        (p, i): s[:2] for p, spans in got.items() for i, s in spans.items()
    }


def test_summary_and_merge(files):
    index = index_chunks(files, fails=fail_when)
    first = summary(index).filter("file = 'lib/stock.py' and chunk = 0").first()
    hidden = models.pseudonym("lib/stock.py")[:20] + "..."
    assert tuple(first)[:3] == ("lib/stock.py", 0, hidden)
    assert merge_indexes(index, index, index.drop("lines")).count() == 3 * index.count()


def test_flagship_neither_shuffles_nor_runs_python(spark, files, tmp_path):
    files.write.parquet(str(tmp_path / "files"))
    stored = spark.read.parquet(str(tmp_path / "files"))
    text = plan(index_chunks(stored, true_lines=True))
    assert "Exchange" not in text and "Python" not in text
    # One CASE with a usual and a rare branch: each file is split once.
    assert text.count("split(content") == 2 and text.count("ELSE split(content") == 1
    assert "PushedFilters: [IsNotNull(content)]" in text


def test_known_side_is_broadcast_or_shuffled_by_its_size(spark, files):
    known = spark.createDataFrame([(root_of(SMALL),), (root_of(SMALL),)], "root_hash string")
    roots = fingerprint(chunk(files)).select("path", "root_hash")
    small = sync(roots, known)
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sync(roots, known)
        assert "SortMergeJoin" in plan(large)
        assert sorted(small.collect()) == sorted(large.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.path for r in small.filter("not needs_resync").collect()} == {"shop.py", "copy.py"}


def test_long_list_of_roots_becomes_a_table(spark, files):
    roots = fingerprint(chunk(files)).select("path", "root_hash")
    listed = [f"none-{i}" for i in range(500)] + [root_of(SMALL)]
    assert {r.path for r in sync(roots, listed).filter("not needs_resync").collect()} == {"shop.py", "copy.py"}


def test_simulated_service(spark):
    df = spark.createDataFrame([("a", "UNKNOWN_HASH_123"), ("b", "SIMULATED_KNOWN_HASH"), ("c", None)], "path string, root_hash string")
    assert [r.needs_resync for r in sync(df, SIMULATED_KNOWN_ROOTS).orderBy("path").collect()] == [True, False, True]
