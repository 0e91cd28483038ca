import models
import pytest
from pyspark.sql import functions as F
from texts import COUNTED, random_texts

from chunkloom.functions import (
    chunk_text,
    content_preview,
    has_text,
    is_boundary,
    line_count,
    newline_count,
    normalize_newlines,
    only_newlines,
    repo_label,
    running_totals,
    split_lines,
)

TEXTS = random_texts(1500) + [t for t, _, _ in COUNTED]


@pytest.fixture(scope="module")
def texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, content string")
    return df.repartition(4).cache()


def column(df, expression):
    return [r.v for r in df.select("id", expression.alias("v")).orderBy("id").collect()]


def test_lines_are_those_of_python(texts):
    assert column(texts, split_lines(F.col("content"))) == [t.splitlines(True) for t in TEXTS]


def test_blank_texts(texts):
    assert column(texts, has_text(F.col("content"))) == [bool(t.strip()) for t in TEXTS]


def test_boundaries(spark):
    lines = sorted({line for t in TEXTS for line in t.splitlines(True)})
    df = spark.createDataFrame(list(enumerate(lines)), "id int, content string")
    expected = [bool(models.HEADER.match(line.strip())) for line in lines]
    assert column(df, is_boundary(F.col("content"))) == expected
    assert any(expected) and not all(expected)


def test_boundary_of_texts_with_several_lines(texts):
    expected = [bool(models.HEADER.match(t.strip())) for t in TEXTS]
    assert column(texts, is_boundary(F.col("content"))) == expected


@pytest.mark.parametrize(
    "line, expected",
    [
        ("def f():", True),
        ("class A(B):", True),
        ("def f(a: int) -> int:", True),
        ("class of things: x", True),
        ("def f(a, b) -> int:", False),
        ("async def f():", False),
        ("def f(x=g()):", False),
        ("def f(a,", False),
    ],
)
def test_boundary_table(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(is_boundary(F.col("line"))).first()[0] is expected


def test_line_mode(texts):
    got = column(texts, chunk_text(F.col("content")))
    assert got == [models.line_chunks(t) for t in TEXTS]
    for text, chunks in zip(TEXTS, got):
        assert "".join(chunks) == (text if text.strip() else "")


def test_line_mode_with_a_pattern_is_the_same(texts):
    pattern = r"(?:class\s+[\p{L}\p{N}_]+\s*\(?[^)]*\)?:|def\s+[\p{L}\p{N}_]+\s*\(?[^)]*\)?:)"
    simple = [t for t in TEXTS if not any(c in t for c in "\u00a0\u3000\x1f\x1c\x1d\x1e\x85\u2028")]
    df = texts.filter(F.col("content").isin(simple[:400]))
    a = column(df, chunk_text(F.col("content"), pattern=pattern))
    assert a == column(df, chunk_text(F.col("content")))


def test_top_level_mode(texts):
    got = column(texts, chunk_text(F.col("content"), mode="top_level"))
    assert got == [models.top_level_chunks(t) for t in TEXTS]


def test_counts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(COUNTED)], "id int, content string")
    assert column(df, F.size(chunk_text(F.col("content")))) == [n for _, n, _ in COUNTED]
    top = F.size(chunk_text(F.col("content"), mode="top_level"))
    assert column(df, top) == [n for _, _, n in COUNTED]


def test_unknown_mode():
    with pytest.raises(ValueError):
        chunk_text(F.lit("x"), mode="tree")


def test_long_lines_and_many_lines_stay_linear(spark):
    long_name = "def " + "a" * 300_000
    many = "# note\n" * 60_000 + "x = 1\n"
    defs = "def f():\n" * 30_000
    df = spark.createDataFrame([(0, long_name), (1, many), (2, defs)], "id int, content string")
    assert column(df, F.size(chunk_text(F.col("content")))) == [1, 1, 30_000]
    top = F.size(chunk_text(F.col("content"), mode="top_level"))
    assert column(df, top) == [1, 1, 30_000]


def test_counts_of_lines(texts):
    content = F.col("content")
    assert column(texts, newline_count(content)) == [t.count("\n") for t in TEXTS]
    assert column(texts, line_count(content)) == [len(t.splitlines()) for t in TEXTS]
    plain = [t.count("\n") == sum(len((x + ".").splitlines()) - 1 for x in [t]) and "\r" not in t for t in TEXTS]
    assert column(texts, only_newlines(content)) == plain


def test_newlines_are_normalised(texts):
    expected = [t.replace("\r\n", "\n").replace("\r", "\n") for t in TEXTS]
    assert column(texts, normalize_newlines(F.col("content"))) == expected


def test_preview(texts):
    expected = [t[:50].replace("\n", " ") + "..." for t in TEXTS]
    assert column(texts, content_preview(F.col("content"))) == expected


def test_repo_label(spark):
    cases = [
        ("https://h/u/click.git", "click"),
        ("a.git.git", "a_git"),
        ("https://h/u/x/", ""),
        (None, "unknown_repo"),
        ("", "unknown_repo"),
        ("h/é-b_1.x", "é-b_1_x"),
        (".git", ""),
    ]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(cases)], "id int, url string")
    assert column(df, repo_label(F.col("url"))) == [x for _, x in cases]


def test_running_totals(spark):
    arrays = [[], [5], [1, 2, 3], list(range(1, 11)), [7] * 101, list(range(1, 400))]
    df = spark.createDataFrame(list(enumerate(arrays)), "id int, xs array<int>")
    expected = [[sum(a[:i]) for i in range(len(a))] for a in arrays]
    assert column(df, running_totals(F.col("xs"))) == expected
