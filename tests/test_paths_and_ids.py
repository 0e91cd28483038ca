import models
from pyspark.sql import functions as F

from chunkloom.functions import (
    cached_id,
    deobfuscate_path,
    embedding_id,
    fail_when,
    line_label,
    obfuscate_path,
)

PATHS = [
    "src/file.py", "my_segment", "/abs/path/x.py", "trailing/", "a//b", "日本/é.py", "x" * 200,
    "y" * 31 + "/" + "z" * 32 + "/" + "w" * 33, "/".join("abcdefghij") + "/k.rs", "12345678", "/", "a b",
    "\U0001f600/f", "", None,
]


def test_golden(spark):
    df = spark.createDataFrame([("src/file.py",), ("my_segment",)], "p string")
    got = [r[0] for r in df.select(obfuscate_path(F.col("p"))).collect()]
    assert got == ["fv0u/a-Yh59LQqQ==", "YPYS8ZnHvb-1Ag=="]


def test_pseudonyms_and_back(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string")
    for key in (models.KEY, "other"):
        rows = df.select("p", obfuscate_path(F.col("p"), key).alias("o")).collect()
        assert [r.o for r in rows] == [models.pseudonym(p, key) for p in PATHS]
        back = spark.createDataFrame(rows).select("p", deobfuscate_path(F.col("o"), key).alias("b"))
        assert all(r.b == (r.p or "") for r in back.collect())


def test_key_matters_and_a_wrong_key_does_not_fail(spark):
    df = spark.createDataFrame([("notes/2024/week 7.md",)], "p string")
    a, b = df.select(obfuscate_path(F.col("p"), "key1"), obfuscate_path(F.col("p"), "key2")).first()
    assert a != b
    wrong = df.select(deobfuscate_path(obfuscate_path(F.col("p"), "key1"), "key2")).first()[0]
    assert wrong is None


def test_what_is_no_pseudonym_gives_null(spark):
    df = spark.createDataFrame([("A/fv0u",), ("fv0u/!!!!",), ("fv0u",)], "p string")
    got = [r[0] for r in df.select(deobfuscate_path(F.col("p"))).collect()]
    assert got == [None, None, "src"]


def test_ids(spark):
    df = spark.createDataFrame([("def f():\n    pass", "HIDDEN", 1, 2)], "c string, p string, s int, e int")
    c, p, s, e = (F.col(x) for x in "cpse")
    row = df.select(embedding_id(c, p, s, e), cached_id(c, p, s), line_label(s, e)).first()
    text = "def f():\n    passHIDDEN"
    assert tuple(row) == (models.sha(text + "12")[:16], models.sha(text + "1")[:16], "1-2")


def test_failures(spark):
    texts = ["an erro", "ERRO", "Error", "err o", "", "fine"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fail_when(F.col("t"))).collect()]
    assert got == ["erro" in t.lower() for t in texts]
