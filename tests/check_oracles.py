"""Run every query next to its SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def compare(spark, db, sf_dir, name):
    """None when both give the same bag of rows, else what differs."""
    result = entry.queries()[name](spark, sf_dir)
    got = result.toArrow()
    want = db.sql(entry.oracle_sql()[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {got.column_names} and {want.column_names}"
    columns = sorted(got.column_names)

    def bag(t):
        return Counter(zip(*[t.column(c).to_pylist() for c in columns]))

    types = [
        f"{c}: {got.schema.field(c).type} and {want.schema.field(c).type}"
        for c in columns
        if str(got.schema.field(c).type).replace("large_", "")
        != str(want.schema.field(c).type).replace("large_", "")
    ]
    a, b = bag(got), bag(want)
    if a != b:
        return f"{got.num_rows} and {want.num_rows} rows; {list((a - b))[:2]} against {list((b - a))[:2]}"
    if types:
        return "types " + ", ".join(types)
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    bad = 0
    for n in args[1:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, db, sf, n)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{n:24s} {time.time() - start:6.2f}s  {problem or 'ok'}"[:900], flush=True)
    print("failures:", bad)
