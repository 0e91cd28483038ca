"""A cache stored by hash, and roots that cannot be read."""

import pytest

from chunkloom.operators import pending_chunks, reuse_embeddings, store_cache
from chunkloom.sources import list_source_tree, read_source_tree, read_tree_pieces

CHUNKS = "path string, chunk_index int, chunk_hash string, chunk string"


def test_only_the_chunks_shuffle(spark, tmp_path):
    rows = [(f"p{i}", 0, f"h{i % 7}", f"text {i % 7}") for i in range(40)]
    chunks = spark.createDataFrame(rows, CHUNKS)
    cache = spark.createDataFrame([("h1", "e2"), ("h1", "e1"), ("h3", None), (None, "e4")], "chunk_hash string, embedding string")
    want = sorted(map(tuple, reuse_embeddings(chunks, cache.filter("chunk_hash IS NOT NULL")).collect()), key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = store_cache(cache, "stored_cache_test", str(tmp_path / "cache"))
        assert table.count() == 2
        reused = reuse_embeddings(chunks, table)
        plan = reused._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert sorted(map(tuple, reused.collect()), key=str) == want
        assert sorted(r.chunk_hash for r in pending_chunks(chunks, table).collect()) == ["h0", "h2", "h4", "h5", "h6"]
        # Stored anew, the table holds the new rows only.
        again = store_cache(spark.createDataFrame([("h0", "e")], cache.schema), "stored_cache_test", str(tmp_path / "cache2"))
        assert [tuple(r) for r in again.collect()] == [("h0", "e")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS stored_cache_test")


@pytest.mark.parametrize("root", ["s3a://bucket/tree", "ftp://host/tree", "http://host/tree"])
def test_other_schemes_are_refused_at_once(spark, root):
    for read in (list_source_tree, read_source_tree, read_tree_pieces):
        with pytest.raises(ValueError, match="cannot be read"):
            read(spark, root)
