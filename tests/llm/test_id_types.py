"""Near copies go whatever the size of the ids; ids that are no numbers are refused."""

import pytest

from chunkloom.llm.near_dedup import near_dedup


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint"])
def test_whole_numbers_of_any_size(spark, kind):
    words = [f"word{i}" for i in range(120)]
    rows = [(i, " ".join([*words, f"end{i}"])) for i in range(5)] + [(9, "another text of a few words")]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    found = near_dedup(docs)
    assert found.schema == docs.schema
    assert sorted(r.doc_id for r in found.collect()) == [0, 9]


def test_strings_are_refused(spark):
    docs = spark.createDataFrame([("1", "a")], "doc_id string, text string")
    with pytest.raises(TypeError):
        near_dedup(docs)
