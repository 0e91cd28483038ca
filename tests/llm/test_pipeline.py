"""Each stage of the pipeline next to a plain version of it, on its own input."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkloom.llm.quality import score_quality
from chunkloom.sources.staging import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_of_near_copies(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    group = {i: i for i in docs}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, own in sets.items():
        for j in {j for s in own for j in holders[s] if j < i}:
            both = len(own & sets[j])
            if 100 * both >= 75 * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return {i for i in docs if root(i) == i}


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The given tables with more copies, near copies, passages, empty texts and a column."""
    out = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    long = docs.filter("length(text) > 1500").orderBy("doc_id").limit(6).collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id")
    passages = [r.text for r in items.filter(F.size(F.split("text", " ")) >= 20).limit(3).collect()]
    rows = []
    for n, doc in enumerate(long):
        words = doc.text.split(" ")
        rows.append((900_000 + n, doc.text))
        rows.append((900_100 + n, " ".join([*words[:40], "changed", *words[41:]])))
    for n, passage in enumerate(passages):
        rows.append((900_200 + n, f"{long[n].text[:600]} {passage} {long[n].text[700:1300]}"))
    rows += [(900_300, None), (900_301, ""), (900_302, "")]
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = docs.unionByName(more, allowMissingColumns=True).withColumn("digest", F.lit("own"))
    whole.write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage_of in corpus_pipeline.STAGES:
        found = stage(stage_of(spark, docs, folder), name)
        before = {r.doc_id: r.text for r in docs.collect()}
        kept = {r.doc_id for r in found.collect()}
        results[name] = (before, kept)
        if name != "packing":
            assert found.columns == columns
            # What stays is unchanged, the column of its own included.
            assert found.exceptAll(docs).count() == 0
        docs = found
    assert list(results) == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]

    before, kept = results["quality"]
    scored = score_quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert kept == {r.doc_id for r in scored.collect() if r.predicted == 1}
    assert 0 < len(kept) < len(before)

    before, kept = results["exact_dedup"]
    last = {}
    for i, text in before.items():
        last[text or ""] = max(i, last.get(text or "", i))
    assert kept == set(last.values())

    before, kept = results["near_dedup"]
    assert kept == smallest_of_near_copies(before) and len(kept) < len(before)

    before, kept = results["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if r.text]
    known = set().union(*(shingles(t) for t in items if len(WORD.findall(t)) >= 5))
    for i, text in before.items():
        if not shingles(text) & known:
            assert i in kept, "a clean document went"
        if text and any(t in text for t in items if len(WORD.findall(t)) >= 20):
            assert i not in kept, "a passage stayed"

    before, kept = results["packing"]
    pieces = docs.collect()
    assert kept == set(before)
    ends = defaultdict(list)
    for r in pieces:
        ends[r.sequence_id].append((r.offset, r.length))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    starts = defaultdict(list)
    for r in pieces:
        starts[r.doc_id].append((r.piece, r.start, r.length))
    for rows in starts.values():
        at = 0
        for n, (piece, start, length) in enumerate(sorted(rows)):
            assert (piece, start) == (n, at)
            at += length


def test_run_is_its_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage_of in corpus_pipeline.STAGES:
        docs = stage(stage_of(spark, docs, folder), name)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows.select(keys).exceptAll(docs.select(keys)).count() == 0
    assert rows.count() == docs.count() > 0


def test_empty_documents(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
