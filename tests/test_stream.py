import models
from texts import LARGER, SMALL

from chunkloom.functions import fail_when
from chunkloom.streaming import read_file_stream, read_stream_index, stream_index

FIRST = {"a.py": SMALL, "b.py": LARGER}
SECOND = {"c.py": SMALL, "b.py": LARGER, "d.py": "def d():\n    return 4\n"}


def drop(spark, folder, files):
    df = spark.createDataFrame(list(files.items()), "path string, content string")
    df.coalesce(1).write.mode("append").parquet(folder)


def rows(spark, out):
    cols = ["batch_id", "original_file_path", "chunk_index", "embedding_id", "lines", "status"]
    return sorted(map(tuple, read_stream_index(spark, out).select(*cols).collect()), key=str)


def run(spark, tmp_path, checkpoint="progress"):
    query = stream_index(
        read_file_stream(spark, str(tmp_path / "drop"), files_per_batch=1),
        str(tmp_path / "out"),
        str(tmp_path / checkpoint),
        fails=fail_when,
        trigger={"availableNow": True},
    )
    query.awaitTermination()


def expected(batch, files, known=()):
    return [(batch, p, *r) for p, t in files.items() for r in models.index(p, t, known)]


def test_batches_restarts_and_replays(spark, tmp_path):
    drop(spark, str(tmp_path / "drop"), FIRST)
    run(spark, tmp_path)
    want = sorted(expected(0, FIRST), key=str)
    assert rows(spark, str(tmp_path / "out")) == want

    # Nothing new: a restart adds nothing.
    run(spark, tmp_path)
    assert rows(spark, str(tmp_path / "out")) == want

    # A copy of a synced file is cached; a file that failed is sent again.
    drop(spark, str(tmp_path / "drop"), SECOND)
    run(spark, tmp_path)
    known = [models.root(map(models.sha, models.line_chunks(SMALL)))]
    want = sorted(want + expected(1, SECOND, known), key=str)
    assert rows(spark, str(tmp_path / "out")) == want

    # The last batch was not committed: it runs again and gives the same rows.
    (tmp_path / "progress" / "commits" / "1").unlink()
    (tmp_path / "progress" / "commits" / ".1.crc").unlink(missing_ok=True)
    run(spark, tmp_path)
    assert rows(spark, str(tmp_path / "out")) == want


def test_new_checkpoint_keeps_what_another_stream_wrote(spark, tmp_path):
    drop(spark, str(tmp_path / "drop"), {"one.py": SMALL})
    run(spark, tmp_path)
    run(spark, tmp_path, "later")
    index = read_stream_index(spark, str(tmp_path / "out"))
    found = index.groupBy("stream").pivot("status").count().collect()
    # The second stream meets the file again and finds it in sync.
    assert len(found) == 2 and {r.asDict().get("cached") for r in found} == {None, 3}
