"""Best-fit packing of documents into sequences of bounded length, planned on counts.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` numbers
whatever the corpus.  Best fit decreasing runs over counts, all sequences of one
shape at a time, and gives a table of slots: pieces of a length with ranks from
``low`` go to consecutive sequences.  Pieces then take their slots by joining on
length and rank within the length.

Ranks come without one task per length: rows are numbered where they lie, and the
rows before them from counts per stored file part, so a length that a third of all
pieces share is spread like any other.

Defined cases: a null text is an empty one, its single piece is the end id; ids may
be null or repeated, each row is a document of its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.sources.staging import stage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: So many words and pieces of words are remembered by a worker, about 200 MB; then it begins anew.
REMEMBERED = 1_000_000

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Token ids of texts as little-endian 32-bit integers, by way of their words.

    The tokenizer drops white space and never joins what it separates, nor
    letters and punctuation, so the ids of a text are those of its words, and
    of the pieces of these, one after the other.  Ids of words and pieces are
    remembered together, as a piece is a word too.  Pieces of letters alone need
    no more than lower case and merges, so they go straight to the tokenizer's
    model.  Texts that hold the spelling of an added token are encoded whole.
    """

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        # Words of ASCII and Latin-1 letters with punctuation around them; any other
        # word (digits, apostrophes, other scripts) is left to the tokenizer as it is.
        letters = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
        marks = r"[!-&(-/:-@\[-`{-~]*"
        self.plain = re.compile(f"({marks})([{letters}]+)({marks})")
        # The model reads each byte of UTF-8 as the character that stands for it.
        as_bytes = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = {
            code: "".join(part for part, _ in as_bytes(chr(code)))
            for code in range(0xDF, 0x100)
            if code != 0xF7
        }

    def _encode(self, pieces: list[str]) -> None:
        import numpy as np

        for start in range(0, len(pieces), 512):
            part = pieces[start : start + 512]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.asarray(found.ids, dtype="<u4")
            ends = np.searchsorted(np.asarray(found.word_ids, dtype=np.int64), np.arange(len(part) + 1))
            data, ends = ids.tobytes(), (4 * ends).tolist()
            self.known.update(zip(part, [data[a:b] for a, b in zip(ends, ends[1:])]))

    def _merge(self, pieces: list[str]) -> None:
        """Learn pieces of lower-case letters."""
        import numpy as np

        merged, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for piece in pieces:
            spelled = piece if piece.isascii() else piece.translate(self.spelling)
            ids.extend([token.id for token in merged(spelled)])
            ends.append(4 * len(ids))
        data = np.asarray(ids, dtype="<u4").tobytes()
        self.known.update(zip(pieces, [data[a:b] for a, b in zip(ends, ends[1:])]))

    def _learn(self, words: set[str]) -> None:
        letters, other, split = set(), set(), []
        for word in words:
            if word.isascii() and word.isalpha():
                parts = ("", word.lower(), "")
            elif m := self.plain.fullmatch(word):
                parts = (m[1], m[2].lower(), m[3])
            else:
                other.add(word)
                continue
            letters.add(parts[1])
            if parts[1] != word:
                other.add(parts[0])
                other.add(parts[2])
                split.append((word, parts))
        self._merge(list(letters.difference(self.known)))
        self._encode(list(other.difference(self.known)))
        get = self.known.__getitem__
        self.known.update([(word, b"".join(map(get, parts))) for word, parts in split])

    def __call__(self, texts: list[str]) -> list[bytes]:
        # Cut at four characters that are white space for any tokenizer; other kinds
        # stay within words and are left to it.
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        seen = set().union(*split)
        new = seen.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {"": b""}, seen
        self._learn(new)
        get = self.known.__getitem__
        found = [b"".join(map(get, words)) for words in split]
        for i, text in enumerate(texts):
            if any(x in text for x in self.added):
                import numpy as np

                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                found[i] = np.asarray(ids, dtype="<u4").tobytes()
        return found


#: Kept between the tasks of a worker.
_ENCODERS: dict[str, WordIds] = {}


def _pieces(path: str, capacity: int):
    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        from chunkloom.llm import packing

        encode = packing._ENCODERS.get(path) or packing._ENCODERS.setdefault(path, WordIds(path))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, rows = [], []
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, found in zip(batch.column(0).to_pylist(), encode(texts)):
                    data = found + b"\0\0\0\0"
                    for piece, start in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[start : start + 4 * capacity]
                        ids.append(doc_id)
                        rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.column(0).type),
                        pa.array(columns[0], pa.int32()),
                        *[pa.array(c, pa.int64()) for c in columns[1:]],
                    ],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Slots for ``counts`` pieces of each length, and the number of sequences.

    A slot row is ``(length, low, high, sequence, each, offset)``: pieces with
    ranks from ``low`` to before ``high`` go to sequences from ``sequence`` on,
    ``each`` of them to a sequence, beginning at ``offset``.  Longest first, each
    piece goes where it leaves the least room, and all sequences that look alike
    are filled in one step.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, how many)
    slots, sequences = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        fits = sorted(r for r in room if r >= length)
        while left:
            if fits:
                free = fits[0]
                first, n = room[free].pop()
                if not room[free]:
                    del room[free]
                    fits.pop(0)
            else:
                free, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = free // length
            full = min(n, left // each)  # sequences that take as many as fit
            rest = left - full * each if full < n else 0  # and one that takes what is left
            for begin, many, per in ((first, full, each), (first + full, 1, rest)):
                if many and per:
                    slots.append((length, rank, rank + many * per, begin, per, capacity - free))
                    rank += many * per
                    left -= many * per
                    if after := free - per * length:
                        room.setdefault(after, []).append((begin, many))
            used = full + bool(rest)
            if used < n:
                room.setdefault(free, []).append((first + used, n - used))
    return slots, sequences


def _ranked(pieces: DataFrame) -> DataFrame:
    """Add ``rank``, from 0 without gaps within each length."""
    rows = stage(
        pieces.sortWithinPartitions("length").withColumn("_row", F.monotonically_increasing_id()),
        "pieces",
    ).withColumn("_part", F.shiftright("_row", 33))
    counts = stage(
        rows.groupBy("length", "_part").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
        ),
        "piece-counts",
    )
    # One row for each length and part of the table, not for each piece.
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length",
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
    )
    return (
        rows.join(stage(bases, "piece-bases"), ["length", "_part"])
        .withColumn("rank", F.col("_base") + F.col("_row"))
        .drop("_part", "_row", "_base")
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """A row for each piece: ``(id, piece, start, length, ids_crc32, sequence_id, offset)``.

    Documents are encoded by the tokenizer at ``path`` and end with id 0; only
    those of more than ``capacity`` ids are cut.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    pieces = read.mapInArrow(_pieces(path or tokenizer_path(), capacity), f"id {kind}, {PIECES}")
    ranked = _ranked(pieces)
    histogram = ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    slots, _ = plan({r["length"]: r["n"] for r in histogram}, capacity)
    schema = "length bigint, low bigint, high bigint, sequence bigint, each bigint, begin bigint"
    # The plan depends on the lengths there are and not on how many documents have them.
    table = F.broadcast(spark.createDataFrame(slots, schema))
    nth = F.col("rank") - F.col("low")
    return (
        ranked.join(table, "length")
        .filter("rank >= low AND rank < high")
        .select(
            F.col("id").alias(id_col),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("sequence") + F.expr("(rank - low) div each")).alias("sequence_id"),
            (F.col("begin") + nth % F.col("each") * F.col("length")).alias("offset"),
        )
    )
