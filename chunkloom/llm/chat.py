"""Roles of transcript lines by a hidden Markov model, and canonical rendering of turns.

A state is a role and whether the line opens a turn.  A line is seen as its speaker
marker, its length and its last character.  Chances come from counts over a bounded
sample of labelled lines.  Viterbi finds the likeliest states of a whole transcript,
and works in blocks: the best way through a block from each state to each state is a
small matrix, matrices of blocks multiply (maximum and sum) to those of longer
stretches, and once the states at its ends are known each block is decoded on its own.
So a conversation of any length is spread over tasks and the result is exact.

Defined cases: a null text is an empty line; rows with a null conversation id form one
conversation of their own, whose id stays null; ids may have any type that has a text; lines that agree in order keep any order; without
labelled lines all states are equally likely; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.operators.corpus import number_rows
from chunkloom.sources.staging import stage

#: Lines of a block, and blocks of a stretch.
BLOCK = 256
#: About so many labelled lines are learned from, chosen by a hash of the conversation.
SAMPLE = 50_000

# Words that speaker markers use.
SPEAKERS = (
    "user human you customer question q me prompter assistant ai bot answer a model agent gpt "
    "chatbot system instruction instructions context"
).split()
MARKER = r"^\s*(?:[#*<\[|\s-]*)(?i:(" + "|".join(SPEAKERS) + r"))(?:\s*[*>\]|]*\s*[:>\]|]+[*|>\]]*)\s*"
SYMBOLS = ("marker", "size", "last")
SIZES = (len(SPEAKERS) + 1, 12, 4)


def with_symbols(lines: DataFrame, text: str = "text") -> DataFrame:
    """Add what the model sees of a line, and ``body``, the line without its marker."""
    value = F.coalesce(F.col(text), F.lit(""))
    word = F.lower(F.regexp_extract(value, MARKER, 1))
    listed = F.array(*[F.lit(s) for s in SPEAKERS])
    body = F.regexp_replace(value, MARKER, "")
    last = F.substring(F.rtrim(body), -1, 1)
    return lines.select(
        "*",
        body.alias("body"),
        F.array_position(listed, word).cast("int").alias("marker"),
        F.least(F.lit(SIZES[1] - 1), F.floor(F.log2(F.length(body) + 1))).cast("int").alias("size"),
        F.when(last == "", 0).when(last == "?", 1).when(last.isin(".", "!"), 2).otherwise(3).alias("last"),
    )


class Model:
    """Roles, and log-chances of first states, of steps and of symbols."""

    def __init__(self, roles: Sequence[str], counts: Sequence[tuple]):
        """``counts``: ``(before, state, marker, size, last, n)``; before is null at the start."""
        self.roles = list(roles)
        self.states = n = 2 * len(self.roles)
        first, step = np.ones(n), np.ones((n, n))
        seen = [np.full((n, k), 0.5) for k in SIZES]
        for before, state, *symbols, count in counts:
            if before is None:
                first[state] += count
            else:
                step[before, state] += count
            for table, symbol in zip(seen, symbols):
                table[state, symbol] += count
        # A turn goes on within its role, and nothing starts in the middle of one.
        for role in range(len(self.roles)):
            first[2 * role + 1] = 1e-9
            step[np.arange(n) // 2 != role, 2 * role + 1] = 1e-9
        self.first = np.log(first / max(first.sum(), 1e-9))
        self.step = np.log(step / step.sum(axis=1, keepdims=True))
        self.seen = [np.log(t / t.sum(axis=1, keepdims=True)) for t in seen]

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Log-chance of each line in each state."""
        return sum(table[:, symbols[:, k]] for k, table in enumerate(self.seen)).T

    def through(self, symbols: np.ndarray, opens: bool) -> np.ndarray:
        """The best way through a block: from the state before it (row) to its last one."""
        lines = self.emissions(symbols)
        best = np.tile(self.first, (self.states, 1)) if opens else self.step.copy()
        best = best + lines[0]
        for line in lines[1:]:
            best = (best[:, :, None] + self.step[None]).max(axis=1) + line
        return best

    def decode(self, symbols: np.ndarray, before: int | None, at_end: int | None) -> np.ndarray:
        """States of a block's lines, given the one before it and its last if they are known."""
        lines = self.emissions(symbols)
        best = (self.first if before is None else self.step[before]) + lines[0]
        back = np.zeros(lines.shape, dtype=int)
        for t in range(1, len(lines)):
            ways = best[:, None] + self.step
            back[t] = ways.argmax(axis=0)
            best = ways.max(axis=0) + lines[t]
        states = np.zeros(len(lines), dtype=int)
        states[-1] = best.argmax() if at_end is None else at_end
        for t in range(len(lines) - 1, 0, -1):
            states[t - 1] = back[t, states[t]]
        return states


def train(lines: DataFrame, order_by: Sequence[str], sample: int = SAMPLE) -> Model:
    """From ``(conv_id, order columns, text, role, opens)``: ``opens`` tells first lines of turns.

    The driver gets counts, whose number is bounded by states and symbols.
    """
    from pyspark.sql import Window

    share = min(1.0, sample / max(lines.count(), 1))
    chosen = F.pmod(F.xxhash64("conv_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    some = (lines.filter(chosen) if share < 1 else lines).filter("role IS NOT NULL")
    roles = sorted(r[0] for r in some.select("role").distinct().collect())
    listed = F.array(*[F.lit(r) for r in roles]) if roles else F.array(F.lit(""))
    state = 2 * (F.array_position(listed, F.col("role")) - 1) + F.when(F.col("opens"), 0).otherwise(1)
    seen = with_symbols(some).withColumn("state", state.cast("int"))
    numbered = number_rows(
        seen.select("conv_id", *order_by, "state", *SYMBOLS), order_by, within=["conv_id"], name="line"
    ).withColumn("stretch", F.shiftright("line", 12))
    # Cut into stretches, so that no conversation is one large window.
    before = F.lag("state").over(Window.partitionBy("conv_id", "stretch").orderBy("line"))
    counted = (
        numbered.withColumn("before", before)
        .filter("before IS NOT NULL OR line = 0")
        .groupBy("before", "state", *SYMBOLS)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return Model(roles or ["unknown"], [tuple(r) for r in counted.collect()])


def _groups(batches: Iterator, keys: int) -> Iterator:
    """Rows of sorted Arrow batches as ``(key, table)``, one for each run of equal keys."""
    import pyarrow as pa

    held, key = [], None
    for batch in batches:
        names = list(zip(*(batch.column(i).to_pylist() for i in range(keys))))
        start = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[start]:
                if held and key != names[start]:
                    yield key, pa.Table.from_batches(held)
                    held = []
                key = names[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield key, pa.Table.from_batches(held)


def _symbols(table) -> np.ndarray:
    return np.stack([table.column(s).to_numpy() for s in SYMBOLS], axis=1)


def _matrices(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        for (conv, block), table in _groups(batches, 2):
            matrix = model.through(_symbols(table), block == 0)
            yield pa.RecordBatch.from_pydict(
                {"conv_id": [conv], "block": [block], "matrix": [matrix.ravel().tolist()]},
                schema=pa.schema(
                    [("conv_id", pa.string()), ("block", pa.int64()), ("matrix", pa.list_(pa.float64()))]
                ),
            )

    return run


def _products(states: int):
    """Matrix of each stretch of blocks: maxima of sums over the states between."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (conv, stretch), table in _groups(batches, 2):
            total = None
            for values in table.column("matrix").to_pylist():
                m = np.array(values).reshape(states, states)
                total = m if total is None else (total[:, :, None] + m[None]).max(axis=1)
            yield pa.RecordBatch.from_pydict(
                {"conv_id": [conv], "block": [stretch], "matrix": [total.ravel().tolist()]},
                schema=pa.schema(
                    [("conv_id", pa.string()), ("block", pa.int64()), ("matrix", pa.list_(pa.float64()))]
                ),
            )

    return run


def _ends(states: int):
    """States before and at the end of each block of a stretch whose own ends are known."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (conv, _), table in _groups(batches, 2):
            ms = [np.array(v).reshape(states, states) for v in table.column("matrix").to_pylist()]
            before, at_end = table.column("before")[0].as_py(), table.column("at_end")[0].as_py()
            best, back = ms[0][before or 0], []
            for m in ms[1:]:
                ways = best[:, None] + m
                back.append(ways.argmax(axis=0))
                best = ways.max(axis=0)
            path = [int(best.argmax()) if at_end is None else at_end]
            for choice in reversed(back):
                path.append(int(choice[path[-1]]))
            path.reverse()
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": [conv] * len(path),
                    "block": table.column("block").to_pylist(),
                    "before": [before, *path[:-1]],
                    "at_end": path,
                },
                schema=pa.schema(
                    [("conv_id", pa.string()), ("block", pa.int64()), ("before", pa.int32()), ("at_end", pa.int32())]
                ),
            )

    return run


_MATRIX = "conv_id string, block bigint, matrix array<double>"
_END = "conv_id string, block bigint, before int, at_end int"


def _sorted_groups(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, order)


def _block_ends(matrices: DataFrame, states: int) -> DataFrame:
    """``(conv_id, block, before, at_end)`` for every block, stretch by stretch."""
    last = matrices.agg(F.max("block")).first()[0] or 0
    named = matrices.withColumn("stretch", F.floor(F.col("block") / BLOCK).cast("bigint"))
    if last < BLOCK:
        outer = named.withColumn("before", F.lit(None).cast("int")).withColumn("at_end", F.lit(None).cast("int"))
    else:
        upper = stage(
            _sorted_groups(named.select("conv_id", "stretch", "block", "matrix"), ["conv_id", "stretch"], "block")
            .mapInArrow(_products(states), _MATRIX),
            "stretches",
        )
        ends = _block_ends(upper, states).withColumnRenamed("block", "stretch")
        outer = named.join(ends, ["conv_id", "stretch"])
    columns = ["conv_id", "stretch", "block", "matrix", "before", "at_end"]
    solved = _sorted_groups(outer.select(*columns), ["conv_id", "stretch"], "block")
    return stage(solved.mapInArrow(_ends(states), _END), "block-ends")


def _states(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        for (conv, _), table in _groups(batches, 2):
            before, at_end = table.column("before")[0].as_py(), table.column("at_end")[0].as_py()
            found = model.decode(_symbols(table), before, at_end)
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": [conv] * len(found),
                    "line": table.column("line").to_pylist(),
                    "role": [model.roles[s // 2] for s in found],
                    "opens": [s % 2 == 0 for s in found],
                    "text": table.column("text").to_pylist(),
                },
                schema=pa.schema(
                    [("conv_id", pa.string()), ("line", pa.int64()), ("role", pa.string()), ("opens", pa.bool_()), ("text", pa.string())]
                ),
            )

    return run


def _turns(lines: DataFrame) -> DataFrame:
    """Add ``turn``: the number of the line that opened it.

    The latest opening is carried over blocks and over stretches of blocks, so
    that no window is longer than a stretch, or than the stretches of a conversation.
    """
    from pyspark.sql import Window

    opened = F.when(F.col("opens"), F.col("line"))
    lines = lines.withColumn("block", F.floor(F.col("line") / BLOCK)).withColumn("opened", opened)
    upto = lambda *keys: Window.partitionBy(*keys)
    inside = F.max("opened").over(
        upto("conv_id", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    )
    blocks = stage(
        lines.groupBy("conv_id", "block").agg(F.max("opened").alias("latest")).withColumn(
            "stretch", F.floor(F.col("block") / BLOCK)
        ),
        "openings",
    )
    earlier = lambda w, order: w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = F.max("latest").over(earlier(upto("conv_id", "stretch"), "block"))
    far = (
        blocks.groupBy("conv_id", "stretch").agg(F.max("latest").alias("latest"))
        .withColumn("far", F.max("latest").over(earlier(upto("conv_id"), "stretch")))
        .select("conv_id", "stretch", "far")
    )
    carried = stage(
        blocks.withColumn("near", near).join(far, ["conv_id", "stretch"])
        .select("conv_id", "block", F.greatest("near", "far").alias("carried")),
        "carried",
    )
    return lines.withColumn("inside", inside).join(carried, ["conv_id", "block"]).withColumn(
        "turn", F.coalesce("inside", "carried", F.lit(0).cast("bigint"))
    )


def parse_transcripts(lines: DataFrame, order_by: Sequence[str], model: Model) -> DataFrame:
    """``(conv_id, line, turn, role, rendered)`` for lines ``(conv_id, order columns, text)``.

    ``line`` counts from 0 in each conversation and ``turn`` is the line that
    opens the turn.  Rendered lines in order are the canonical transcript:
    ``<|role|>`` stands on a line before each turn, whose marker is gone.  Lines that
    open no turn keep their whole text, also if they look like a marker.
    """
    # Within the operator an id of any type is a text that no null id can equal.
    kind = lines.schema["conv_id"].dataType
    known = lines.withColumn(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    )
    shared = lines.sparkSession.sparkContext.broadcast(model)
    numbered = stage(
        number_rows(with_symbols(known), list(order_by), within=["conv_id"], name="line")
        .withColumn("block", F.shiftright("line", 8))
        .select("conv_id", "block", "line", F.coalesce("text", F.lit("")).alias("text"), *SYMBOLS),
        "lines",
    )
    long = stage(numbered.filter("block > 0").select(F.col("conv_id").alias("long_id")).distinct(), "long")
    split = numbered.join(long, numbered["conv_id"] == long["long_id"], "left_semi")
    matrices = stage(
        _sorted_groups(split.select("conv_id", "block", "line", *SYMBOLS), ["conv_id", "block"], "line")
        .mapInArrow(_matrices(shared), _MATRIX),
        "matrices",
    )
    ends = _block_ends(matrices, model.states)
    decoded = numbered.join(ends, ["conv_id", "block"], "left").select(
        "conv_id", "block", "line", *SYMBOLS, "before", "at_end", "text"
    )
    found = stage(
        _sorted_groups(decoded, ["conv_id", "block"], "line").mapInArrow(
            _states(shared), "conv_id string, line bigint, role string, opens boolean, text string"
        ),
        "states",
    )
    header = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.regexp_replace("text", MARKER, ""))
    own_id = F.when(F.col("conv_id") != "", F.expr("substring(conv_id, 2)")).cast(kind)
    return _turns(found).select(
        own_id.alias("conv_id"), "line", "turn", "role",
        F.when(F.col("opens"), header).otherwise(F.col("text")).alias("rendered"),
    )


# How the speakers of made transcripts are marked.
STYLES = (("User: ", "Assistant: "), ("Q: ", "A: "), ("**Human**: ", "**AI**: "), ("[customer] ", "[agent] "))


def transcripts(conversations: DataFrame) -> DataFrame:
    """Transcript lines ``(conv_id, turn_no, line_no, text, role, opens)`` of a table of turns.

    Each conversation has one of four ways to mark speakers, and one turn in
    seven has lost its marker.  Role and opening are the truth about a line and
    not shown to the parser.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    lost = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(7)) == 0) & (F.col("turn") > 0)
    marker = F.lit("")
    for i, (user, other) in enumerate(STYLES):
        own = F.when(F.col("role") == "user", user).when(F.col("role") == "assistant", other)
        marker = F.when(style == i, own.otherwise(F.concat(F.initcap("role"), F.lit(": ")))).otherwise(marker)
    marker = F.when(lost, "").otherwise(F.coalesce(marker, F.lit("")))
    text = F.concat(marker, F.coalesce("text", F.lit("")))
    return conversations.select(
        "conv_id",
        F.col("turn").alias("turn_no"),
        "role",
        F.posexplode(F.split(text, "\n")).alias("line_no", "text"),
    ).withColumn("opens", F.col("line_no") == 0)
