"""Periodic runs of words in texts, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with a smallest period q that no neighbouring
word extends, at least ``LEAST_LENGTH`` words and ``LEAST_PERIODS`` periods long.  Words
q apart are equal all through it, so it holds a pair ``(i, i + q)`` of equal words with i
on the grid of multiples of ``(LEAST_PERIODS - 1) * q``; the grids of all periods together
have n log n points.  From each pair the longest common extensions forward and backward
give the whole stretch.

Extensions compare few words: a difference cover modulo ``COVER`` holds, for any two
places, a shift of less than ``COVER`` words that takes both to sampled places.  Pairs
that are still equal there get the rest from the sorted suffixes of sampled places: the
least common prefix between two ranks, by a sparse table.  Only texts in which a pair
is equal for ``COVER`` words have suffixes sorted, and only those of sampled places.

Texts are taken many at a time, one after the other with a separator of its own after
each, so that no run or extension crosses from one to the next; a text is always whole.

Defined cases: a null or empty text, and one of white space, has no words and no runs;
ids may be null or repeated, each row is a text of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words and so many periods.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: Words that are handled at a time; a longer text is handled alone.
WORDS = 400_000
#: A perfect difference cover, every residue is a difference of two members.
COVER = 31
MEMBERS = (1, 5, 11, 24, 25, 27)

RESULT = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs string, collapsed string"


def _shifts() -> np.ndarray:
    """The least shift that takes residues a and b both into the cover."""
    member = np.zeros(COVER, bool)
    member[list(MEMBERS)] = True
    found = np.full((COVER, COVER), -1, np.int64)
    residue = np.arange(COVER)
    for shift in range(COVER - 1, -1, -1):
        inside = member[(residue + shift) % COVER]
        found[inside[:, None] & inside[None, :]] = shift
    return found


SHIFTS = _shifts()


def _few(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words are equal from places i and j on, up to ``most``."""
    found = np.zeros(len(i), np.int64)
    alive = np.flatnonzero(most > 0)
    step = 0
    while len(alive):
        alive = alive[words[i[alive] + step] == words[j[alive] + step]]
        step += 1
        found[alive] = step
        alive = alive[most[alive] > step]
    return found


def _padded(words: np.ndarray) -> np.ndarray:
    """Words and a number that differs from all; comparisons never pass the last word."""
    return np.concatenate((words.astype(np.int32), np.full(2 * COVER, -1, np.int32)))


class Extensions:
    """Longest common extensions to the right in an array of word numbers.

    The last word of the array must stand nowhere else in it.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = _padded(words)
        self._sort()

    def _sort(self) -> None:
        """Ranks of sampled suffixes, and the sparse table of common prefixes of neighbours."""
        starts = np.arange(0, self.n, COVER)[:, None] + np.array(MEMBERS)
        places = np.sort(starts.ravel())
        places = places[places < self.n]
        slot = np.full(self.n + 2 * COVER, len(places), np.int64)  # the last slot: past the end
        slot[places] = np.arange(len(places))
        grams = np.lib.stride_tricks.sliding_window_view(self.words, COVER)[places]
        keys = np.ascontiguousarray(grams).view(f"V{4 * COVER}").ravel()
        order = np.argsort(keys, kind="stable")
        fresh = np.concatenate(([True], (grams[order[1:]] != grams[order[:-1]]).any(axis=1)))
        rank = np.full(len(places) + 1, -1, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        levels, step = [rank], COVER  # levels[k] ranks by the first COVER * 2**k words
        while not fresh.all():
            after = rank[slot[np.minimum(places + step, self.n)]]
            order = np.lexsort((after, rank[:-1]))
            one, two = rank[order], after[order]
            fresh = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
            rank = np.full(len(places) + 1, -1, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            levels.append(rank)
            step *= 2
        left, right = places[order[:-1]], places[order[1:]]
        common = np.zeros(max(len(places) - 1, 0), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            a, b = (levels[k][slot[np.minimum(x + common, self.n)]] for x in (left, right))
            common += np.where((a == b) & (a >= 0), COVER << k, 0)
        if len(common):
            common += _few(self.words, left + common, right + common, np.full(len(common), COVER))
        self.rank, self.slot = rank, slot
        self.least = [common]
        while (width := 1 << len(self.least)) <= len(common):
            half = self.least[-1]
            self.least.append(np.minimum(half[: len(common) - width + 1], half[width // 2 :][: len(common) - width + 1]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common extensions of places ``i < j``."""
        shift = SHIFTS[i % COVER, j % COVER]
        found = _few(self.words, i, j, shift)
        deep = np.flatnonzero(found == shift)
        if len(deep):
            at = [self.rank[self.slot[x[deep] + shift[deep]]] for x in (i, j)]
            low, high = np.minimum(*at), np.maximum(*at)
            found[deep] += self._between(low, high)
        return found

    def _between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of the common prefixes from rank ``low`` to rank ``high``."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            some = np.flatnonzero(level == k)
            table = self.least[k]
            found[some] = np.minimum(table[low[some]], table[high[some] - (1 << k)])
        return found


def _grid(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(i, period)`` of equal words of one text on the grids of all its periods.

    ``sizes`` are the lengths of the texts with their separators.
    """
    n = len(words)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    places, periods = [], []
    for q in range(1, int(sizes.max() - 1) // LEAST_PERIODS + 1):
        step = (LEAST_PERIODS - 1) * q
        at = np.flatnonzero(words[: n - q : step] == words[q::step])
        at = at[of[at * step] == of[at * step + q]]  # copies among texts are no repeats
        if len(at):
            places.append(at * step)
            periods.append(np.full(len(at), q, np.int64))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _extended(words: np.ndarray, ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common extensions of places ``i < j`` of the same text.

    ``ends`` are the places after each text's separator.  Suffixes are sorted
    for the texts that hold a pair with ``COVER`` equal words.
    """
    found = _few(_padded(words), i, j, np.full(len(i), COVER))
    deep = np.flatnonzero(found == COVER)
    if not len(deep):
        return found
    of = np.searchsorted(ends, i[deep], side="right")
    texts = np.unique(of)
    starts = np.concatenate(([0], ends))[texts]
    sizes = ends[texts] - starts
    moved = np.cumsum(sizes) - sizes  # where these texts begin, one after the other
    places = np.arange(sizes.sum()) + np.repeat(starts - moved, sizes)
    shift = (moved - starts)[np.searchsorted(texts, of)] + COVER
    found[deep] += Extensions(words[places])(i[deep] + shift, j[deep] + shift)
    return found


def find_runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``(start, end, period)`` of all runs, by start and period.

    ``words`` are numbers from 0 on, text after text; the last word of each, before
    the place in ``ends``, is a separator that stands nowhere else.
    """
    sizes = np.diff(ends, prepend=0)
    place, period = _grid(words, sizes)
    ahead = _extended(words, ends, place, place + period)
    # Texts backwards, each with its separator behind it as before.
    last = np.repeat(ends + ends - sizes - 2, sizes)  # place + mirror of each word
    mirror = last - np.arange(len(words))
    mirror[ends - 1] = ends - 1
    behind = np.zeros(len(place), np.int64)
    inner = np.flatnonzero(np.isin(place, ends - sizes, invert=True))  # not the first word of a text
    one, two = mirror[place[inner] - 1], mirror[place[inner] + period[inner] - 1]
    behind[inner] = _extended(words[mirror], ends, two, one)
    start, end = place - behind, place + period + ahead
    long = end - start >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
    found = np.stack((start, end, period), axis=1)[long]
    # A multiple of the smallest period gives the same stretch once more.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        fresh = np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))
        found = found[fresh]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found


def best_run(runs: list) -> tuple:
    """The run of the greatest length / period; ties go to the least start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if (run[1] - run[0]) * best[2] > (best[1] - best[0]) * run[2]:
            best = run
    return best


def _described(texts: list[list[bytes]]) -> list[tuple]:
    """A result row for each text, given as its words."""
    import pyarrow as pa

    sizes = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
    numbers = np.zeros(ends[-1], np.int64)
    separator = np.zeros(ends[-1], bool)
    separator[ends - 1] = True
    numbers[~separator] = flat.indices.to_numpy()
    numbers[ends - 1] = len(flat.dictionary) + np.arange(len(texts))
    found = find_runs(numbers, ends)
    of = np.searchsorted(ends, found[:, 0], side="right")
    first = ends - sizes - 1
    mark = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(mark, found[:, 0] + found[:, 2], 1)
    np.add.at(mark, found[:, 1], -1)
    stays = np.cumsum(mark) == 0
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    rows = []
    for k, words in enumerate(texts):
        if bounds[k] == bounds[k + 1]:
            rows.append((0, None, None, None, None, "", b" ".join(words).decode()))
            continue
        runs = (found[bounds[k] : bounds[k + 1]] - [first[k], first[k], 0]).tolist()
        start, end, period = best_run(runs)
        kept = np.flatnonzero(stays[first[k] : first[k] + len(words)]).tolist()
        rows.append(
            (
                len(runs),
                start,
                end - start,
                period,
                1000 * (end - start) // period,
                "".join(f"{s},{e - s},{q}\n" for s, e, q in runs),
                b" ".join([words[i] for i in kept]).decode(),
            )
        )
    return rows


def _runs(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    for batch in batches:
        rows, held, size = [], [], 0
        for text in batch.column(1):
            # bytes.split() splits at 0x20 and 0x09 to 0x0D, and nowhere else.
            words = (text.as_py() or "").encode().split()
            if held and size + len(words) > WORDS:
                rows.extend(_described(held))
                held, size = [], 0
            held.append(words)
            size += len(words)
        if held:
            rows.extend(_described(held))
        columns = zip(*rows) if rows else ((),) * len(kinds)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *names])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: its id and ``RESULT``.

    The run of the greatest length / period gives ``start`` (a word number from 0 on),
    ``length``, ``period`` and 1000 times that quotient; they are null without a run.
    ``runs`` lists all as lines of ``start,length,period``, by start and period.
    ``collapsed`` is the text, its words joined by one space, without the words that
    any run holds after its first period.
    """
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(_runs, f"id {kind}, {RESULT}").withColumnRenamed("id", id_col)
