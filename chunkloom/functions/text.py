"""Text predicates, line and chunk splitting as native column expressions.

The character classes spell out Python's text rules for Java regular
expressions: what counts as white space, as a word character and as the end of
a line.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind, indices

# Line terminators, white space inside a line, word characters.
TERMINATORS = r"\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}"
INLINE_SPACE = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
SPACE = TERMINATORS + INLINE_SPACE
WORD = r"\p{L}\p{N}_"

# A definition header: "class" or "def", a name, and a colon that comes before
# the first ")" or right behind it.  Possessive quantifiers keep it linear.
PYTHON_DEFS = rf"(?:class|def)[{SPACE}]++[{WORD}][^):]*+\)?:"

# The same header kept inside one line, to be searched in a whole file at once.
_HEADER = rf"(?:class|def)[{INLINE_SPACE}]++[{WORD}][^):{TERMINATORS}]*+\)?:"

# Java's "^" knows every line end of Python but these; texts without them, nearly
# all, are split with it, the others with an explicit look back at each place.
_RARE_TERMINATORS = "\x0b\x0c\x1c\x1d\x1e"
_LINE_STARTS = "(?m)^"
_ANY_LINE_STARTS = rf"(?m)^|(?<=[{_RARE_TERMINATORS}])(?!\z)"
_CHUNK_STARTS = rf"(?m)^(?=[{INLINE_SPACE}]*+{_HEADER})"
_ANY_CHUNK_STARTS = rf"(?<=[{TERMINATORS}])(?=[{INLINE_SPACE}]*+{_HEADER})"

MODES = ("line", "top_level")


def has_text(text: Column) -> Column:
    """True unless the text is null, empty or only white space."""
    return F.rlike(text, F.lit(rf"[^{SPACE}]"))


def is_boundary(line: Column, pattern: str = PYTHON_DEFS) -> Column:
    """Does the line, leading white space aside, begin with ``pattern``?"""
    return F.rlike(line, F.lit(rf"\A[{SPACE}]*+(?:{pattern})"))


def _contains_any(text: Column, characters: str) -> Column:
    return reduce(or_, [F.contains(text, F.lit(c)) for c in characters])


def _split(text: Column, usual: str, rare: str) -> Column:
    return F.when(_contains_any(text, _RARE_TERMINATORS), F.split(text, rare)).otherwise(
        F.split(text, usual)
    )


def split_lines(text: Column) -> Column:
    """Lines with their terminators kept; an empty text has no lines."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        _split(text, _LINE_STARTS, _ANY_LINE_STARTS)
    )


def normalize_newlines(text: Column) -> Column:
    """Turn CRLF and lone CR into LF."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(
        text
    )


def newline_count(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))


def only_newlines(text: Column) -> Column:
    """True when LF is the only line terminator in the text."""
    return ~_contains_any(text, _RARE_TERMINATORS + "\r\x85\u2028\u2029")


def line_count(text: Column) -> Column:
    """Number of physical lines."""
    return F.size(split_lines(text))


def _cut(lines: Column, starts: Column) -> Column:
    """Join the lines between consecutive start positions."""
    return F.transform(
        starts,
        lambda first, k: F.array_join(
            F.slice(lines, first + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - first), ""
        ),
    )


def _line_starts(lines: Column, pattern: str) -> Column:
    return F.filter(indices(lines), lambda i: (i == 0) | is_boundary(F.get(lines, i), pattern))


def _top_level_starts(lines: Column, pattern: str) -> Column:
    """Chunk start lines when only column-0 definitions count.

    Column-0 decorators and comments directly above a definition belong to it,
    so a chunk starts right after the last line that is neither.
    """

    def opened(free: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(free) - 1),
            lambda t: F.rlike(F.get(lines, F.get(free, t)), F.lit(rf"\A(?:{pattern})")),
        )
        return F.transform(
            heads, lambda t: F.when(t == 0, 0).otherwise(F.get(free, t - 1) + 1)
        )

    def with_preamble(starts: Column) -> Column:
        first = F.get(starts, F.lit(0))
        code_before = F.exists(
            F.slice(lines, F.lit(1), first), lambda x: F.rlike(x, F.lit(rf"\A[{SPACE}]*+[^{SPACE}@#]"))
        )
        rest = F.slice(starts, F.lit(2), F.size(starts))
        return (
            F.when(F.size(starts) == 0, F.array(F.lit(0)))
            .when((first > 0) & code_before, F.concat(F.array(F.lit(0)), starts))
            .otherwise(F.concat(F.array(F.lit(0)), rest))
        )

    free_lines = F.filter(
        indices(lines), lambda i: ~F.rlike(F.get(lines, i), F.lit(r"\A[@#]"))
    )
    return bind(bind(free_lines, opened), with_preamble)


def chunk_text(text: Column, mode: str = "line", pattern: str | None = None) -> Column:
    """Split a text into its ordered chunks; joined, they give back the text.

    ``line``: every line that is a boundary opens a chunk.
    ``top_level``: only definitions in column 0 do, with the decorators and
    comments directly above them.
    ``pattern`` replaces the Python definition header, for other languages; it
    is matched at the start of each line.  Blank texts give no chunks.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "line" and pattern is None:
        chunks = _split(text, _CHUNK_STARTS, _ANY_CHUNK_STARTS)
    elif mode == "line":
        chunks = bind(
            split_lines(text),
            lambda lines: bind(_line_starts(lines, pattern), lambda s: _cut(lines, s)),
        )
    else:
        chunks = bind(
            split_lines(text),
            lambda lines: bind(
                _top_level_starts(lines, pattern or PYTHON_DEFS), lambda s: _cut(lines, s)
            ),
        )
    return F.when(has_text(text), chunks).otherwise(F.array().cast("array<string>"))


def content_preview(text: Column, length: int = 50) -> Column:
    """The first characters on one line, always followed by three dots."""
    first = F.substring(text, 1, length)
    return F.concat(F.replace(first, F.lit("\n"), F.lit(" ")), F.lit("..."))


def repo_label(url: Column) -> Column:
    """A directory-safe label from the last segment of a repository address."""
    last = F.element_at(F.split(url, "/"), -1)
    bare = F.regexp_replace(last, r"[.]git\z", "")
    safe = F.regexp_replace(bare, r"[^\p{L}\p{N}_-]", "_")
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("unknown_repo")).otherwise(safe)
