"""Secrets in texts: keyword prefilter, anchored patterns near hits, checksums.

One pass of an Aho-Corasick automaton finds all keywords in a text whose ASCII
letters are lower-cased; a pattern is tried only where a keyword of its kind stands.
Runs of hexadecimal digits have no keyword and are found by their pattern.  Tokens
with an embedded checksum are added when the checksum is right: ``github`` and
``npm`` tokens end in the CRC-32 of what stands before, in six base-62 digits.

Defined cases: a null text is an empty one; nothing found gives zero counts, an empty
``spans`` and the digest of an empty string; ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds of the contract with their patterns and least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = r"(gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
TOKEN_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

RESULT = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
    "n_checked bigint"
)


def checksum(body: str) -> str:
    """CRC-32 of a token's body in six base-62 digits."""
    import zlib

    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = DIGITS[digit] + digits
    return digits


class Scanner:
    """Finds ``(start, end, kind)`` in a text."""

    def __init__(self):
        import re

        import ahocorasick

        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(HEX)
        self.token = re.compile(TOKEN)
        self.words = ahocorasick.Automaton()
        groups = (("assign", ASSIGN_WORDS), ("access", ("akia",)), ("token", TOKEN_WORDS))
        for kind, words in groups:
            for word in words:
                self.words.add_word(word, (kind, len(word)))
        self.words.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, str]]:
        # Only A-Z change, so positions stay those of the text.
        low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        found = [(m.start(), m.end(), "hex") for m in self.hex.finditer(text)]
        hits = [(last - n + 1, kind) for last, (kind, n) in self.words.iter(low)]
        end = dict.fromkeys(("assign", "access", "token"), 0)
        for start, kind in sorted(hits):
            if start < end[kind]:
                continue  # inside the match before, which may be too short to count
            if kind == "assign" and (m := self.assign.match(text, start)):
                end[kind] = m.end()
                if len(m[2]) >= LEAST_ASSIGN:
                    found.append((start, m.end(), kind))
            elif kind == "access" and (m := self.access.match(text, start)):
                end[kind] = m.end()
                if len(m[0]) >= LEAST_ACCESS:
                    found.append((start, m.end(), kind))
            elif kind == "token" and (m := self.token.match(text, start)):
                end[kind] = m.end()
                if checksum(m[2]) == m[3]:
                    found.append((start, m.end(), "npm" if m[1] == "npm" else "github"))
        return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _scan(batches: Iterator) -> Iterator:
    import hashlib

    import pyarrow as pa

    scanner = Scanner()
    base = KINDS[:3]
    for batch in batches:
        rows = []
        for text in batch.column(1):
            spans = scanner(text.as_py() or "")
            said = [f"{kind}:{start}:{end}" for start, end, kind in spans]
            kinds = [kind for _, _, kind in spans]
            own = ",".join(s for s, kind in zip(said, kinds) if kind in base)
            rows.append(
                (
                    *(kinds.count(k) for k in base),
                    hashlib.sha256(own.encode()).hexdigest(),
                    ",".join(said),
                    sum(k not in base for k in kinds),
                )
            )
        a, b, c, digest, spans, more = zip(*rows) if rows else ((),) * 6
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array(x, pa.int64()) for x in (a, b, c)),
                pa.array(digest, pa.string()),
                pa.array(spans, pa.string()),
                pa.array(more, pa.int64()),
            ],
            names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_checked"],
        )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: counts of the base kinds, their digest, and all spans.

    ``n_checked`` counts the tokens whose checksum is right.
    """
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(_scan, f"id {kind}, {RESULT}").withColumnRenamed("id", id_col)
