"""Keyed, reversible path pseudonyms.

This hides names from a reader without the key.  It is not encryption: the key
digest is a literal in the plan, and equal segments give equal pseudonyms.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.arrays import bind

# Fixed value: the key used when none is given.
DEFAULT_KEY = "my_super_secret_key_for_paths"

_HEX_PER_WORD = 16


def _key_words(key: str) -> Column:
    """The key digest as four signed 64-bit words."""
    digest = hashlib.sha256(key.encode("utf-8")).digest()
    words = [int.from_bytes(digest[i : i + 8], "big", signed=True) for i in range(0, 32, 8)]
    return F.array(*[F.lit(w).cast("bigint") for w in words])


def _xor_hex(digits: Column, key: str) -> Column:
    """XOR non-empty hex digits with the repeating key digest, 8 bytes a step."""
    words = _key_words(key)

    def one(h: Column, i: Column) -> Column:
        piece = F.rpad(F.substring(h, i * _HEX_PER_WORD + 1, F.lit(_HEX_PER_WORD)), _HEX_PER_WORD, "0")
        value = F.conv(piece, 16, -10).cast("bigint").bitwiseXOR(F.get(words, i % 4))
        return F.lpad(F.hex(value), _HEX_PER_WORD, "0")

    def all_words(h: Column) -> Column:
        last = F.floor((F.length(h) - 1) / _HEX_PER_WORD).cast("int")
        joined = F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: one(h, i)), "")
        return F.substring(joined, F.lit(1), F.length(h))

    return bind(digits, all_words)


def _per_segment(path: Column, change) -> Column:
    segments = F.transform(
        F.split(path, "/"), lambda s: F.when(s == "", s).otherwise(change(s))
    )
    whole = bind(
        segments, lambda x: F.when(~F.exists(x, lambda s: s.isNull()), F.array_join(x, "/"))
    )
    return F.when(F.coalesce(path, F.lit("")) == "", F.lit("")).otherwise(whole)


def obfuscate_path(path: Column, key: str = DEFAULT_KEY) -> Column:
    """Replace each path segment by a URL-safe pseudonym; separators stay."""
    return _per_segment(
        path,
        lambda s: F.translate(F.base64(F.unhex(_xor_hex(F.hex(s), key))), "+/\r\n", "-_"),
    )


def deobfuscate_path(pseudonym: Column, key: str = DEFAULT_KEY) -> Column:
    """Undo :func:`obfuscate_path` with the same key.

    Null if any segment is no pseudonym or does not decode to UTF-8, as with
    another key.
    """
    return _per_segment(
        pseudonym,
        lambda s: F.try_validate_utf8(
            F.unhex(_xor_hex(F.hex(F.try_to_binary(F.translate(s, "-_", "+/"), F.lit("base64"))), key)).cast("string")
        ),
    )
