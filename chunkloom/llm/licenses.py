"""License texts and notices by the digest of their canonical form.

A text is lower-cased, its copyright lines go, equivalent spellings become one, and
punctuation and white space shrink to single spaces.  The SHA-256 of what is left is
joined with the digests of known licenses.  The whole text of a document, each of its
lines, and each run of words that begins like a full license text and is as long as it
are looked up, so a text is found below other content and filled to other widths, unless
a line ends within a hyphenated word that has another spelling.

Defined cases: null texts and parts without any word match nothing; ids may be null or
repeated; licenses with equal canonical texts are all reported.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.sources.staging import stage

# Public license names and the notices that usually name them.
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL v3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL v3"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
    "CC0-1.0": ("CC0 1.0",),
}
NOTICES = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This work is licensed under {}.",
    "This work is licensed under the {}.",
    "This project is licensed under the {}.",
    "SPDX-License-Identifier: {}",
)
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in
all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE."""
#: Licenses whose full text is a file beside this module, and what ends their terms.
TEXTS = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "CC0-1.0")
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: A run of words is compared where so many characters are those a full text begins with.
ANCHOR = 48

# Spellings that mean the same, applied in this order to lower case.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("organisation", "organization"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("https://", "http://"),
    ("&", " and "),
    (" ver. ", " version "),
)


def _not_begun(words: tuple[str, ...], also: str = "") -> str:
    """A pattern, without lookahead, of the rest of a line that begins with none of the words."""
    heads = sorted({w[0] for w in words})
    rest = [f"$|[^{''.join(heads)}{also}\\n][^\\n]*"]
    for head in heads:
        tails = tuple(w[1:] for w in words if w[0] == head)
        if "" not in tails:
            rest.append(f"{head}(?:{_not_begun(tails)})")
    return "|".join(rest)


# A copyright line may stand behind the leader of a comment.  It has a sign, a year or a holder.
# A line of running text that happens to begin with the word, or a clause (c), is none, so
# that a text filled to another width loses no words.
RUNNING = (
    "notice", "holder", "owner", "license", "licence", "law", "statement", "on the", "the software",
    "permission", "treaty", "doctrine", "and ", "or ", "are ", "if you",
)
COPYRIGHT = (
    r"(?m)^[ \t#*/;%!<>-]*(?:©[^\n]*|\(c\)[ \t]*(?:copyright|©|[0-9<\[])[^\n]*"
    r"|copyright(?:[(©:0-9<\[][^\n]*|[ \t]+(?:"
    + _not_begun(RUNNING, r" \t")
    + r")))$"
)
VERSION = r"\bv([0-9])"
PLAIN = r"[^\p{L}\p{Nd}]+"
PLAIN_BUT_NEWLINE = r"[^\p{L}\p{Nd}\n]+"


def _plain_lines(text: Column) -> Column:
    """Canonical lines, each still within spaces, between newlines: no rule reaches over one."""
    found = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for old, new in SPELLINGS:
        found = F.replace(found, F.lit(old), F.lit(new))
    found = F.regexp_replace(found, VERSION, "version $1")
    return F.regexp_replace(found, PLAIN_BUT_NEWLINE, " ")


def canonical(text: Column) -> Column:
    """The form in which two spellings of a license are equal."""
    return F.trim(F.regexp_replace(_plain_lines(text), "[ \n]+", " "))


def full_texts() -> list[tuple[str, str]]:
    """``(license_id, text)`` of full licenses up to the end of their terms, and of the part below a header."""
    rows = [("MIT", MIT), ("ISC", ISC), ("BSD-2-Clause", BSD_2 + BSD_END), ("BSD-3-Clause", BSD_2 + BSD_3 + BSD_END)]
    for license_id in TEXTS:
        terms, end, _ = _file(license_id).partition(END_OF_TERMS)
        rows.append((license_id, terms + end))
        # Where lines are filled anew, a copyright line of the header takes other words with it;
        # what stands below the header has none.
        paragraphs = re.split(r"\n[ \t]*\n", terms + end)
        heads = [i for i, x in enumerate(paragraphs[:4]) if re.search(r"copyright \(c\)", x, re.I)]
        if heads:
            rows.append((license_id, "\n\n".join(paragraphs[heads[-1] + 1 :])))
    return rows


def _file(license_id: str) -> str:
    return (Path(__file__).with_name("license_texts") / f"{license_id}.txt").read_text(encoding="utf-8")


def known_licenses() -> list[tuple[str, str]]:
    """``(license_id, text)`` of the licenses known by default."""
    rows = full_texts() + [(license_id, _file(license_id)) for license_id in TEXTS]
    rows += [("MIT", "MIT License\n" + MIT), ("ISC", "ISC License\n" + ISC)]
    rows += [(i, f"{NAMES[i][0]}\n{t}") for i, t in full_texts() if i.startswith("BSD")]
    for license_id, names in NAMES.items():
        for name in (license_id, *names):
            rows += [(license_id, notice.format(name)) for notice in NOTICES]
    return rows


def known_table(spark: SparkSession, licenses: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(license_id, digest)`` without repetitions."""
    rows = spark.createDataFrame(licenses or known_licenses(), "license_id string, text string")
    plain = rows.select("license_id", canonical(F.col("text")).alias("plain")).filter("plain <> ''")
    return plain.select("license_id", F.sha2("plain", 256).alias("digest")).distinct()


def _runs(texts: list[str]) -> Column:
    """Runs of words of ``padded`` as long as one of the canonical texts and begun like it.

    Each with the line it starts on.  A run that is the whole document, or one whole line,
    is looked up as such.
    """
    begun = {}
    for text in texts:
        begun.setdefault(" " + text[:ANCHOR], set()).add(len(text))
    # Canonical texts have only letters, digits and single spaces: no pattern, no quote.
    starts = ", ".join(
        f"named_struct('needle', '{needle}', 'sizes', array({', '.join(map(str, sorted(sizes)))}))"
        for needle, sizes in begun.items()
    )
    # Offsets behind each occurrence of a needle, from the lengths of what stands between.
    behind = """slice(aggregate(split(padded, b.needle), array(0), (a, p) ->
        concat(a, array(element_at(a, -1) + length(p) + length(b.needle)))), 2, size(split(padded, b.needle)) - 1)"""
    ends = """slice(aggregate(trimmed, array(0), (a, x) -> concat(a, array(
        element_at(a, -1) + IF(x = '', 0, length(x) + 1)))), 2, size(trimmed))"""
    found = f"""flatten(transform(array({starts}), b -> flatten(transform({behind}, o -> transform(
        filter(b.sizes, n -> n < length(padded) - 2
            AND substring(padded, o - length(b.needle) + n + 2, 1) = ' '),
        n -> named_struct('line', size(filter(ends, e -> e <= o - length(b.needle))) + 1,
                          'part', substring(padded, o - length(b.needle) + 2, n)))))))"""
    named = f"""transform(array({ends}), ends -> filter({found}, r -> get(trimmed, r.line - 1) <> r.part))[0]"""
    named = f"""transform(array(transform(split(plain, '\n'), x -> trim(x))), trimmed -> {named})[0]"""
    some = " OR ".join(f"contains(padded, '{needle}')" for needle in begun)
    none = "CAST(array() AS array<struct<line: int, part: string>>)"
    named = f"transform(array(concat(' ', trim(whole), ' ')), padded -> CASE WHEN {some} THEN {named} ELSE {none} END)[0]"
    return F.expr(named) if begun else F.expr(none)


def find_licenses(
    docs: DataFrame,
    known: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: list[str] | None = None,
) -> DataFrame:
    """``(id, line, license_id, digest)`` for each known license that a document holds.

    ``line`` counts from 1; 0 is the document as a whole.  A document of one
    line is looked up as a whole only.  ``texts``, by default the full ones, are also found
    within a document and have the line they start on.  Nothing shuffles while the known
    digests fit Spark's own limit for broadcasting; beyond it 32-byte digests do.
    """
    # One pass makes the lines of a text canonical and, joined, the whole of it.  The pass
    # is a column of its own and is used more than once, so nothing repeats it.
    plain = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("__llm_id"), _plain_lines(F.col(text_col)).alias("plain")
    )
    plain = plain.withColumn("whole", F.regexp_replace("plain", "[ \n]+", " "))
    # An empty line never matches; keeping its place keeps the numbers.
    lines = F.when(F.contains("plain", F.lit("\n")), F.split("plain", "\n"))
    parts = F.concat(F.array("whole"), F.coalesce(lines, F.array().cast("array<string>")))
    if texts is None:
        texts = [text for _, text in full_texts()]
    given = docs.sparkSession.createDataFrame([(t,) for t in texts], "text string")
    runs = _runs([r[0] for r in given.select(canonical(F.col("text"))).distinct().collect() if r[0]])
    numbered = F.transform(parts, lambda part, i: F.struct(i.alias("line"), part.alias("part")))
    rows = plain.select("__llm_id", F.explode(F.concat(numbered, runs)).alias("row")).select("__llm_id", "row.*")
    # Stored, the digests have a size that Spark knows.
    known = stage(known, "known-licenses")
    hashed = rows.filter("part <> '' AND part <> ' '").select(
        "__llm_id", "line", F.sha2(F.trim("part"), 256).alias("digest")
    )
    return hashed.join(known, "digest").select(
        F.col("__llm_id").alias(id_col), "line", "license_id", "digest"
    )
