"""Full license texts: whole, in comments, below other content and under other line breaks."""

import textwrap

from chunkloom.llm import licenses


def test_full_texts_are_found_anywhere(spark):
    texts = dict(licenses.full_texts())
    mit = " ".join(licenses.MIT.split())
    commented = "\n".join(" * " + line for line in ("Copyright 2020 X\n" + licenses.MIT).split("\n"))
    docs = [
        texts["BSD-2-Clause"],
        "BSD 3-Clause License\n\nCopyright (c) 2020, X\n\n" + texts["BSD-3-Clause"],
        licenses._file("Apache-2.0"), licenses._file("GPL-3.0"), licenses._file("MPL-2.0"),
        "# Copyright 2020 X\n# MIT License\n" + licenses.MIT,
        "/*\n" + commented + "\n */\nint main;",
        "Some words.\n\n" + textwrap.fill(mit, 40) + "\nmore\n" + textwrap.fill(mit, 90) + "\nend",
        "Words before\n" + licenses.ISC.rstrip(".") + "x",
        "first " + mit + " last",
        "first\n" + mit + "\nlast",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    rows = [(r.doc_id, r.line, r.license_id) for r in licenses.find_licenses(df, licenses.known_table(spark)).collect()]
    later = 3 + len(textwrap.wrap(mit, 40)) + 1
    assert sorted(r for r in rows if r[0] not in (1, 2, 3, 5)) == [
        (0, 0, "BSD-2-Clause"), (4, 0, "MPL-2.0"), (6, 3, "MIT"), (7, 3, "MIT"), (7, later, "MIT"),
        (9, 1, "MIT"), (10, 2, "MIT"),
    ]
    assert {(1, 0, "BSD-3-Clause"), (2, 0, "Apache-2.0"), (3, 0, "GPL-3.0"), (5, 0, "MIT"), (5, 3, "MIT")} <= set(rows)


def test_texts_filled_to_other_widths_are_found(spark):
    """Every full text, each paragraph filled anew, below and above other words."""
    docs = []
    for license_id, text in dict((i, t) for i, t in reversed(licenses.full_texts())).items():
        for width in (60, 72, 100):
            filled = "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))
            docs.append((f"{license_id} {width}", f"Some words.\n\n{filled}\n\nOther words."))
    df = spark.createDataFrame(docs, "doc_id string, text string")
    found = licenses.find_licenses(df, licenses.known_table(spark)).collect()
    assert {d for d, _ in docs} == {r.doc_id for r in found if r.doc_id.split()[0] == r.license_id}
    assert all(r.doc_id.split()[0] == r.license_id for r in found)


def test_only_headers_count_as_copyright_lines(spark):
    headers = ["Copyright 2020 X", "# Copyright (c) X and others", "(C) 2019 X", "© X", "Copyright: X", " * COPYRIGHT X Corp."]
    running = ["copyright, patent and", "(c) You must retain", "copyright notice", "copyright the software, and", "copyright"]
    rows = [(i, x) for i, x in enumerate(headers + running)]
    plain = spark.createDataFrame(rows, "i int, text string").select("i", licenses.canonical(licenses.F.col("text")))
    assert [r.i for r in plain.collect() if not r[1]] == list(range(len(headers)))
