import textwrap

from farelake.llm.licenses import KNOWN, TITLES, known_digests, scan_licenses


def test_variants_of_a_text(spark):
    mit = KNOWN[0][1]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2019 Some One\nAll rights reserved.\n\n" + mit.upper().replace(" ", "  ")),
        (3, mit.replace("sublicense", "sublicence").replace(".", "")),
        (4, mit + " And one word more."),
        (5, "prose\nReleased under the MIT licence!\nmore prose\nreleased under the mit license"),
        (6, None),
        (7, ""),
        (7, "..."),
        (None, "SPDX-License-Identifier: MIT"),
        (8, "copyright notices are discussed here " * 5000),
    ]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, license string, unit string")
    got = sorted(
        (r.doc_id or 0, r.unit, r.line_no, r.license) for r in scan_licenses(docs, known_digests(spark)).collect()
    )
    assert got == [
        (0, "line", 0, "MIT"),
        (0, "text", -1, "MIT"),
        (1, "text", -1, "MIT"),
        (2, "text", -1, "MIT"),
        (3, "text", -1, "MIT"),
        (5, "line", 1, "MIT"),
        (5, "line", 3, "MIT"),
    ]


def test_every_row_reports(spark):
    docs = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0.")] * 3, "doc_id long, text string")
    assert scan_licenses(docs, known_digests(spark)).count() == 6


def test_empty(spark, empty):
    assert scan_licenses(empty, known_digests(spark)).count() == 0
    docs = spark.createDataFrame([(1, "anything")], "doc_id long, text string")
    assert scan_licenses(docs, known_digests(spark, [])).count() == 0


def test_whole_texts_under_titles_and_with_other_marks(spark):
    texts = {name: text for name, text in reversed(KNOWN) if "\n" in text}
    assert set(texts) >= {"MIT", "MIT-0", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "BSL-1.0", "Unlicense"}
    rows = []
    for name, text in texts.items():
        title = f"# {TITLES[name]}\n\n" if name in TITLES else ""
        starred = text.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
        wrapped = textwrap.fill(text.replace("\n", " "), 60)
        for variant in (text, title + "Copyright (c) 2024, Some One\nAll rights reserved.\n\n" + wrapped, starred):
            rows.append((len(rows), name, variant))
        rows.append((len(rows), None, text.rsplit(" ", 1)[0]))
    docs = spark.createDataFrame(rows, "doc_id long, want string, text string")
    found = scan_licenses(docs, known_digests(spark)).where("unit = 'text'")
    assert {r.doc_id: r.license for r in found.collect()} == {i: name for i, name, _ in rows if name}
