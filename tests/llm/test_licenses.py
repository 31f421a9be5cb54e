"""License digests: variations of known texts, and texts that only look like them."""

import hashlib

import pytest

from scholaris.llm import licenses
from scholaris.llm.licenses import KNOWN, canonical_lines
from scholaris.llm.queries import QUERIES

MIT = next(text for name, text in KNOWN if name == "MIT" and "\n" in text)


def known_table(spark):
    return spark.createDataFrame(list(KNOWN), "license string, text string")


VARIED = [
    MIT,
    "Copyright (c) 2020 Somebody\n\n" + MIT,
    MIT.upper(),
    "/*\n" + "\n".join(" * " + line for line in MIT.split("\n")) + "\n */",
    "# © 1999 Some Company. All rights reserved.\n" + MIT.replace(" ", "  \t").replace("\n", "\r\n\r\n"),
    MIT.replace('"', "\u201c").replace(",", " , ").replace("sublicense", "sub-license").replace("sub-license", "sublicense"),
    "(C) x\n** All Rights Reserved.\n" + MIT.replace(".", " —"),
]


@pytest.mark.parametrize("text", VARIED)
def test_variations_have_one_form(text):
    assert b" ".join(canonical_lines(text.encode())) == b" ".join(canonical_lines(MIT.encode()))


def test_spellings_and_copyright_lines():
    assert canonical_lines(b"The Licence favours\nCOPYRIGHT 1\nwhilst; HTTPS://") == [b"the license favours", b"while http"]
    assert canonical_lines("copyrighted\n\u00a9\n \n".encode()) == [b"copyrighted"]
    assert canonical_lines("\u00c9t\u00e9 \u2013 x".encode()) == ["\u00c9t\u00e9 x".encode()]


def test_table(spark, documents):
    notice = "Some prose.\nReleased under the MIT license\n\n licensed under CC BY NC 4.0!\nmore"
    other = MIT.replace("free of charge", "for a fee")
    texts = [*VARIED, notice, notice, other, "Released under the MIT License.", None, "", "copyright x", "Licensed under CC BY 4.0.\nMIT"]
    rows = {r.doc_id: r for r in licenses.scanned(documents(texts), known_table(spark)).collect()}
    assert sorted(rows) == list(range(len(texts)))
    n = len(VARIED)
    assert all(rows[i].license == "MIT" for i in range(n))
    assert [rows[i].notices for i in (n, n + 1)] == [["CC-BY-NC-4.0", "MIT"]] * 2
    assert rows[n].license is None and rows[n + 2].license is None and rows[n + 2].notices == []
    assert (rows[n + 3].license, rows[n + 3].notices) == ("MIT", [])
    empty = hashlib.sha256(b"").hexdigest()
    assert all((rows[i].license, rows[i].notices, rows[i].digest) == (None, [], empty) for i in (n + 4, n + 5, n + 6))
    assert rows[n + 7].notices == ["CC-BY-4.0"]


def test_odd_tables(spark, documents, odd_texts):
    assert licenses.scanned(documents([]), known_table(spark)).count() == 0
    rows = licenses.scanned(documents(odd_texts, [None] * len(odd_texts)), known_table(spark).limit(0)).collect()
    assert len(rows) == len(odd_texts) and all(r.license is None and r.notices == [] for r in rows)
    blank = spark.createDataFrame([("None", ""), ("Null", None), ("B", "x"), ("A", "X!")], "license string, text string")
    rows = licenses.scanned(documents(["x", "", None]), blank).collect()
    assert {r.doc_id: r.license for r in rows} == {0: "A", 1: None, 2: None}


def test_titles_other_texts_and_digests(spark, documents, tmp_path):
    clause = "3. Neither the name of the copyright holder nor the names of its contributors may be used"
    bsd = next(text for name, text in KNOWN if name == "BSD-3-Clause")
    isc = next(text for name, text in KNOWN if name == "ISC")
    unlicense = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>
"""
    expected = {
        "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + MIT: "MIT",
        "The MIT License (MIT)\n\nCopyright 2020\n" + MIT: "MIT",
        "MIT License\n" + MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS"): "MIT",
        "ISC License\n\n" + isc: "ISC",
        "BSD 3-Clause License\n\nCopyright (c) 2020, A B\nAll rights reserved.\n\n" + bsd: "BSD-3-Clause",
        bsd.replace(clause, "3. Neither the name of A B nor the names of its contributors may be used"): None,
        unlicense: "Unlicense",
    }
    assert clause in bsd
    documents(list(expected)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.license for r in QUERIES["op9_license_digests"](spark, str(tmp_path)).collect()}
    assert [rows[i] for i in range(len(expected))] == list(expected.values())


def test_copyright_lines_are_not_broken_sentences():
    lines = b"Copyright 2020 x\nCopyright holders be liable\n * Copyright (c) x\ncopyright notice, and\nCopyright Ann Other"
    assert canonical_lines(lines) == [b"copyright holders be liable", b"copyright notice and"]


def test_the_sql_finds_the_same(spark, documents):
    """Whole licenses, varied, broken in lines and shipped by the system, beside prose, by query and by SQL."""
    import glob

    import duckdb

    from scholaris.llm.licensedigests import DIGESTS
    from scholaris.llm.oracle import ORACLE

    shipped = [open(f, errors="replace").read() for f in sorted(glob.glob("/usr/share/common-licenses/*"))]
    broken = MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS").replace("The above copyright", "The above\ncopyright")
    texts = [*VARIED, *(t for _, t in KNOWN), *shipped, broken, "copyright law\nReleased under the MIT License.\nx", "copyright 2020\n(c)\n", None, ""]
    found = licenses.scanned(documents(texts), known_table(spark), known_digests=DIGESTS).collect()
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    expected = sorted(con.execute(f"select doc_id, digest, license, notices from ({ORACLE['op9_license_digests']}) o").fetchall())
    assert sorted((r.doc_id, r.digest, r.license, ",".join(r.notices)) for r in found) == expected
    assert len({r[2] for r in expected}) > (8 if shipped else 5)
