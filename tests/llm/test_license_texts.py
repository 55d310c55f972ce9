"""Operator 5: licences in the forms in which they are found."""

import pytest

from tidemark.llm import license_table, licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def whole(spark, docs_of, texts):
    found = licenses.scan(docs_of(list(enumerate(texts))), licenses.known_licenses(spark)).collect()
    return [r.text_license for r in sorted(found, key=lambda r: r.doc_id)]


def test_mit_in_any_wrapping_and_with_its_title(spark, docs_of):
    one = " ".join(MIT.split())
    head = "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n"
    each = "\n".join(one.split())
    texts = [MIT, one, head + MIT, head + one, "The MIT License (MIT)\r\n\r\nCopyright Jane Doe\r\n\r\n" + MIT.replace("\n", "\r\n"),
             each.replace("\nCOPYRIGHT\nHOLDERS", "\nCOPYRIGHT HOLDERS").replace("\ncopyright\nnotice", "\ncopyright notice"), "(c) Acme, Inc.\n" + MIT]
    assert whole(spark, docs_of, texts) == ["MIT"] * len(texts)
    # the clause is part of the licence
    assert whole(spark, docs_of, [MIT.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, ", "")]) == [""]


@pytest.mark.parametrize("title, license_id", [("ISC License", "ISC"), ("BSD Zero Clause License", "0BSD"), ("The zlib License", "Zlib")])
def test_titles(spark, docs_of, title, license_id):
    text = dict(reversed(licenses.KNOWN[:4]))[license_id]
    assert whole(spark, docs_of, [text, f"{title}\n\nCopyright 2001-2004 Some Body <a@b.c>\n{text}"]) == [license_id] * 2


def test_notices_are_told_from_text(spark, docs_of):
    notices = ["Copyright", "Copyright 2001 X", "copyright: the Foo Authors", "Copyright (C) X", "(c) 2020 X", "(c) Copyright X", "© X", "All rights reserved."]
    text = ["copyright holders be liable", "copyright notice, this list", "copyright license to reproduce", "(c) You must retain", "\"copyright\" also means"]
    rows = {r.doc_id: r.text_digest for r in licenses.scan(
        docs_of(list(enumerate([""] + notices + text))), licenses.known_licenses(spark)).collect()}
    assert [rows[i] == rows[0] for i in range(1, len(rows))] == [True] * len(notices) + [False] * len(text)


def test_full_texts_of_the_table(spark, docs_of):
    bsd = (license_table.FOLDER / "BSD-3-Clause.txt").read_text()
    ids = sorted(p.stem for p in license_table.FOLDER.glob("*.txt"))
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"} <= set(ids)
    texts = [" ".join((license_table.FOLDER / f"{i}.txt").read_text().split()) if i in ("CC0-1.0", "MPL-2.0", "Unlicense")
             else (license_table.FOLDER / f"{i}.txt").read_text().upper() for i in ids]
    assert whole(spark, docs_of, texts) == ids
    gpl = (license_table.FOLDER / "GPL-2.0.txt").read_text()
    assert whole(spark, docs_of, [
        "BSD 3-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n" + bsd,
        bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "), bsd.replace("HOLDER OR", "OWNER OR"),
        gpl[:gpl.index(license_table.END)], gpl.replace(" 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\n Everyone", " Everyone"),
        bsd.replace("without specific prior written", "without")]) == ["BSD-3-Clause"] * 3 + ["GPL-2.0"] * 2 + [""]


def test_tags_and_notices_of_the_table(spark, docs_of):
    lines = {"/* SPDX-License-Identifier: BSD-2-Clause */": "BSD-2-Clause", "# SPDX-License-Identifier: ISC": "ISC",
             "SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "spdx-license-identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later",
             "SPDX-License-Identifier: GPL-2.0": "GPL-2.0", "// SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
             "This project is licensed under the BSD 3-Clause License.": "BSD-3-Clause", "Licensed under the GNU AGPL v3": "AGPL-3.0",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
             "SPDX-License-Identifier: Nothing-1.0": ""}
    docs = docs_of([(i, f"text\n{x}\ntext") for i, x in enumerate(lines)])
    got = {r.doc_id: r.line_licenses for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    assert [got[i] for i in range(len(lines))] == list(lines.values())
