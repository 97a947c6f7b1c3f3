"""Standard license notices, wrapped and on one line."""

import re

from tidemark.llm import licenses

MIT = """MIT License

Copyright (c) 2020 A. Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""
BSD_2 = """Copyright (c) 2020, A Holder

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
BSD_3 = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %s of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
TEXTS = {
    "MIT": MIT, "BSD-2-Clause": BSD_2 + BSD_END, "BSD-3-Clause": BSD_2 + BSD_3 + BSD_END, "Apache-2.0": APACHE,
    "GPL-3.0-or-later": GPL % (":", ",", 3), "GPL-2.0-or-later": GPL % (";", ";", 2),
}


def test_standard_texts(spark):
    forms = {"wrapped": lambda t: t, "one line": lambda t: re.sub(r"\s+", " ", t), "comment": lambda t: "\n".join(("# " + x).rstrip() for x in t.split("\n")),
             "windows": lambda t: t.replace("\n", "\r\n"), "paragraphs": lambda t: re.sub(r"(?<!\n)\n(?!\n) *", " ", t)}
    rows = [(name, form, f(text)) for name, text in TEXTS.items() for form, f in forms.items()] + [("LicenseRef-proprietary", "break", "Foo.\nAll rights\nreserved.")]
    got = licenses.scan(spark.createDataFrame(rows, "name string, form string, text string")).collect()
    assert {(r.name, r.form): r.licenses for r in got} == {(r[0], r[1]): r[0] for r in rows}


def test_apache_on_one_line_has_all_identifiers(spark):
    df = spark.createDataFrame([(re.sub(r"\s+", " ", APACHE),)], "text string")
    assert licenses.scan(df).first().sentence_ids == "apache-2-note,apache-2-use,apache-2-copy,apache-2-warranty,apache-2-see"


def test_third_bsd_sentence_with_any_holder(spark):
    names = ["the University of Somewhere, Elsewhere", "Google Inc.", "A. B. Holder", "the Regents", "PROJECT X", ""]
    plain = BSD_2 + """
3. Neither the name of HOLDER nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    texts = [t for n in names for wrapped in [plain.replace("HOLDER", n)] for t in (wrapped, re.sub(r"\s+", " ", wrapped))]
    other = plain.replace("endorse or promote", "describe")
    df = spark.createDataFrame(list(enumerate([*texts, other])), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(texts))] == ["BSD-3-Clause"] * len(texts) and got[len(texts)] == "BSD-2-Clause"
