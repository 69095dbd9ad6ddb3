import pytest
from compare import connect, difference

from ratingloom.llm import license_scan as L
from ratingloom.llm.queries import QUERIES, SQL

HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_rules_on_rows_of_every_kind(spark):
    rows = [
        (1, "Some words.\nReleased under the MIT License.\nMore words."), (2, None), (3, ""), (4, "Nothing here. " * 20000),
        (5, "LICENSED under   the Apache-License, version 2.0!"), (6, "All rights reserved. Licensed under CC BY-NC 4.0."),
        (1, "Some words.\nReleased under the MIT License.\nMore words."), (None, "no stop before it\nReleased under the MIT License."),
        (7, "We released under the MIT license once."),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, licenses string")
    got = {r.doc_id: r for r in L.report(docs).collect()}
    assert L.report(docs).count() == len(rows)
    assert [got[k].licenses for k in (1, 2, 3, 4, 5, 6, None, 7)] == ["MIT", "", "", "", "Apache-2.0", "CC-BY-NC-4.0", "MIT", ""]
    assert got[6].sentence_ids == "all_rights,cc_by_nc_4" and got[6].n_unruled == 1
    assert L.report(docs.limit(0)).count() == 0


def test_ordered_rules_take_whole_notices_first(spark):
    known = {"a": "one", "b": "two", "c": "three"}
    rules = [("ab", "AB", ["a", "b"]), ("ac", "AC", ["a", "c"]), ("a", "A", ["a"])]
    docs = spark.createDataFrame([(1, "one. two. one. two."), (2, "one. one. two. three."), (3, "two. one.")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in L.scan(docs, known, rules).collect()}
    assert (got[1].rules, got[1].n_unruled) == (["ab"], 0)
    assert (got[2].rules, got[2].n_unruled) == (["ab", "a"], 1)  # the outer "one" and "three" do not become neighbours
    assert got[3].rules == ["a"]


def test_a_wrapped_header(spark):
    docs = spark.createDataFrame([(1, HEADER)], "doc_id bigint, text string")
    # the address is a paragraph of its own here, so the notice is recognised sentence by sentence
    assert L.report(docs).collect()[0].licenses == "Apache-2.0"


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, d):
    got = QUERIES["op2_license_scan"](spark, d).toPandas()
    assert difference(got, connect(d).execute(SQL["op2_license_scan"]).df()) is None
    assert (got.licenses != "").sum() > 0


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = QUERIES["op2_license_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


MIT = """MIT License

Copyright (c) 2020 Some Body

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

GPL = """This file is part of Thing.

Thing is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

Thing is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""

BSD3 = """Copyright (c) 2020, Some Body. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD2 = BSD3[: BSD3.index("3. Neither")] + BSD3[BSD3.index("THIS SOFTWARE") :]


def _commented(text, style):
    lines = text.split("\n")
    if style == "block":
        return "/*\n" + "\n".join(f" * {x}".rstrip() for x in lines) + "\n */\nint main() {}"
    return "\n".join(f"{style} {x}".rstrip() for x in lines) + "\nimport os" if style else text


@pytest.mark.parametrize("style", ["", "#", "//", "--", "block"])
def test_whole_notices_wrapped_and_commented(spark, style):
    full = [(MIT, "mit_text", "MIT"), (HEADER, "apache_header", "Apache-2.0"), (GPL, "gpl3_notice", "GPL-3.0-or-later"),
            (BSD3, "bsd3_text", "BSD-3-Clause"), (BSD2, "bsd2_text", "BSD-2-Clause"), ("Copyright 2020 X\n\n" + HEADER, "apache_header", "Apache-2.0")]
    docs = spark.createDataFrame([(i, _commented(t, style)) for i, (t, _, _) in enumerate(full)], "doc_id bigint, text string")
    got = {r.doc_id: (r.rules, r.licenses) for r in L.report(docs).collect()}
    assert [got[i] for i in range(len(full))] == [(rule, licence) for _, rule, licence in full]


def test_a_notice_is_found_at_every_width(spark):
    import textwrap

    paragraphs = MIT.split("\n\n")
    texts = ["\n\n".join(textwrap.fill(p, w) for p in paragraphs).replace("\n", end) for w in (20, 40, 60, 100, 5000) for end in ("\n", "\r\n")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.rules for r in L.report(docs).collect()} == {"mit_text"}


def test_spdx_identifiers_wherever_they_stand(spark):
    texts = {
        "# SPDX-License-Identifier: MIT\nimport os": "MIT",
        "/* SPDX-License-Identifier: BSD-3-Clause */\nint x;": "BSD-3-Clause",
        "#!/bin/sh\n# spdx-license-identifier: mit\necho": "MIT",
        "// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR Apache-2.0\nfoo": "GPL-2.0-only WITH Linux-syscall-note,Apache-2.0",
        "<!-- SPDX-License-Identifier: CC-BY-4.0 -->\n<p>": "CC-BY-4.0",
        "x = 1  # SPDX-License-Identifier: LicenseRef-own and so on": "LicenseRef-own",
        "SPDX-License-Identifier:\nnone": "",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in L.report(docs).collect()}
    assert [got[i].licenses for i in range(len(texts))] == list(texts.values())
    assert all((r.n_sentences, r.n_unruled) == (1 if r.licenses else 0, 0) for r in got.values())
