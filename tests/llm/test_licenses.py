"""Sentences, their order, and which rule takes them."""

from conftest import awkward_rows

from rivertally.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
 of this software"""


def scan(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.sentences, r.licences, r.unmatched) for r in licenses.licence_scan(docs).orderBy("doc_id").collect()]


def test_names_and_order(spark):
    assert scan(
        spark,
        "Some prose.\nLicensed under the Apache License, Version 2.0.\nAll rights reserved.",
        "RELEASED UNDER THE MIT LICENSE! Licensed under CC BY-NC 4.0.",
        "All rights reserved. All rights reserved.",
        "We say: licensed under the apache license version 2.0 or so.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ) == [
        ("apache name, rights", "Apache-2.0, All-Rights-Reserved", ""),
        ("mit name, cc by nc short", "MIT, CC-BY-NC-4.0", ""),
        ("rights, rights", "All-Rights-Reserved", ""),
        ("", "", ""),
        ("apache warranty", "", "apache warranty"),
    ]


def test_full_text_uses_its_sentences_up(spark):
    s = licenses.SENTENCES
    full = ". ".join(s[k] for k in ("bsd grant", "bsd source", "bsd binary", "bsd names"))
    torn = ". ".join(s[k] for k in ("bsd grant", "bsd binary", "bsd source"))
    assert [x[1:] for x in scan(spark, full, full.rpartition(". ")[0], torn)] == [
        ("BSD-3-Clause", ""),
        ("BSD-2-Clause", ""),
        ("", "bsd grant, bsd binary, bsd source"),
    ]


MIT_FULL = MIT.replace("\n of", "\nof") + """ and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM.
"""
BSD = """# Copyright (c) 2020, Somebody. All rights
# reserved.
#
# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
# 1. Redistributions of source code must retain the above copyright notice, this
#    list of conditions and the following disclaimer.
#
# 2. Redistributions in binary form must reproduce the above copyright notice,
#    this list of conditions and the following disclaimer in the documentation
#    and/or other materials provided with the distribution.
"""
BSD3 = """#
# 3. Neither the name of the copyright holder nor the names of its
#    contributors may be used to endorse or promote products derived from
#    this software without specific prior written permission.
"""
APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */"""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def test_real_headers(spark):
    got = scan(
        spark,
        MIT_FULL,
        MIT_FULL.replace("\n", "\r\n"),
        BSD,
        BSD + BSD3,
        APACHE,
        GPL.format(":", ",", 3),
        GPL.format(";", ";", 2),
        "// SPDX-License-Identifier: MIT\nint main() {}",
        "/* SPDX-License-Identifier: Apache-2.0 */",
        "SPDX-License-Identifier: GPL-3.0-only",
        "This work is dedicated to the public\ndomain.",
    )
    assert [x[1] for x in got] == [
        "MIT",
        "MIT",
        "BSD-2-Clause, All-Rights-Reserved",
        "BSD-3-Clause, All-Rights-Reserved",
        "Apache-2.0",
        "GPL-3.0-or-later",
        "GPL-2.0-or-later",
        "MIT",
        "Apache-2.0",
        "GPL-3.0-only",
        "CC0-1.0",
    ]
    assert all(x[2] == "" for x in got)


def test_cuts(spark):
    assert [x[0] for x in scan(spark, "All rights. Reserved.", "Not all rights reserved", "All rights reserved\nby us", "\x01\x02All rights reserved|", "all rights reserved\nall rights reserved")] == [
        "",
        "",
        "rights",
        "rights",
        "rights, rights",
    ]
    assert [x[0] for x in scan(spark, *licenses.SENTENCES.values())] == list(licenses.SENTENCES)


def test_tables_fit():
    assert all(i in licenses.SENTENCES for r in licenses.RULES for i in r.sentences)
    assert all(any(h in s for h in licenses.HINTS) for s in licenses.SENTENCES.values())


def test_awkward_rows(awkward, empty):
    got = licenses.licence_scan(awkward)
    assert got.count() == len(awkward_rows()) and got.where("n_sentences > 0").count() == 0
    assert licenses.licence_scan(empty).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
