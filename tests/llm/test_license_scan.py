from pyspark.sql import functions as F

from drivelake.llm import license_scan as L
from drivelake.llm import queries

KNOWN = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
         "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op7_license_scan"](spark, sf)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = {r.doc_id: r for r in found.collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    own = {d.doc_id: next((v for k, v in KNOWN.items() if k in d.text), None) for d in docs}
    assert {k: r.own_licence for k, r in rows.items()} == own and sum(v is not None for v in own.values()) > 10
    for d in docs:  # the nearest directory above with a licence file, by brute force
        parts = rows[d.doc_id].path.split("/")[:-1]
        above = None
        for n in range(len(parts), 0, -1):
            names = [own[o.doc_id] for o in docs if rows[o.doc_id].path.split("/") == [*parts[:n], "LICENSE"] and own[o.doc_id]]
            if names:
                above = min(names, key=lambda x: (-names.count(x), x))
                break
        assert rows[d.doc_id].licence == (own[d.doc_id] or above)
    assert sum(r.origin == "inherited" for r in rows.values()) > 5


def test_inheritance_and_odd_rows(spark, odd_docs, no_docs):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", mit), (2, "a/b/c/x.py", "code"), (3, "a/b/c/LICENSE", gpl), (4, "a/b/y.py", "code"), (5, "z/q.py", None), (6, None, mit), (7, None, "none"), (8, "top", "code"),
             (9, "a/b/c/d/own.py", "x = 1\n# Licensed under the Apache License, Version 2.0.\n" + "word " * 500), (9, "a/b/c/d/own.py", "code"), (10, "z/n.py", "this license is about something else entirely, with no notice")]
    docs = spark.createDataFrame([(*f, "x") for f in files], "doc_id long, path string, text string, licence string")
    got = sorted((r.doc_id, str(r.path), str(r.licence), r.origin) for r in L.scan(spark, docs, F.col("path")).collect())
    assert got == sorted([(1, "a/LICENSE", "MIT", "own"), (2, "a/b/c/x.py", "GPL-3.0", "inherited"), (3, "a/b/c/LICENSE", "GPL-3.0", "own"), (4, "a/b/y.py", "MIT", "inherited"),
                          (5, "z/q.py", "None", "none"), (6, "None", "MIT", "own"), (7, "None", "None", "none"), (8, "top", "None", "none"), (9, "a/b/c/d/own.py", "Apache-2.0", "own"),
                          (9, "a/b/c/d/own.py", "GPL-3.0", "inherited"), (10, "z/n.py", "None", "none")])
    assert L.scan(spark, odd_docs, F.col("source")).count() == odd_docs.count()
    assert L.scan(spark, no_docs, F.col("source")).count() == 0


MIT_TEXT = """MIT License

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
SOFTWARE.
"""


def test_full_licence_files_by_name(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "a/LICENSE", MIT_TEXT), (2, "a/b/x.py", "code"), (3, "a/one.py", gpl), (4, "a/two.py", gpl), (5, "a/y.py", "code"), (6, "c/LICENCE.txt", MIT_TEXT), (7, "c/z.py", "code"),
             (8, "d/long.py", MIT_TEXT), (9, "d/z.py", "code"), (10, "e/MIT-COPYING", MIT_TEXT), (11, "e/z.py", "code"), (12, "f/noticeboard.py", MIT_TEXT), (13, "f/z.py", "code"), (14, "f/license_scan.py", MIT_TEXT)]
    got = {r.doc_id: (r.licence, r.origin) for r in L.scan(spark, spark.createDataFrame(files, "doc_id long, path string, text string"), F.col("path")).collect()}
    assert all(got[i] == ("MIT", "inherited") for i in (2, 5, 7, 11)) and got[3] == ("GPL-3.0", "own")
    assert all(got[i] == (None, "none") for i in (9, 13)) and all(got[i] == ("MIT", "own") for i in (1, 6, 8, 10, 12, 14))


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
OTHERS = [
    ("MIT", MIT_TEXT), ("BSD-2-Clause", BSD), ("BSD-3-Clause", BSD + THIRD),
    ("GPL-2.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n"),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\n  Version 2.1, February 1999\n"), ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\n  Version 3, 19 November 2007\n"), ("Apache-2.0", "Apache License\n   Version 2.0, January 2004\n http://www.apache.org/licenses/\n"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n"), ("CC-BY-SA-4.0", "This text is licensed under CC BY-SA 4.0."),
    ("MIT", "// SPDX-License-Identifier: MIT"), ("EPL-2.0", "# SPDX-License-Identifier: EPL-2.0\nx = 1"), ("MIT OR Apache-2.0", "/* SPDX-License-Identifier: MIT OR Apache-2.0 */"),
    ("GPL-2.0-only WITH Linux-syscall-note", "/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */"),
]


def test_notices_and_texts_of_common_licences(spark):
    docs = spark.createDataFrame([(i, f"d{i}/x.c", t) for i, (_, t) in enumerate(OTHERS)], "doc_id long, path string, text string")
    got = {r.doc_id: r.own_licence for r in L.scan(spark, docs, F.col("path")).collect()}
    assert [got[i] for i in range(len(OTHERS))] == [x for x, _ in OTHERS]
