import re
import textwrap

from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame

from gridscout.llm import licenses as L

MIT = """Copyright (c) someone

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
* Neither the name of the copyright holder nor the names of its contributors may be
  used to endorse or promote products derived from this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def brute(text):
    known = L.normal_sentences()
    ended = (text or "").translate(str.maketrans(L.UPPER, L.LOWER)) + " "
    for pattern, replacement in L.cuts():
        ended = re.sub(pattern, replacement, ended)
    readings = []
    for parts in (ended.split("\n"), re.split(r"\n[\t-\r ]*\n", ended)):
        readings.append([known[n] for p in parts if (n := " ".join(re.findall("[a-z0-9]+", p.translate(str.maketrans(L.UPPER, L.LOWER))))) in known])

    def holds(names):
        return any(all(x in rest for x in names) for rest in map(iter, readings))

    held = [i for i, (_, names) in enumerate(L.RULES) if holds(names)]
    more = L.more_specific()
    a, b = readings
    return (b if len(b) > len(a) else a), sorted({L.RULES[i][0] for i in held if not set(more[i]) & set(held)})


def found(df):
    return {i: (list(r.sentence_ids), list(r.licenses)) for i, r in by_id(df).items()}


TEXTS = {
    1: MIT,
    2: BSD2,
    3: BSD3,
    4: GPL,
    5: "Prose here.\nLicensed under the Apache License, Version 2.0.",
    6: "prose without an end\nReleased under the MIT License.\nmore",
    7: "RELEASED   under the\tmit license! Licensed under CC BY-NC 4.0. Released under the MIT License.",
    8: "This is not released under the MIT License.",
    9: "See the GNU General Public License for more details. " + GPL.split("See the")[0],
    10: MIT + "\n\n" + GPL,
    11: None,
    12: "",
}


def test_licence_texts(spark):
    out = found(L.scan_licenses(frame(spark, list(TEXTS.items()))))
    assert {i: x[1] for i, x in out.items()} == {
        1: ["MIT"], 2: ["BSD-2-Clause"], 3: ["BSD-3-Clause"], 4: ["GPL-3.0-or-later"], 5: ["Apache-2.0"], 6: ["MIT"], 7: ["CC-BY-NC-4.0", "MIT"],
        8: [], 9: [], 10: ["GPL-3.0-or-later", "MIT"], 11: [], 12: [],
    }
    assert out[7][0] == ["mit-notice", "cc-by-nc-4", "mit-notice"]
    assert out == {i: brute(t) for i, t in TEXTS.items()}


def test_awkward_rows(spark):
    assert found(L.scan_licenses(frame(spark, awkward_rows()))) == {i: brute(t) for i, t in awkward_texts().items()}
    assert L.scan_licenses(frame(spark, [])).collect() == []


def test_table():
    assert len(L.normal_sentences()) == len(L.SENTENCES)
    assert {x for _, names in L.RULES for x in names} <= L.SENTENCES.keys()
    plan_text = L.normal("(the \"Software\"), to deal -- a's")
    assert plan_text == "the software to deal a s"


def test_no_python_in_the_plan(spark):
    plan = L.scan_licenses(frame(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
FREEBSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def test_every_entry_survives_the_cut(spark):
    names = list(L.SENTENCES)
    for write in (str, lambda s: "prose before.\n\n" + textwrap.fill(s, 60) + ".\nMore prose.\n"):
        rows = [(i, write(L.SENTENCES[name])) for i, name in enumerate(names)]
        assert {i: x[0] for i, x in found(L.scan_licenses(frame(spark, rows))).items()} == {i: [name] for i, name in enumerate(names)}


def test_version_marks_lists_and_urls(spark):
    bsd = ["bsd-grant", "bsd-source", "bsd-binary"]
    bullets = FREEBSD.replace("1.", "*").replace("2.", "*")
    texts = {
        1: (MPL, ["mpl2-notice"], ["MPL-2.0"]),
        2: (FREEBSD, bsd, ["BSD-2-Clause"]),
        3: (bullets, bsd, ["BSD-2-Clause"]),
        4: (FREEBSD.replace("1.", "(1)").replace("2.", "(2)"), bsd[:2], []),
        5: (FREEBSD + "3. " + BSD3[len(BSD2) :].lstrip("\n* "), [*bsd, "bsd-names"], ["BSD-3-Clause"]),
        6: (APACHE, ["apache-header", "apache-copy", "apache-limits"], ["Apache-2.0"]),
        7: (APACHE.split("License.\n", 1)[1], ["apache-copy", "apache-limits"], ["Apache-2.0"]),
        8: ("v. 2.0. At:\n1. one\n\nMIT License.", ["mit-title-2"], []),
    }
    assert found(L.scan_licenses(frame(spark, [(i, t) for i, (t, _, _) in texts.items()]))) == {i: (a, b) for i, (_, a, b) in texts.items()}


ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented."""
GPL2 = GPL.replace("free software:", "free software;").replace("Foundation, either version 3", "Foundation; either version 2")
COMMENTS = ["", "# ", " * ", "// ", "-- ", ";; ", "% ", "/// ", "## ", "    # "]


def commented(text: str, mark: str, end: str = "\n") -> str:
    return end.join((mark + line).rstrip() for line in text.split("\n"))


def test_headers_in_comments(spark):
    known = {"Apache-2.0": APACHE, "GPL-2.0-or-later": GPL2, "GPL-3.0-or-later": GPL, "MIT": MIT, "MPL-2.0": MPL, "BSD-2-Clause": FREEBSD, "BSD-3-Clause": BSD3, "Zlib": ZLIB}
    texts, expected = {}, {}

    def add(text, name):
        expected[len(texts)] = [name]
        texts[len(texts)] = text

    for name, text in known.items():
        for mark in COMMENTS:
            for end in ("\n", "\r\n"):
                add(commented(text, mark, end), name)
            add(commented("a program that does things\n" + text, mark), name)
            add("import os\n" + commented(text, mark) + "\n\nprint(1)\n", name)
        add("/*\n" + commented(text, " * ") + "\n */\nint main;", name)
        add("/**\n" + commented("Copyright 2020 someone\n\n" + text, " * ") + "\n */", name)
        add("<!--\n" + text + "\n-->", name)
        add("/* " + text + " */", name)
    for name in L.SPDX:
        for mark in COMMENTS:
            add(f"int x;\n{mark}SPDX-License-Identifier: {name}\nint y;", name)
        add(f"/* SPDX-License-Identifier: {name} */", name)
    out = found(L.scan_licenses(frame(spark, list(texts.items()))))
    wrong = {i: (texts[i], x) for i, x in out.items() if x[1] != expected[i]}
    assert not wrong, (len(wrong), list(wrong.values())[:2])
    assert out == {i: brute(t) for i, t in texts.items()}


def test_every_entry_behind_every_comment_mark(spark):
    rows, names = [], []
    for name, text in L.SENTENCES.items():
        for mark in COMMENTS:
            rows.append((len(rows), commented(textwrap.fill(text, 60, break_on_hyphens=False) + ".\nMore prose.\n", mark)))
            names.append(name)
    assert {i: x[0] for i, x in found(L.scan_licenses(frame(spark, rows))).items()} == {i: [name] for i, name in enumerate(names)}


def test_sql_finds_the_same(spark):
    import duckdb

    from gridscout.llm.oracles import ORACLES

    texts = [commented(t, m) for t in (APACHE, GPL2, GPL, MIT, MPL, FREEBSD, BSD3, ZLIB) for m in COMMENTS] + [f"# SPDX-License-Identifier: {n}" for n in L.SPDX]
    texts += [t for t in awkward_texts().values() if t is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    columns = ["doc_id", "n_sentences", "sentence_ids", "licenses"]
    theirs = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op4_license_scan']})").fetchall())
    out = found(L.scan_licenses(frame(spark, list(enumerate(texts)))))
    assert theirs == [(i, len(out[i][0]), ",".join(out[i][0]), ",".join(out[i][1])) for i in sorted(out)]


def test_every_sentence_holds_a_mark():
    assert all(any(m in x.split() or m in x for m in L.MARKS) for x in L.normal_sentences())
