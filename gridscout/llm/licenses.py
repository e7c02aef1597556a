"""Licence scans: known licence sentences, and licences as ordered rules over them. Built-in functions only.

A text is read twice, once with every line end as a sentence end and once with blank lines only, so that
one-line notices and wrapped paragraphs are both found. Sentences are normalised and looked up in the
table below; what remains is a short sequence of identifiers, matched against the rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscout.llm.common import unique_texts

# Sentences of public licence texts and of customary notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        'the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software"
    ),
    "mit-grant-head": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        'the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions:"
    ),
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies"
    ),
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-limits": "See the License for the specific language governing permissions and limitations under the License",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl3-notice-2": "Licensed under the GNU General Public License, version 3",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "gpl2-free": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    ),
    "gpl-details": "See the GNU General Public License for more details",
    "lgpl3-notice": "Licensed under the GNU Lesser General Public License, version 3",
    "agpl3-notice": "Licensed under the GNU Affero General Public License, version 3",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"
    ),
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution"
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission"
    ),
    "lgpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "lgpl21-free": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"
    ),
    "lgpl-hope": (
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
    ),
    "lgpl-details": "See the GNU Lesser General Public License for more details",
    "agpl3-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "agpl-details": "See the GNU Affero General Public License for more details",
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:"
    ),
    "bsl-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        'documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject "
        "to the following:"
    ),
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0",
    "epl2-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available "
        "at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "epl1-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies "
        "this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "cddl-notice": 'The contents of this file are subject to the terms of the Common Development and Distribution License (the "License")',
    "artistic2-notice": "Licensed under the Artistic License 2.0",
    "bsd-notice": "Licensed under the BSD 3-Clause License",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
# Identifiers of public licences that stand behind `SPDX-License-Identifier:`.
SPDX = """0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0
CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only
LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib""".split()
SENTENCES |= {f"spdx-{name.lower()}": f"SPDX-License-Identifier: {name}" for name in SPDX}
# The sentences, in this order, by which a licence is recognised. Other sentences may stand between.
RULES = [
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("MIT", ["mit-notice-3"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-grant-head", "mit-keep"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-copy", "apache-limits"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-only", ["gpl3-notice-2"]),
    ("GPL-2.0-only", ["gpl2-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "gpl-hope", "lgpl-details"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope", "lgpl-details"]),
    ("AGPL-3.0-or-later", ["agpl3-free", "gpl-hope", "agpl-details"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-notice"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("EPL-1.0", ["epl1-notice"]),
    ("CDDL-1.0", ["cddl-notice"]),
    ("Artistic-2.0", ["artistic2-notice"]),
    ("LGPL-3.0-only", ["lgpl3-notice"]),
    ("AGPL-3.0-only", ["agpl3-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-long"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-long"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    *[(name, [f"spdx-{name.lower()}"]) for name in SPDX],
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_LINE = r"\n[\x09-\x0D\x20]*\n"
#: Every sentence of the table holds one of these; a text without any is not read further.
MARKS = ["licen", "permission", "redistribution", "warranty", "unencumbered", "copyright"]


def cuts() -> list[tuple[str, str]]:
    """(pattern, replacement) in turn, on the lower-cased text; a sentence ends at two line ends. \\1 and \\2 stand for groups.

    A list begins a sentence, behind a colon. Comment marks at line starts go, so that a line of nothing else is blank. No
    sentence ends at `v.` before a number, nor between "at" and a URL. A line that begins as a long sentence of the table
    begins a sentence, whatever title stands above it. Sentences end at marks before white space.
    """
    bullet, space, blank = "\u2022", r"[\x09-\x0D\x20]+", r"[\x09\x20]*"
    a_list = (rf":{space}(?:\(?[0-9]{{1,2}}[.)]|\(?[a-z]\)|[*{bullet}-]){space}", "\n\n")
    long = sorted({tuple(x.split()[:4]) for x in normal_sentences() if len(x.split()) > 12})
    openings = "|".join("[^a-z0-9]+".join(words) for words in long)
    return [
        a_list,
        (rf"(^|\n){blank}(?:/\*+|\*+/|\*+|//+|#+|;+|--+|%+|<!--+){blank}", r"\1"),
        a_list,
        (rf"(^|[^a-z0-9])v\.{space}([0-9])", r"\1v \2"),
        (rf"(^|[^a-z0-9])at:?{space}(https?://)", r"\1at \2"),
        (rf"\n{blank}({openings})", r"\n\n\1"),
        (rf"[.!?]+{space}", "\n\n"),
    ]


def normal(sentence: str) -> str:
    """A-Z lower-cased, every run of other characters than a-z and 0-9 a blank, trimmed."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence).lower()
    return " ".join(kept.split())


def normal_sentences() -> dict[str, str]:
    """Identifier by normalised sentence; a text of one entry must be cut into that entry alone."""
    return {normal(text): name for name, text in SENTENCES.items()}


def more_specific(rules=RULES) -> dict[int, list[int]]:
    """For each rule, those whose identifiers contain all of its own in order, and more."""

    def within(a: list[str], b: list[str]) -> bool:
        rest = iter(b)
        return all(x in rest for x in a)

    return {i: [j for j, (_, b) in enumerate(rules) if len(b) > len(a) and within(a, b)] for i, (_, a) in enumerate(rules)}


def _identifiers(text: Column) -> Column:
    known = normal_sentences()
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])

    def of(split: Column) -> Column:
        cleaned = F.transform(split, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
        return F.transform(F.filter(cleaned, lambda s: s.isin(*known)), lambda s: F.element_at(names, s))

    lowered = F.translate(F.concat(text, F.lit(" ")), UPPER, LOWER)
    ended = lowered
    for pattern, replacement in cuts():
        ended = F.regexp_replace(ended, pattern, replacement.replace("\\n", "\n").replace("\\1", "$1").replace("\\2", "$2"))
    by_line, by_paragraph = F.split(ended, "\n"), F.split(ended, BLANK_LINE)
    found = F.struct(of(by_line).alias("a"), of(by_paragraph).alias("b"))
    none = F.array().cast("array<string>")
    marked = reduce(lambda x, y: x | y, [F.contains(lowered, F.lit(m)) for m in MARKS])
    return F.when(marked, found).otherwise(F.struct(none.alias("a"), none.alias("b")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """(id, n_sentences, sentence_ids, licenses) per document.

    sentence_ids: the identifiers found, in text order, of the reading that has more of them (of equally
    many, by lines). licenses: the licences whose rule holds in either reading, sorted and distinct. A
    rule is passed over where a more specific one (more sentences, its own among them in order) holds.

    A null, empty or unlicensed text has no sentences and no licences. A sentence that occurs several
    times is listed each time. Several rows of one id count as one, see `unique_texts`; rows without an
    id are left out. An empty table gives an empty table. Other columns of `docs` play no part, whatever
    they are called.
    """
    rows = unique_texts(docs, id_col, text_col).select(F.col(id_col).alias("_id"), _identifiers(F.coalesce(F.col(text_col), F.lit(""))).alias("_found"))
    rows = rows.select("_id", F.col("_found.a").alias("_a"), F.col("_found.b").alias("_b"))
    holds = []
    for _, names in rules:
        pattern = "%" + "%".join(f"|{x}|" for x in names) + "%"
        sequence = [F.concat(F.lit("|"), F.array_join(c, "||"), F.lit("|")).like(pattern) for c in ("_a", "_b")]
        holds.append(sequence[0] | sequence[1])
    found = rows.withColumn("_holds", F.when(F.size("_a") + F.size("_b") > 0, F.array(*holds)))
    names = []
    for i, more in more_specific(rules).items():
        ok = F.element_at("_holds", i + 1)
        for j in more:
            ok = ok & ~F.element_at("_holds", j + 1)
        names.append(F.when(ok, F.lit(rules[i][0])))
    licenses = F.when(F.col("_holds").isNull(), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))))
    longer = F.when(F.size("_b") > F.size("_a"), F.col("_b")).otherwise(F.col("_a"))
    return found.select(F.col("_id").alias(id_col), F.size(longer).cast("long").alias("n_sentences"), longer.alias("sentence_ids"), licenses.alias("licenses"))
