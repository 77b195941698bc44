"""Sentence identifiers and rule matches."""

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.license_rules import COMMON_LICENSES, GPL_COPY, GPL_REDISTRIBUTE, GPL_WARRANTY, LicenseRules, normal
from evenkeel.llm.license_scan import scan_licenses
from evenkeel.llm.queries import license_sql

GPL = [GPL_REDISTRIBUTE, GPL_WARRANTY, GPL_COPY]
TEXTS = {
    1: ("Some prose.\nReleased under the MIT License.", [("MIT", 1, 1)]),
    2: (None, []),
    3: ("", []),
    4: ("It has a licence, but none that is known. License!", []),
    5: ("# Licensed under the   APACHE license, version 2.0\n", [("Apache-2.0", 0, 0)]),
    6: (f"Intro; {GPL[0]}. It is distributed in hope, but {GPL[1][:7]}.\n{GPL[1]}. {GPL[2]}.", [("GPL-3.0-or-later", 1, 4)]),
    7: (f"{GPL[0]}.\n" + "Filler here.\n" * 3 + f"{GPL[1]}.\n{GPL[2]}.", [("GPL-3.0-or-later", 0, 0)]),
    8: (f"{GPL[1]}.\n{GPL[0]}.\n{GPL[2]}.", [("GPL-3.0-or-later", 1, 1)]),
    9: ("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.",
        [("CC-BY-NC-4.0", 0, 0), ("CC-BY-4.0", 1, 1), ("CC-BY-NC-4.0", 2, 2)]),
    10: ("Wörter über alles. " * 20_000 + "Released under the MIT License", [("MIT", 20_000, 20_000)]),
    11: ("Not Released under the MIT License.", []),
}


def test_matches(spark):
    rows = [(d, t) for d, (t, _) in TEXTS.items()] + [(1, TEXTS[1][0]), (None, TEXTS[1][0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("license", F.lit("extra"))
    out = scan_licenses(df)
    assert out.columns == ["doc_id", "license", "matches"]
    got = [(r["doc_id"], [tuple(m) for m in r["matches"]]) for r in out.collect()]
    assert len(got) == len(rows)
    for d, matches in got:
        assert matches == TEXTS[d or 1][1]
    assert scan_licenses(df.limit(0)).count() == 0
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
"""
GPL_3 = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
APACHE = """/*
 * Copyright 2020 Somebody
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
"""
BSD = """// Copyright 2020 Somebody
//
// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:
//\r
"""
GPL_2 = """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License as
 * published by the Free Software Foundation; either version 2 of the
 * License, or (at your option) any later version.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
"""


def test_wrapped_texts(spark):
    wrapped = {
        MIT: [("MIT", 0, 3)], GPL_3: [("GPL-3.0-or-later", 0, 6)], APACHE: [("Apache-2.0", 1, 3)], BSD: [("BSD", 1, 1)],
        GPL_2: [("GPL-2.0-or-later", 0, 0)], MPL: [("MPL-2.0", 0, 0)], MIT.replace("\n", "\r\n"): [("MIT", 0, 3)],
        "Licensed under the\nApache License, Version 2.0\nfor now": [("Apache-2.0", 0, 0)],
        "Permission is hereby\ngranted to nobody.": [], "Not\nReleased under the MIT\nLicense or so.": [],
        "This is free and unencumbered software released\ninto the public domain.": [("Unlicense", 0, 0)],
    }
    df = spark.createDataFrame(list(enumerate(wrapped)), "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in scan_licenses(df).collect()}
    assert got == dict(enumerate(wrapped.values()))


REFERENCES = {
    "SPDX-License-Identifier: Apache-2.0": [("Apache-2.0", 0, 0)],
    "// SPDX-License-Identifier: GPL-3.0-or-later\ncode;": [("GPL-3.0-or-later", 0, 0)],
    "This project is licensed under the MIT License - see the LICENSE file for details.": [("MIT", 0, 0)],
    "Licensed under the EUPL, Version 1.2": [("EUPL-1.2", 0, 0)],
    "                                 Apache License\n                           Version 2.0, January 2004": [("Apache-2.0", 0, 0)],
    "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n": [("LGPL-3.0-only", 0, 0)],
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof my cat.": [("MIT", 0, 0)],
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": [("CC-BY-NC-4.0", 0, 0)],
    "Intro. This library is licensed under\nthe GNU Lesser General Public License, version 2.1\nor later.": [("LGPL-2.1-or-later", 1, 1)],
    "Licensed under the GNU General Public License, version 2\nor something": [("GPL-2.0-only", 0, 0)],
    "Released under the MIT License.\nReleased under the MIT License.": [("MIT", 0, 0), ("MIT", 1, 1)],
}


def test_references_titles_and_identifiers(spark):
    df = spark.createDataFrame(list(enumerate(REFERENCES)), "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in scan_licenses(df).collect()}
    assert got == dict(enumerate(REFERENCES.values()))
    assert len(COMMON_LICENSES.sentences) > 500


def test_rules_from_a_table(spark):
    table = spark.createDataFrame(
        [("B", ["one license", "two license"], 2), ("A", ["one license", "two license", "three license"], 3),
         ("C", ["one license"], 1), ("D", ["two license"], 4)],
        "license string, sentences array<string>, position int",
    )
    rules = LicenseRules.from_table(table)
    texts = {"One license. Two license.\nThree license.": ["A"], "One license. Two license.": ["B"], "one license! x. x. x. two license": ["C", "D"],
             "three license": [], "One license. x. Two license": ["B"]}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [m["license"] for m in r["matches"]] for r in scan_licenses(df, rules).collect()}
    assert got == dict(enumerate(texts.values()))
    # Of two equally long rules over the same first sentence the one listed first wins.
    tied = LicenseRules(((0, "a license"), (1, "b license")), (("X", (0, 1)), ("Y", (0,)), ("Z", (1,))))
    assert [m["license"] for m in scan_licenses(spark.createDataFrame([("A license. B license",)], "text string"), tied).first()["matches"]] == ["X"]
    with pytest.raises(ValueError):
        LicenseRules.of([("X", ["a license"]), ("Y", ["A  license!"])])


def test_sql_has_the_same_rules(spark, tmp_path):
    """Whole rule list, sentences over several lines, matches that take sentences from later ones."""
    import duckdb

    texts = [t for t, _ in TEXTS.values() if t is None or len(t) < 10_000] + [MIT, GPL_3, APACHE, BSD, GPL_2, MPL] + list(REFERENCES)
    texts += [f"{GPL[0]}. {GPL[0]}.\n{GPL[1]}. {GPL[2]}. {GPL[1]}", f"{MIT}\n{APACHE}", APACHE.replace("compliance", "defiance")]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    theirs = {r[0]: r[1:] for r in con.execute(license_sql()).fetchall()}
    for r in scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        m = r["matches"]
        ours = (len(m), ",".join(x["license"] for x in m), m[0]["first"] if m else None, max((x["last"] for x in m), default=None))
        assert theirs[r["doc_id"]] == ours, texts[r["doc_id"]]


def test_rules_are_checked():
    assert normal("A  b, C-d!") == "a b c d"
    with pytest.raises(ValueError):
        LicenseRules(sentences=((0, "no tell tale"),), rules=())
    with pytest.raises(ValueError):
        LicenseRules(sentences=((0, "a license"),), rules=(("X", (1,)),))
