"""Licence rules: sentences by which licences are recognised, most of them made from names and phrases.

A rule is a licence with the sentences, in order, that stand for it. The rules here are whole
sentences of licence texts and headers, and for every licence below its identifier line, its
titles, and the phrases that refer to it by each of its names. ``LicenseRules.from_table`` takes
rules from a table instead.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

MAX_RULES = 20_000
TELLTALES = ("licen", "permission", "redistribut", "warranty", "unencumbered")

# Sentences as they stand in licence texts, and the licences of runs of them.
MIT_FIRST_LINE = "Permission is hereby granted, free of charge, to any person obtaining a copy"
MIT_GRANT = (
    f'{MIT_FIRST_LINE} of this software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
    "sell copies of the Software"
)
MIT_CONDITIONS = ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"
)
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License")'
APACHE_COMPLIANCE = "you may not use this file except in compliance with the License"
APACHE_COPY = "You may obtain a copy of the License at"
_GNU = "you can redistribute it and/or modify it under the terms of the GNU"
_FSF = "as published by the Free Software Foundation"
_LATER = "of the License, or (at your option) any later version"
GPL_REDISTRIBUTE = f"This program is free software: {_GNU} General Public License {_FSF}, either version 3 {_LATER}"
GPL_WARRANTY = "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"
GPL_COPY = "You should have received a copy of the GNU General Public License along with this program"
TEXT_RULES = (
    ("Apache-2.0", (APACHE, APACHE_COMPLIANCE, APACHE_COPY)),
    ("Apache-2.0", (APACHE, APACHE_COMPLIANCE)),
    ("Apache-2.0", (APACHE,)),
    ("MIT", ("MIT License", MIT_GRANT + MIT_CONDITIONS, MIT_NOTICE)),
    ("MIT", (MIT_GRANT, MIT_NOTICE)),
    ("MIT", (MIT_GRANT + MIT_CONDITIONS, MIT_NOTICE)),
    ("MIT", (MIT_FIRST_LINE,)),
    ("GPL-3.0-or-later", (GPL_REDISTRIBUTE, GPL_WARRANTY, GPL_COPY)),
    ("GPL-3.0-or-later", (GPL_REDISTRIBUTE,)),
    ("GPL-2.0-or-later", (f"This program is free software; {_GNU} General Public License {_FSF}; either version 2 {_LATER}",)),
    ("GPL-2.0-only", (f"This program is free software; {_GNU} General Public License version 2 {_FSF}",)),
    ("LGPL-2.1-or-later", (f"This library is free software; {_GNU} Lesser General Public License {_FSF}; either version 2.1 {_LATER}",)),
    ("LGPL-3.0-or-later", (f"This program is free software: {_GNU} Lesser General Public License {_FSF}, either version 3 {_LATER}",)),
    ("AGPL-3.0-or-later", (f"This program is free software: {_GNU} Affero General Public License {_FSF}, either version 3 {_LATER}",)),
    ("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",)),
    ("BSD", ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met",)),
    ("BSD", ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",)),
    ("MIT", ("Use of this source code is governed by an MIT-style license that can be found in the LICENSE file",)),
    ("ISC", ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",)),
    ("ISC", ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies",)),
    ("Zlib", ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
              "alter it and redistribute it freely, subject to the following restrictions",)),
    ("Unlicense", ("This is free and unencumbered software released into the public domain",)),
    ("CC0-1.0", ("This work has been dedicated to the public domain under a CC0 license",)),
)

# Identifiers with the names they go by.
NAMES = (
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License")),
    ("Apache-1.1", ("Apache License, Version 1.1", "Apache Software License, Version 1.1")),
    ("MIT", ("MIT License", "MIT license (MIT)")),
    ("MIT-0", ("MIT No Attribution License",)),
    ("ISC", ("ISC License",)),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License")),
    ("BSD-4-Clause", ("BSD 4-Clause License",)),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD License")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("Zlib", ("zlib License", "zlib/libpng License")),
    ("Unlicense", ("Unlicense",)),
    ("WTFPL", ("Do What The Fuck You Want To Public License",)),
    ("MPL-1.1", ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1")),
    ("MPL-2.0", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0")),
    ("EPL-1.0", ("Eclipse Public License, Version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0")),
    ("EPL-2.0", ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0")),
    ("EUPL-1.1", ("EUPL, Version 1.1", "European Union Public Licence, Version 1.1")),
    ("EUPL-1.2", ("EUPL, Version 1.2", "European Union Public Licence, Version 1.2")),
    ("CDDL-1.0", ("Common Development and Distribution License, Version 1.0",)),
    ("Artistic-2.0", ("Artistic License 2.0", "Artistic License, Version 2.0")),
    ("PSF-2.0", ("Python Software Foundation License, Version 2", "PSF License")),
    ("PostgreSQL", ("PostgreSQL License",)),
    ("OFL-1.1", ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1")),
    ("NCSA", ("University of Illinois/NCSA Open Source License",)),
    ("MS-PL", ("Microsoft Public License",)),
    ("ODbL-1.0", ("Open Database License, Version 1.0", "Open Data Commons Open Database License")),
    ("PDDL-1.0", ("Open Data Commons Public Domain Dedication and License",)),
    ("CC0-1.0", ("CC0 1.0 Universal License", "CC0 License")),
)
GNU = (
    ("GPL", "GNU General Public License", ("2.0", "3.0")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
    ("AGPL", "GNU Affero General Public License", ("3.0",)),
    ("GFDL", "GNU Free Documentation License", ("1.1", "1.2", "1.3")),
)
TITLES = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
)
CC_TERMS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"2.0": "Generic", "3.0": "Unported", "4.0": "International"}
PHRASES = (
    "Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under",
    "This software is licensed under", "This program is licensed under", "This library is licensed under",
)
REFERENCES = (" - see the LICENSE file for details", " - see the LICENSE.md file for details")


def normal(sentence: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split())


def named_licenses() -> list[tuple[str, tuple[str, ...]]]:
    """Every identifier with its names."""
    out = list(NAMES)
    for short, name, versions in GNU:
        for v in versions:
            n = v.removesuffix(".0")
            out.append((f"{short}-{v}-only", (f"{name}, version {n}", f"{name} v{n}", f"{name}, version {n} only")))
            out.append((f"{short}-{v}-or-later", (f"{name}, version {n} or later", f"{name} v{n} or later")))
    for kind in CC_KINDS:
        long_name = "-".join(CC_TERMS[t] for t in kind.split("-"))
        for v, where in CC_VERSIONS.items():
            full = f"Creative Commons {long_name} {v}"
            out.append((f"CC-{kind}-{v}", (f"CC {kind} {v}", f"{full} {where} License", f"{full} License")))
    return out


def reference_sentences() -> Iterable[tuple[str, str]]:
    """(licence, sentence): identifier lines, titles, and phrases with each name."""
    yield from TITLES
    for license_name, names in named_licenses():
        yield license_name, f"SPDX-License-Identifier: {license_name}"
        for name in names:
            yield license_name, name
            articles = ("the ", "a ") if name.startswith("Creative") else ("the ", "")
            for phrase in PHRASES:
                for article in articles:
                    yield license_name, f"{phrase} {article}{name}"
            for reference in REFERENCES:
                yield license_name, f"This project is licensed under the {name}{reference}"


@dataclass(frozen=True)
class LicenseRules:
    """Normalised sentences by identifier, and rules over them. Of equally long rules the earlier one wins."""

    sentences: tuple[tuple[int, str], ...]
    rules: tuple[tuple[str, tuple[int, ...]], ...]
    telltales: tuple[str, ...] = TELLTALES
    max_gap: int = 2

    def __post_init__(self) -> None:
        known = set(range(len(self.sentences)))
        if len({text for _, text in self.sentences}) != len(known) or [i for i, _ in self.sentences] != sorted(known):
            raise ValueError("sentences need to be different and numbered from 0")
        for i, text in self.sentences:
            if not any(t in text for t in self.telltales):
                raise ValueError(f"sentence {i}, {text!r}, has no telltale word")
        for license_name, ids in self.rules:
            if not ids or not set(ids) <= known:
                raise ValueError(f"a rule of {license_name} names no sentence, or an unknown one")

    @classmethod
    def of(cls, rules: Iterable[tuple[str, Iterable[str]]], telltales: tuple[str, ...] = TELLTALES, max_gap: int = 2) -> LicenseRules:
        """From licences with their sentences as written; a rule given twice counts once."""
        numbers: dict[str, int] = {}
        kept: dict[tuple[int, ...], str] = {}
        for license_name, sentences in rules:
            ids = tuple(numbers.setdefault(normal(s), len(numbers)) for s in sentences)
            if kept.setdefault(ids, license_name) != license_name:
                raise ValueError(f"{kept[ids]} and {license_name} have the same rule")
        sentences = tuple((i, text) for text, i in numbers.items())
        return cls(sentences, tuple((name, ids) for ids, name in kept.items()), telltales, max_gap)

    @classmethod
    def from_table(cls, table: DataFrame, telltales: tuple[str, ...] = TELLTALES, max_gap: int = 2) -> LicenseRules:
        """From a table (license, sentences, optionally position, which orders rules; else they are ordered by their content).

        Rules are sent to every task inside the plan, so a table of more than ``MAX_RULES`` is refused.
        """
        order = ["position"] if "position" in table.columns else []
        rows = table.select("license", "sentences", *order).orderBy(*order, "license", F.col("sentences")).limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules are too many for a plan")
        return cls.of([(r["license"], r["sentences"]) for r in rows], telltales, max_gap)


def common_licenses() -> LicenseRules:
    telling = [(name, (s,)) for name, s in reference_sentences() if any(t in normal(s) for t in TELLTALES)]
    return LicenseRules.of([*TEXT_RULES, *telling])


COMMON_LICENSES = common_licenses()
