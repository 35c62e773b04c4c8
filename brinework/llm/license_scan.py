"""Licence scans by sentence rules. Built-in functions only.

A text is cut into sentences: signs before the first letter or digit of a line (comment signs,
bullets, quotes) go, empty lines part sentences, a full stop, colon, question or exclamation mark
before white space ends one, and other line ends are blanks, so wrapped and commented licences
read like plain ones. Each sentence is normalised (A-Z lower-cased, everything but letters a-z and
digits to single spaces) and looked up among known licence sentences. Of a sentence over several
lines that is not known, the last lines together and the single lines are looked up too, as
headings and short notices often end without a stop. The identifiers found, in order, are matched
against licence rules, each a run of identifiers; the first rule of the list that matches names
the licence.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: LINE parts lines, CUT sentences.
LINE, CUT = "\n", "\x02"
#: Named one by one, as a class without ranges is matched by a table of bits.
KEPT = string.digits + string.ascii_letters
#: In order, (regular expression, whether it is one, replacement): line ends, signs before a line's text, empty lines, sentence ends,
#: other signs (a single blank stays as it is), blanks at cuts. A line end beside a cut is trimmed with the sentence.
STEPS = [
    ("\r\n", False, LINE),
    ("\r", False, LINE),
    (f"(?dm)^[^{KEPT}\n]+", True, ""),
    ("\n\n", False, CUT),
    (r"[.!?:][\"')\]]*[ \t\n]+", True, CUT),
    (f"[^{KEPT}\n\x02 ][^{KEPT}\n\x02]*| [^{KEPT}\n\x02]+", True, " "),
    (" " + LINE, False, LINE),
    (LINE + " ", False, LINE),
    (" " + CUT, False, CUT),
    (CUT + " ", False, CUT),
]

# Sentences of well-known licences and notices, each whole text with its name. A rule
# of the same name holds the sentences of a text in their order.
_TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "BSD-4-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
All advertising materials mentioning features or use of this software must display the following acknowledgement:""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty.
In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at""",
    "EPL-1.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
    "WTFPL": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION""",
}
# Sentences that name a licence by themselves, or belong to several.
_SENTENCES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Distributed under the MIT License.", "The MIT License (MIT)", "The MIT License", "MIT License"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004", "Apache License 2.0"],
    "BSD": ["Licensed under the BSD License.", "Released under the BSD License."],
    "ISC": ["ISC License", "The ISC License"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "Licensed under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "BSL-1.0": ["Boost Software License - Version 1.0"],
    "proprietary": ["All rights reserved."],
}
# Families of licences of the same words, and their versions.
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_GNU_VERSIONS = ("2", "2.1", "3", "2.0", "3.0")
_CC_KINDS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
_SPDX_MARK = "SPDX-License-Identifier"
_SPDX = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "MPL-2.0", "EPL-1.0", "EPL-2.0", "Unlicense", "CC0-1.0", "WTFPL")


def _texts() -> list[tuple[str, str]]:
    """(licence, text) of every known text; the more special first where sentences are shared."""
    out = list(_TEXTS.items())
    for short, name in _GNU.items():
        for version in ("3", "2.1", "2"):
            for or_later in (True, False):
                free = f"is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation"
                full = version if "." in version else version + ".0"
                which = [f", either version {version} of the License, or (at your option) any later version."] if or_later else [f", version {version}.", f", version {version} of the License."]
                for tail in which:
                    for first in ("This program", "This library"):
                        for sign in (":", ";"):
                            out.append((f"{short}-{full}-{'or-later' if or_later else 'only'}", f"{first} {free}{tail}".replace("software:", "software" + sign)))
    for version in _GNU_VERSIONS:
        for short, name in _GNU.items():
            out += [(f"{short}-{version if '.' in version else version + '.0'}", f"{by} the {name}, version {version}.") for by in ("This work is licensed under", "Licensed under")]
    for version in ("1.1", "2.0"):
        out.append((f"Apache-{version}", f"Licensed under the Apache License, Version {version}."))
    for kind in _CC_KINDS:
        for version in _CC_VERSIONS:
            out += [(f"CC-{kind}-{version}", f"{by} CC {kind} {version}.") for by in ("Licensed under", "This work is licensed under")]
    names = [*_SPDX, *(f"{s}-{v}-{w}" for s in _GNU for v in ("2.0", "2.1", "3.0") for w in ("or-later", "only")), *(f"{s}-{v}" for s in _GNU for v in ("2.0", "2.1", "3.0"))]
    names += [f"CC-{k}-{v}" for k in _CC_KINDS for v in _CC_VERSIONS]
    out += [(name, f"{_SPDX_MARK}: {name}") for name in names]
    return out + [(name, s) for name, listed in _SENTENCES.items() for s in listed]


def cut(text: str) -> list[str]:
    """The normalised sentences of a known text, by the rules that hold for every text."""
    for old, pattern, by in STEPS:
        text = re.sub(old.replace("(?dm)", "(?m)"), by, text) if pattern else text.replace(old, by)  # here only \n ends a line anyway
    found = [s.replace(LINE, " ").strip() for s in text.lower().split(CUT)]
    return [s for s in found if re.search("[a-z]", s)]


def sentences() -> dict[str, str]:
    """Normalised sentence to identifier: the licence that has it first, and a number."""
    known, count = {cut(_SPDX_MARK)[0]: "spdx"}, dict[str, int]()
    for name, text in _texts():
        for s in cut(text):
            if s not in known:
                count[name] = count.get(name, 0) + 1
                known[s] = f"{name}.{count[name]}".lower()
    return known


def rules() -> list[tuple[str, list[str]]]:
    """(licence, run of identifiers); earlier rules win: whole texts, then long first sentences by themselves."""
    known = sentences()
    out = [(name, [known[s] for s in cut(text)]) for name, text in _texts()]
    seen = {tuple(run) for _, run in out}
    for name, text in _TEXTS.items():
        first = cut(text)[0]
        if len(first.split()) >= 15 and (known[first],) not in seen:
            seen.add((known[first],))
            out.append((name.rpartition("-")[0].removesuffix("-4") if name.startswith("BSD") else name, [known[first]]))
    return [(name, list(run)) for (name, run) in dict.fromkeys((n, tuple(r)) for n, r in out)]


def telling_signs(known: dict[str, str]) -> list[str]:
    """Texts such that a known sentence holds one of them where its line begins with CUT: long words, each time the one that most of the sentences left have, and for sentences of short words CUT and the first of them."""
    left, out = list(known), []
    while count := Counter(w for s in left for w in set(s.split()) if len(w) > 6):
        out.append(max(count, key=lambda w: (count[w], len(w), w)))
        left = [s for s in left if out[-1] not in s]
    firsts = {CUT + s.split()[0] for s in left}
    return out + sorted(w for w in firsts if not any(w != v and w.startswith(v) for v in firsts))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(docs: DataFrame, known: dict[str, str] | None = None, ordered=None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (id, n_sentences, sentence_ids, licence, licences).

    sentence_ids are the identifiers found, in order, joined by commas; licence is the first rule
    of the list that matches, licences are all, in order of the list; null licence and empty texts
    where nothing is found. A null text has no sentences. Repeated rows get a row each; other
    columns are not read.
    """
    known = sentences() if known is None else known
    ordered = rules() if ordered is None else ordered
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    starts = F.array(*[F.lit(s) for s in sorted({" ".join(s.split()[:2]) for s in known})])
    named = lambda s: F.try_element_at(table, s)

    clean = F.coalesce(F.col(text), F.lit(""))
    for old, pattern, by in STEPS:
        clean = F.regexp_replace(clean, old, by) if pattern else F.replace(clean, F.lit(old), F.lit(by))
    clean = F.lower(clean)  # by now of ASCII only

    def by_lines(lines: Column) -> Column:
        """The identifiers of the lines of a sentence up to where the rest of them is known, and of that rest; of each line where none is."""
        rest = lambda i: F.array_join(F.slice(lines, i, F.size(lines)), " ")
        begins = lambda i: F.substring_index(F.concat_ws(" ", F.element_at(lines, i), F.try_element_at(lines, i + 1)), " ", 2)
        at = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.array_contains(starts, begins(i)) & named(rest(i)).isNotNull())
        return _let(
            F.coalesce(F.try_element_at(at, F.lit(1)), F.size(lines) + 1),
            lambda first: F.concat(F.transform(F.slice(lines, 1, first - 1), named), F.array(F.when(first <= F.size(lines), named(rest(first))))),
        )

    def ids(s: Column) -> Column:
        return F.when(F.contains(s, F.lit(LINE)), _let(F.split(s, LINE), by_lines)).otherwise(F.array(named(s)))

    # a text without any of the telling signs has no known sentence
    begun = F.concat(F.lit(CUT), F.replace("clean", F.lit(LINE), F.lit(CUT)))
    told = reduce(or_, [F.contains("begun", F.lit(w)) for w in telling_signs(known)], F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), clean.alias("clean")).select("id", "clean", begun.alias("begun")).select("id", told.alias("told"), F.filter(F.transform(F.split("clean", CUT), lambda s: F.btrim(s, F.lit(" \n"))), lambda s: s != "").alias("sentences"))
    found = F.when(F.col("told"), F.array_compact(F.flatten(F.transform("sentences", ids)))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("id", F.size("sentences").cast("bigint").alias("n_sentences"), F.array_join(found, ",").alias("sentence_ids"))
    # a rule is one comparison with the joined identifiers; most documents have none
    line = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    hits = F.array(*[F.when(F.contains(line, F.lit("," + ",".join(run) + ",")), name) for name, run in ordered])
    names = F.when(F.col("sentence_ids") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array_compact(hits)))
    return rows.select("*", names.alias("names")).select(
        F.col("id").alias(id_col),
        "n_sentences",
        "sentence_ids",
        F.try_element_at("names", F.lit(1)).alias("licence"),
        F.array_join("names", ",").alias("licences"),
    )
