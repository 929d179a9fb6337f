"""Licence recognition: known sentences, then rules over their order; DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.registry import query
from goldseam.workloads.registry import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Sentences of public licences and notices, by identifier.
SENTENCES = {
    1: "Released under the MIT License.",
    2: "Licensed under the MIT License.",
    3: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    4: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    5: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    6: "Licensed under the Apache License, Version 2.0.",
    7: "Licensed under the Apache License, Version 2.0 (the \"License\");",
    8: "you may not use this file except in compliance with the License.",
    9: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    10: "This work is licensed under the GNU General Public License, version 3.",
    11: "This program is free software:",
    12: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    13: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    14: "Licensed under CC BY-NC 4.0.",
    15: "Licensed under CC BY 4.0.",
    16: "Licensed under CC BY-SA 4.0.",
    17: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    18: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    19: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    20: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    21: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    22: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    23: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    24: "This is free and unencumbered software released into the public domain.",
    25: "All rights reserved.",
}
#: A rule holds where its identifiers follow each other among the known sentences.
RULES = {
    "MIT": [(1,), (2,), (3, 4, 5)],
    "Apache-2.0": [(6,), (7, 8, 9)],
    "GPL-3.0": [(10,), (11, 12)],
    "GPL-2.0": [(11, 13)],
    "CC-BY-NC-4.0": [(14,)],
    "CC-BY-4.0": [(15,)],
    "CC-BY-SA-4.0": [(16,)],
    "BSD-2-Clause": [(17, 18, 19)],
    "BSD-3-Clause": [(17, 18, 19, 20)],
    "ISC": [(21,)],
    "MPL-2.0": [(22, 23)],
    "Unlicense": [(24,)],
    "All-Rights-Reserved": [(25,)],
}
#: Sentences and wordings that only the joined form knows; the SQL twin has those above.
MORE = {
    "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.": 9,
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NON-INFRINGEMENT.": 5,
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": 21,
    "This library is free software;": 101,
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": 102,
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.": 103,
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": 104,
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": 105,
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:": 106,
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:": 107,
}
MORE_RULES = {
    "LGPL-3.0": [(11, 102), (101, 102)],
    "LGPL-2.1": [(11, 103), (101, 103)],
    "AGPL-3.0": [(11, 104)],
    "0BSD": [(105,)],
    "BSL-1.0": [(106,)],
    "Zlib": [(107,)],
}
#: A sentence of so few words that is a rule by itself has to be a whole sentence or paragraph in
#: the joined form; longer ones may also start or end with a line.
SHORT_WORDS = 15
#: A rule that a longer one contains is not reported beside it.
CONTAINED = {"BSD-2-Clause": "BSD-3-Clause"}
#: Every known sentence holds one of these; texts without them have no known sentence.
CUES = ("licen", "permission", "software", "redistribut", "mpl", "copyright", "rights")
_END = r"([.!?:;])[ \t\r\n\f]+"


def normal(sentence: str) -> str:
    folded = sentence.translate(str.maketrans(UPPER, LOWER))
    return re.sub("[^a-z0-9]+", " ", folded).strip()


def _known() -> dict[str, int]:
    """Identifiers by normalised sentence; one cut by its own inner sentence ends is kept by parts."""
    out = {normal(s): i for i, s in SENTENCES.items()}
    assert all(any(c in s for c in CUES) for s in out)
    return out


# "v. 2.0" would end a sentence; such short forms are joined before cutting.
_SHORT = r"(?i)\bv\.[ \t\r\n\f]+"


def _sequence(text: Column) -> Column:
    """Known identifiers in the order of the text, as ``,1,2,``."""
    known = F.create_map(*[F.lit(x) for pair in _known().items() for x in pair])
    cut = F.split(F.regexp_replace(text, _END, "$1\n"), "\n")
    plain = F.transform(cut, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))
    ids = F.filter(F.transform(plain, lambda s: known[s]), lambda i: i.isNotNull())
    return F.concat(F.lit(","), F.concat_ws(",", F.transform(ids, lambda i: i.cast("string"))), F.lit(","))


# Marks in the joined form: a sentence end; a blank line or the end of a copyright or title line; any
# other line break.
_STOP, _GAP, _BREAK = "\x01", "\x02", "\x03"
# Linear in the length of a line: no two neighbouring parts can share out the same characters.
_MARKS = r"[^a-z0-9\r\n]"
_TITLE = (
    rf"(?m)(^|{_STOP})([^a-z0-9\r\n{_STOP}]*(?:(?:copyright|\(c\)|\u00a9)[^\r\n]*+"
    rf"|[^\r\n]{{0,60}}\blicen[cs]e(?:{_MARKS}*+(?=[\r\n])|(?>{_MARKS}*\([^()\r\n]*+\)){_MARKS}*+)))[\r\n]+"
)


def _joined_known() -> dict[str, int]:
    return {**_known(), **{normal(s): i for s, i in MORE.items()}}


def _joined_pattern() -> str:
    """Every known sentence between two marks, with line breaks between any two words."""
    alone = {rule[0] for rules in [*RULES.values(), *MORE_RULES.values()] for rule in rules if len(rule) == 1}
    strict, loose = [], []
    for sentence, i in _joined_known().items():
        words = sentence.split(" ")
        if i in alone and len(words) < SHORT_WORDS:
            strict.append(f"(?: {_BREAK})? ".join(words))
        else:
            loose.append(f"(?: [{_GAP}{_BREAK}])? ".join(words))
    return (
        rf"(?<=[{_STOP}{_GAP}{_BREAK}] )(?:{'|'.join(loose)})(?= [{_STOP}{_GAP}{_BREAK}])"
        rf"|(?<=[{_STOP}{_GAP}] )(?:{'|'.join(strict)})(?= [{_STOP}{_GAP}])"
    )


def _joined(text: Column) -> Column:
    """Known identifiers in the order of the text, where the ends of sentences and of lines both
    count as cuts and a sentence may run over line breaks."""
    marks = _STOP + _GAP + _BREAK
    plain = F.translate(text, UPPER + marks, LOWER + " " * len(marks))
    plain = F.regexp_replace(plain, _END, f"$1 {_STOP} ")
    # With a break behind the last line no title is tried again from each mark within it.
    plain = F.regexp_replace(F.concat(plain, F.lit("\n")), _TITLE, f"$1$2 {_GAP} ")
    plain = F.regexp_replace(plain, r"\r\n|[\r\n]", f" {_BREAK} ")
    plain = F.trim(F.regexp_replace(plain, f"[^a-z0-9{marks}]+", " "))
    plain = F.concat(F.lit(f"{_STOP} "), plain, F.lit(f" {_STOP} "))
    # Of marks in a row the strongest stays; two line breaks are a blank line.
    plain = F.regexp_replace(plain, f"(?:[{_GAP}{_BREAK}] )*+{_STOP} (?:[{marks}] )*+", f"{_STOP} ")
    plain = F.regexp_replace(plain, f"(?:[{_GAP}{_BREAK}] ){{2,}}+|{_GAP} ", f"{_GAP} ")
    known = F.create_map(*[F.lit(x) for pair in _joined_known().items() for x in pair])
    found = F.regexp_extract_all(plain, F.lit(_joined_pattern()), F.lit(0))
    ids = F.transform(found, lambda s: known[F.regexp_replace(s, f" [{_GAP}{_BREAK}]", "")].cast("string"))
    return F.concat(F.lit(","), F.concat_ws(",", ids), F.lit(","))


def find_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, ``_sentences`` (known identifiers in order) and ``_licences`` (names in order).

    For ``_sentences`` a text is cut into sentences twice: as lines, and with line breaks read as
    spaces. Verbatim notices have wrapped sentences below lines without a full stop, so
    ``_licences`` also follows a third, joined form with the cuts of both (``_joined``); a rule may
    hold in any of the three. Everything is one narrow pass without a shuffle. Null and empty texts
    have no sentences; repeated rows are kept; an empty table gives no rows; existing columns of
    these two names are replaced.
    """
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), _SHORT, "v ")
    folded = F.translate(F.col(text_col), UPPER, LOWER)
    cue = F.lit(False)
    for word in CUES:
        cue = cue | folded.contains(word)
    both = F.concat(_sequence(F.regexp_replace(text, "[\r\n]+", " ")), F.lit("|"), _sequence(text))
    joined = "_joined"
    while joined in docs.columns:
        joined += "_"
    rows = docs.withColumns(
        {
            "_sentences": F.when(cue, both).otherwise(F.lit(",,|,,")),
            joined: F.when(cue, _joined(text)).otherwise(F.lit(",,")),
        }
    )

    def holds(rules) -> Column:
        out = F.lit(False)
        for rule in rules:
            ids = "," + ",".join(map(str, rule)) + ","
            out = out | F.col("_sentences").contains(ids) | F.col(joined).contains(ids)
        return out

    names = []
    for name, rules in {**RULES, **MORE_RULES}.items():
        held = holds(rules)
        if name in CONTAINED:
            held = held & ~holds(RULES[CONTAINED[name]])
        names.append(F.when(held, F.lit(name)))
    return rows.withColumn("_licences", F.array_compact(F.array(*names))).drop(joined)


def sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"{quote(s)}: {i}" for s, i in _known().items())

    def ids(text: str) -> str:
        cut = f"string_split(regexp_replace({text}, '([.!?:;])[ \\t\\r\\n\\f]+', '\\1' || chr(10), 'g'), chr(10))"
        plain = f"trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'))"
        known_ids = f"list_filter([MAP {{{known}}}[{plain}] FOR s IN {cut}], lambda i: i IS NOT NULL)"
        return f"',' || coalesce(array_to_string({known_ids}, ','), '') || ','"

    text = "regexp_replace(coalesce(text, ''), '(?i)\\bv\\.[ \\t\\r\\n\\f]+', 'v ', 'g')"
    flow = f"regexp_replace({text}, '[\\r\\n]+', ' ', 'g')"
    cases = []
    for name, rules in RULES.items():
        held = " OR ".join(f"contains(s, ',{','.join(map(str, r))},')" for r in rules)
        for rule in RULES.get(CONTAINED.get(name, ""), []):
            held = f"({held}) AND NOT contains(s, ',{','.join(map(str, rule))},')"
        cases.append(f"CASE WHEN {held} THEN '{name}' END")
    return f"""
SELECT doc_id, s AS sentence_ids, array_to_string(list_filter([{", ".join(cases)}], lambda x: x IS NOT NULL), ',') AS licences
FROM (SELECT doc_id, {ids(flow)} || '|' || {ids(text)} AS s FROM documents) d"""


@query("op7_licence_scan", sql())
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sentences and licences of every document."""
    found = find_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("_sentences").alias("sentence_ids"), F.concat_ws(",", "_licences").alias("licences")
    )
