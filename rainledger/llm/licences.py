"""Licence scans by sentence rules: known sentences become identifiers, and identifier sequences match ordered rules.

A text is read in lower case (A-Z alone). Lines of a paragraph are joined, since licences are wrapped and stand in comments; a
paragraph ends at a line without ASCII letters or digits, which an empty comment line is too. A line that is a short title
(``MIT License``) is a sentence by itself. Sentences end at ``.``, ``!`` or ``?`` before blanks and something other than a digit.

A sentence is normalised to ASCII letters and digits with single spaces, ``licence`` is spelt ``license``, and every way of
saying "released under the terms of the" becomes "under". A known sentence is then found as a whole sentence or, unless
it is a title, as a run of whole words inside a longer one; of two that overlap the longer is taken. "not licensed under" is no
notice. A rule matches where its identifiers follow each other among the document's identifiers of the same family (its letter),
whatever else stands between them; rules are tried in order, and a document's licence is its first match. Column expressions
only, row by row: no shuffle, no join.

Null and empty texts have no sentences. Rows that repeat an id, or have none, are scanned each by itself. Other columns are
ignored. An empty table gives no rows. A text may be as long as a row can be: no pattern recurses with its length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of their notices, in plain words.
SENTENCES = {
    "A2": ["licensed under the Apache License, Version 2.0 (the License)"],
    "A3": ["you may not use this file except in compliance with the License"],
    "A4": ["you may obtain a copy of the License at"],
    "A5": ["see the License for the specific language governing permissions and limitations under the License"],
    "A6": ["Apache License Version 2.0, January 2004"],
    "M3": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"],
    "M4": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "G2": ["free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "G3": ["You should have received a copy of the GNU General Public License along with"],
    "G4": ["free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "G5": ["GNU General Public License Version 3, 29 June 2007"],
    "G6": ["GNU General Public License Version 2, June 1991"],
    "L2": ["free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "L3": ["free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "N2": ["free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "B1": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "B2": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "B3": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "B4": [
        "may be used to endorse or promote products derived from this software without specific prior written permission",
        "may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "B5": ["All advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "I2": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "P2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "Z2": ["Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"],
    "Z3": ["This notice may not be removed or altered from any source distribution"],
    "S2": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"],
    "U2": ["This is free and unencumbered software released into the public domain"],
    "D2": ["has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide"],
    "R1": ["All rights reserved"],
}
# What a notice names after "licensed under the" or "SPDX-License-Identifier:".
NOTICES = {
    "A1": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0 License"],
    "M1": ["MIT License", "MIT"],
    "G1": ["GNU General Public License version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPL-3.0", "GPL-3.0-only", "GPLv3"],
    "G7": ["GPL-3.0-or-later", "GNU General Public License version 3 or later", "GPLv3 or later", "GPLv3+"],
    "G8": ["GNU General Public License version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPL-2.0", "GPL-2.0-only", "GPLv2"],
    "G9": ["GPL-2.0-or-later", "GNU General Public License version 2 or later", "GPLv2 or later"],
    "L1": ["GNU Lesser General Public License version 3", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3"],
    "L4": ["GNU Lesser General Public License version 2.1", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPLv2.1"],
    "N1": ["GNU Affero General Public License version 3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3"],
    "B7": ["BSD-3-Clause", "3-Clause BSD License", "new BSD License", "modified BSD License"],
    "B8": ["BSD-2-Clause", "2-Clause BSD License", "simplified BSD License"],
    "B9": ["BSD License", "BSD"],
    "I1": ["ISC License", "ISC"],
    "P1": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0"],
    "E1": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "EPL-2.0"],
    "S1": ["Boost Software License, version 1.0", "Boost Software License 1.0", "BSL-1.0"],
    "Z1": ["zlib License", "zlib"],
    "U1": ["Unlicense"],
    "D1": ["CC0", "CC0-1.0", "CC0 1.0 Universal"],
    "C1": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "C2": ["CC BY 4.0", "Creative Commons Attribution 4.0"],
    "C3": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "C4": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"],
    "C5": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"],
    "C6": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"],
}
# Titles, which count only where they fill a line or a sentence.
TITLES = {
    "M2": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "B6": ["BSD 3-Clause License", "BSD 2-Clause License"],
    "I3": ["ISC License", "The ISC License"],
    "U3": ["The Unlicense"],
    "S3": ["Boost Software License - Version 1.0"],
}
# Rules in the order in which they are tried; the identifiers of a rule share their letter.
RULES = [
    ("Apache-2.0 header", ["A2", "A3", "A4", "A5"]),
    ("Apache-2.0 text", ["A6"]),
    ("Apache-2.0", ["A2"]),
    ("Apache-2.0", ["A1"]),
    ("MIT text", ["M2", "M3", "M4"]),
    ("MIT", ["M3", "M4"]),
    ("MIT", ["M1"]),
    ("MIT", ["M2"]),
    ("AGPL-3.0-or-later", ["N2"]),
    ("AGPL-3.0", ["N1"]),
    ("LGPL-3.0-or-later", ["L2"]),
    ("LGPL-2.1-or-later", ["L3"]),
    ("LGPL-3.0", ["L1"]),
    ("LGPL-2.1", ["L4"]),
    ("GPL-3.0-or-later notice", ["G2", "G3"]),
    ("GPL-3.0-or-later", ["G2"]),
    ("GPL-3.0-or-later", ["G7"]),
    ("GPL-2.0-or-later notice", ["G4", "G3"]),
    ("GPL-2.0-or-later", ["G4"]),
    ("GPL-2.0-or-later", ["G9"]),
    ("GPL-3.0 text", ["G5"]),
    ("GPL-2.0 text", ["G6"]),
    ("GPL-3.0", ["G1"]),
    ("GPL-2.0", ["G8"]),
    ("BSD-4-Clause text", ["B1", "B2", "B3", "B5", "B4"]),
    ("BSD-3-Clause text", ["B1", "B2", "B3", "B4"]),
    ("BSD text", ["B1", "B2", "B3"]),
    ("BSD", ["B1"]),
    ("BSD-3-Clause", ["B7"]),
    ("BSD-2-Clause", ["B8"]),
    ("BSD", ["B9"]),
    ("ISC text", ["I2"]),
    ("ISC", ["I1"]),
    ("ISC", ["I3"]),
    ("MPL-2.0", ["P2"]),
    ("MPL-2.0", ["P1"]),
    ("EPL-2.0", ["E1"]),
    ("BSL-1.0 text", ["S2"]),
    ("BSL-1.0", ["S1"]),
    ("BSL-1.0", ["S3"]),
    ("Zlib text", ["Z2", "Z3"]),
    ("Zlib", ["Z1"]),
    ("Unlicense text", ["U2"]),
    ("Unlicense", ["U1"]),
    ("Unlicense", ["U3"]),
    ("CC0-1.0 text", ["D2"]),
    ("CC0-1.0", ["D1"]),
    ("CC-BY-NC-SA-4.0", ["C5"]),
    ("CC-BY-NC-ND-4.0", ["C6"]),
    ("CC-BY-NC-4.0", ["C1"]),
    ("CC-BY-SA-4.0", ["C3"]),
    ("CC-BY-ND-4.0", ["C4"]),
    ("CC-BY-4.0", ["C2"]),
    ("proprietary", ["R1"]),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks the end of a sentence while a text is cut.
_CUT = "\x01"
_COMMENT_WORD, _EMPTY_LINE = r"\n[ \t]*(?:rem|dnl)[ \t]", r"\n[^a-z0-9]*\n"
_SENTENCE_END = r"""([.!?]["')\]]*)[ \t\r\n]+([^0-9 \t\r\n])"""
_OTHER = "[^a-z0-9]+"
_UNDER = (
    r" (?:released|licensed|distributed|provided|published|available|covered|governed) (?:under|by)"
    r"(?: (?:the|a|an|terms|and|conditions|of)){0,6} | spdx license identifier "
)
#: Only sentences with one of these words can hold a known one.
_HINT = r" (?:license|identifier|permission|copyright|copies|redistribute|redistributions?|rights|domain|software|distribution|under) "


def _normal(sentence: str) -> str:
    """The normal form of a known sentence, between blanks: the same steps as ``_sentences`` takes in columns."""
    plain = " " + re.sub(_OTHER, " ", sentence.translate(str.maketrans(_UPPER, _LOWER))).strip() + " "
    return re.sub(_UNDER, " under ", plain.replace(" licence ", " license ")).replace(" not under ", " not ")


def _known_sentences() -> list[tuple[str, str]]:
    """(normal form, identifier) of all but the titles, long ones first."""
    found = {_normal(s): i for i, known in SENTENCES.items() for s in known}
    found.update({" under" + _normal(s): i for i, known in NOTICES.items() for s in known})
    return sorted(found.items(), key=lambda x: (-len(x[0]), x[0]))


_KNOWN = _known_sentences()
_WHOLE = {_normal(s): i for i, known in TITLES.items() for s in known}
_TITLE_LINE = r"\n([^a-z0-9\n]*(?:" + "|".join(
    sorted((t.strip().replace(" ", r"[^a-z0-9\n]+") for t in _WHOLE), key=lambda t: (-len(t), t))
) + r")[^a-z0-9\n]*)\n"
FAMILIES = sorted({ids[0][0] for _, ids in RULES})


def sentences(text: Column) -> Column:
    """The normalised sentences of a text that have a letter or digit, each between blanks."""
    lines = F.concat(F.lit("\n"), F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit("\n"))
    lines = F.regexp_replace(lines, _COMMENT_WORD, "\n")
    lines = F.regexp_replace(lines, _TITLE_LINE, "\n" + _CUT + "$1" + _CUT + "\n")
    cut = F.regexp_replace(F.regexp_replace(lines, _EMPTY_LINE, _CUT), _SENTENCE_END, "$1" + _CUT + "$2")

    def plain(s: Column) -> Column:
        words = F.concat(F.lit(" "), F.trim(F.regexp_replace(s, _OTHER, " ")), F.lit(" "))
        said = F.regexp_replace(F.replace(words, F.lit(" licence "), F.lit(" license ")), _UNDER, " under ")
        return F.replace(said, F.lit(" not under "), F.lit(" not "))

    return F.transform(F.filter(F.split(cut, _CUT), lambda s: s.rlike("[a-z0-9]")), plain)


def _identifiers(sentence: Column) -> Column:
    """The identifiers in one normalised sentence, in order."""
    known = F.array(*[F.struct(F.lit(s).alias("words"), F.lit(f" <{i}> ").alias("name")) for s, i in _KNOWN])
    marked = F.reduce(known, sentence, lambda said, k: F.replace(said, k["words"], k["name"]))
    title = F.try_element_at(F.create_map(*[F.lit(x) for pair in _WHOLE.items() for x in pair]), sentence)
    inner = F.when(sentence.rlike(_HINT), F.regexp_extract_all(marked, F.lit("<([A-Z][0-9])>"), 1))
    return F.when(title.isNotNull(), F.array(title)).otherwise(F.coalesce(inner, F.array().cast("array<string>")))


def scan_licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, ``known`` (identifiers in order, joined by commas), ``matches`` (the names of all rules that match,
    each once, in rule order, joined by commas) and ``licence`` (the first of them, or null)."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sentences(F.col("text")).alias("_s"))
    listed = found.select(
        "doc_id", F.size("_s").cast("long").alias("n_sentences"), F.flatten(F.transform("_s", _identifiers)).alias("_known")
    )
    family = lambda c: F.concat(F.lit(","), F.array_join(F.filter("_known", lambda x: F.startswith(x, F.lit(c))), ","), F.lit(","))
    listed = listed.select("*", *[family(c).alias("_" + c) for c in FAMILIES])
    hits = [F.when(F.contains(F.col("_" + ids[0][0]), F.lit("," + ",".join(ids) + ",")), F.lit(name)) for name, ids in RULES]
    matches = F.array_distinct(F.filter(F.array(*hits), lambda x: x.isNotNull()))
    return listed.select(
        "doc_id",
        "n_sentences",
        F.array_join("_known", ",").alias("known"),
        F.array_join(matches, ",").alias("matches"),
        F.try_element_at(matches, F.lit(1)).alias("licence"),
    )


def sql() -> str:
    """The same scan in DuckDB's SQL. Its tables are the ones above; tests hold both against rows made by hand."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    cut = "chr(1)"
    lines = f"chr(10) || translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') || chr(10)"
    lines = f"regexp_replace({lines}, {quote(_COMMENT_WORD)}, chr(10), 'g')"
    lines = f"regexp_replace({lines}, {quote(_TITLE_LINE)}, chr(10) || {cut} || '\\1' || {cut} || chr(10), 'g')"
    lines = f"regexp_replace({lines}, {quote(_EMPTY_LINE)}, {cut}, 'g')"
    lines = f"regexp_replace({lines}, {quote(_SENTENCE_END)}, '\\1' || {cut} || '\\2', 'g')"
    words = f"replace(' ' || trim(regexp_replace(s, '{_OTHER}', ' ', 'g')) || ' ', ' licence ', ' license ')"
    said = f"replace(regexp_replace({words}, {quote(_UNDER)}, ' under ', 'g'), ' not under ', ' not ')"
    marked = "s"
    for known, name in _KNOWN:
        marked = f"replace({marked}, {quote(known)}, ' <{name}> ')"
    titles = "MAP {" + ", ".join(f"{quote(s)}: '{i}'" for s, i in _WHOLE.items()) + "}"
    names = f"""CASE WHEN ({titles})[s] IS NOT NULL THEN [({titles})[s]]
      WHEN regexp_matches(s, {quote(_HINT)}) THEN regexp_extract_all({marked}, '<([A-Z][0-9])>', 1) ELSE [] END"""
    families = ", ".join(
        f"',' || coalesce(array_to_string(list_filter(known, lambda x: x[1] = '{c}'), ','), '') || ',' AS f_{c}" for c in FAMILIES
    )
    hits = [f"CASE WHEN contains(f_{ids[0][0]}, ',{','.join(ids)},') THEN {quote(name)} END" for name, ids in RULES]
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(list_filter(string_split({lines}, {cut}), lambda s: regexp_matches(s, '[a-z0-9]')), lambda s: {said}) AS s
  FROM documents),
listed AS (SELECT doc_id, len(s)::BIGINT AS n_sentences, flatten(list_transform(s, lambda s: {names})) AS known FROM cut),
families AS (SELECT *, {families} FROM listed),
hits AS (SELECT *, list_filter([{", ".join(hits)}], lambda x: x IS NOT NULL) AS hits FROM families),
named AS (SELECT *, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS names FROM hits)
SELECT doc_id, n_sentences, coalesce(array_to_string(known, ','), '') AS known,
  coalesce(array_to_string(names, ','), '') AS matches, names[1] AS licence
FROM named"""
