"""Licence scans over wrapped texts and notices, held against rows made by hand, in columns and in SQL."""

import duckdb
import pandas as pd
import pytest

from rainledger.llm import licences

APACHE = """# Copyright 2020 Some One
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.

import os"""
GPL = """/*
 * This file is part of Foo.
 *
 * Foo is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version {version} of the License, or
 * (at your option) any later version.
 *
 * Foo is distributed in the hope that it will be useful.
 *
 * You should have received a copy of the GNU General Public License
 * along with Foo.  If not, see <https://www.gnu.org/licenses/>.
 */"""
MIT = """{title}
Copyright (c) 2019 Some One. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are met:
// 1. Redistributions of source code must retain the above copyright notice,
//    this list of conditions and the following disclaimer.
// 2. Redistributions in binary form must reproduce the above copyright notice,
//    this list of conditions and the following disclaimer in the documentation
//    and/or other materials provided with the distribution."""
NAMES = """
// 3. Neither the name of X nor the names of its contributors may be used to
//    endorse or promote products derived from this software without specific
//    prior written permission."""

# text, identifiers, licence
CASES = [
    (APACHE, "A2,A3,A4,A5", "Apache-2.0 header"),
    (GPL.format(version=3), "G2,G3", "GPL-3.0-or-later notice"),
    (GPL.format(version=2), "G4,G3", "GPL-2.0-or-later notice"),
    (GPL.format(version=3).replace("GNU General", "GNU Affero General"), "N2", "AGPL-3.0-or-later"),
    (MIT.format(title="The MIT License (MIT)"), "M2,R1,M3,M4", "MIT text"),
    (MIT.format(title="# MIT License").replace("\n", "\r\n"), "M2,R1,M3,M4", "MIT text"),
    (MIT.format(title="Foo"), "R1,M3,M4", "MIT"),
    (BSD, "B1,B2,B3", "BSD text"),
    (BSD + NAMES, "B1,B2,B3,B4", "BSD-3-Clause text"),
    (BSD.replace("// ", "").replace("\n", " "), "B1,B2,B3", "BSD text"),
    ("This file is released under the MIT License.", "M1", "MIT"),
    ("Foo is distributed under the terms of the MIT licence, as is Bar", "M1", "MIT"),
    ("It is not licensed under the MIT License.", "", None),
    ("Everybody likes the MIT License more.", "", None),
    ("One\nMIT License\nCopyright", "M2", "MIT"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "G9", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: Apache-2.0", "A1", "Apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", "P2", "MPL-2.0"),
    ("Licensed under CC BY-NC-SA 4.0", "C5", "CC-BY-NC-SA-4.0"),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "C3", "CC-BY-SA-4.0"),
    ("This is free and unencumbered software released into the public domain.", "U2", "Unlicense text"),
    ("All rights reserved. Licensed under the Apache License, Version 2.0.", "R1,A1", "Apache-2.0"),
    ("Submitted to the emit licensed office", "", None),
    ("中文\n中文", "", None),
    ("", "", None),
    (None, "", None),
    ("\n" * 200_000 + "Released under the MIT License\n" + "*\n" * 200_000, "M1", "MIT"),
    ("x. " * 300_000, "", None),
]


def test_wrapped_texts_and_notices(spark):
    docs = spark.createDataFrame([(i, t, "other") for i, (t, _, _) in enumerate(CASES)], "doc_id int, text string, known string")
    rows = {r["doc_id"]: r for r in licences.scan_licences(docs).collect()}
    assert [(rows[i]["known"], rows[i]["licence"]) for i in range(len(CASES))] == [(k, x) for _, k, x in CASES]
    assert rows[10]["n_sentences"] == 1 and rows[25]["n_sentences"] == 0 and rows[27]["n_sentences"] == 300_000


def test_the_sql_gives_the_same_rows():
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(CASES)), "text": [t for t, _, _ in CASES]}))
    found = {r[0]: (r[2], r[4]) for r in con.sql(licences.sql()).fetchall()}
    assert [found[i] for i in range(len(CASES))] == [(k, x) for _, k, x in CASES]


def test_repeated_ids_are_scanned_by_themselves(spark):
    docs = spark.createDataFrame([(1, "MIT License"), (1, None), (None, "All rights reserved")], "doc_id long, text string")
    found = {(r["doc_id"], r["licence"]) for r in licences.scan_licences(docs).collect()}
    assert found == {(1, None), (1, "MIT"), (None, "proprietary")}
    assert licences.scan_licences(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name, ids", licences.RULES)
def test_rules_name_known_identifiers_of_one_family(name, ids):
    assert len({i[0] for i in ids}) == 1
    assert set(ids) <= {*licences.SENTENCES, *licences.NOTICES, *licences.TITLES}
