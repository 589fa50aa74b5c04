"""Licences that differ by a word or a clause."""

from __future__ import annotations

from kalendra.llm import licenses

GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "{} Public License as published by the Free Software Foundation, either version {} of the License, or "
    "(at your option) any later version."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met:\n1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n{}THIS SOFTWARE IS PROVIDED BY THE "
    'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'
)
NAME = (
    "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
TEXTS = [
    ("GPL-3.0", GNU.format("General", "3")),
    ("GPL-2.0", GNU.format("General", "2")),
    ("AGPL-3.0", GNU.format("Affero General", "3")),
    ("LGPL-3.0", GNU.format("Lesser General", "3")),
    ("LGPL-2.1", GNU.format("Lesser General", "2.1").replace("program", "library")),
    ("BSD-2-Clause", BSD.format("")),
    ("BSD-3-Clause", BSD.format(NAME)),
    ("ISC", FEE + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", FEE + ". THE SOFTWARE IS PROVIDED"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "# SPDX-License-Identifier: EPL-2.0"),
    ("MIT", "// SPDX-License-Identifier: MIT"),
    (None, "the software is provided to the public under the license of this work, version 2.0 of the program"),
]


def test_siblings_are_told_apart(spark):
    rows = [(d, f"some words {d} before\n{text}\nand after it") for d, (_, text) in enumerate(TEXTS)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(d, x) for d, (x, _) in enumerate(TEXTS) if x]
