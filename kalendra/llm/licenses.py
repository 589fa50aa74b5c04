"""License scan by patience alignment.

Pairs of neighbouring words that a template holds mark regions of a text; each region is aligned
with the template: words that are unique in both are anchors, the longest increasing run of anchors
is kept, and the gaps between them are aligned in the same way. Coverage is the share of the
template's words that are aligned. Each text is scanned by itself, so rows need no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendra.llm.words import ALPHANUMERIC, Words, mix, pieces, text_bytes

LEAST_COVERAGE = 0.75


@dataclass(frozen=True)
class Template:
    license: str
    text: str
    #: Words that must be aligned, since they tell this licence from others of the same wording.
    needed: str = ""


_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software"
)
_PERMIT = " and to permit persons to whom the Software is furnished to do so"
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met"
)
_BSD_TWO = _BSD + (
    " Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_ADVERTISING = (
    " All advertising materials mentioning features or use of this software must display the "
    "following acknowledgement This product includes software developed by"
)
_BSD_NAME = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission."
)
_FEE = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted"
)
_VERBATIM = (
    " Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
    "of this license document, but changing it is not allowed."
)


def _gnu_notice(thing: str, kind: str, version: str) -> str:
    return (
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of "
        f"the GNU {kind} Public License as published by the Free Software Foundation, either "
        f"version {version} of the License, or (at your option) any later version."
    )


# Notices as licences prescribe or projects commonly write them, and the openings of
# whole licence texts.
_NOTICES = (
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2"),
    Template(
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "apache",
    ),
    Template("MIT", "Released under the MIT License.", "mit"),
    Template("MIT", "Licensed under the MIT License.", "mit"),
    Template("MIT", _GRANT),
    Template(
        "MIT",
        _GRANT + _PERMIT + ", subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
        "substantial portions",
    ),
    Template("MIT-0", _GRANT + _PERMIT + ". THE SOFTWARE IS PROVIDED AS IS"),
    Template(
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
        "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "apache 2",
    ),
    # The opening alone does not tell how many clauses follow.
    Template("BSD", _BSD),
    Template("BSD-2-Clause", _BSD_TWO),
    Template("BSD-3-Clause", _BSD_TWO + _BSD_NAME, "endorse promote"),
    Template("BSD-4-Clause", _BSD_TWO + _BSD_ADVERTISING + _BSD_NAME, "endorse advertising"),
    Template("0BSD", _FEE),
    Template(
        "ISC",
        _FEE + ", provided that the above copyright notice and this permission notice appear in all "
        "copies.",
        "provided appear",
    ),
    Template(
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
        "mozilla 2",
    ),
    Template(
        "MPL-2.0",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or "
        "legal entity that creates, contributes to the creation of, or owns Covered Software.",
        "mozilla 2",
    ),
    Template(
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
        "eclipse 2",
    ),
    Template(
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution",
        "eclipse v1",
    ),
    Template(
        "EPL-2.0",
        "Eclipse Public License v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS "
        "ECLIPSE PUBLIC LICENSE",
        "eclipse 2",
    ),
    Template(
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software",
        "unencumbered",
    ),
    Template(
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work",
        "waived",
    ),
    Template("CC0-1.0", "Creative Commons CC0 1.0 Universal", "cc0"),
    Template("CC0-1.0", "Licensed under CC0 1.0.", "cc0"),
    Template(
        "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007" + _VERBATIM,
        "gnu 3",
    ),
    Template(
        "GPL-2.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991" + _VERBATIM,
        "gnu 2",
    ),
    Template(
        "LGPL-3.0",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007" + _VERBATIM,
        "lesser 3",
    ),
    Template(
        "LGPL-2.1",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999"
        + _VERBATIM,
        "lesser 2",
    ),
    Template(
        "AGPL-3.0",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007" + _VERBATIM,
        "affero 3",
    ),
    Template("LGPL-2.0", _gnu_notice("library", "Library General", "2"), "library 2"),
)


def _families():
    """Notices that differ by a licence's name and version only."""
    gnu = (
        ("GPL-3.0", "General", "3", "gnu 3"),
        ("GPL-2.0", "General", "2", "gnu 2"),
        ("LGPL-3.0", "Lesser General", "3", "lesser 3"),
        ("LGPL-2.1", "Lesser General", "2.1", "lesser 2 1"),
        ("AGPL-3.0", "Affero General", "3", "affero 3"),
    )
    for name, kind, version, needed in gnu:
        yield Template(
            name, f"This work is licensed under the GNU {kind} Public License, version {version}.", needed
        )
        for thing in ("program", "library"):
            yield Template(name, _gnu_notice(thing, kind, version), needed)
    words = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for parts in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        long = "-".join(words[x] for x in parts.split("-"))
        for version, suffix in (("4.0", "International"), ("3.0", "Unported")):
            needed = f"{parts.replace('-', ' ')} {version[0]}"
            yield Template(f"CC-{parts}-{version}", f"Licensed under CC {parts} {version}.", f"cc {needed}")
            yield Template(
                f"CC-{parts}-{version}",
                f"This work is licensed under a Creative Commons {long} {version} {suffix} License.",
                f"{long} {version[0]}",
            )
    for name, title in (
        ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause"), ("ISC", "ISC"),
        ("MPL-2.0", "Mozilla Public License, version 2.0"), ("EPL-2.0", "Eclipse Public License 2.0"),
    ):
        end = "" if "License" in title else " License"
        for verb in ("Released", "Licensed"):
            yield Template(name, f"{verb} under the {title}{end}.", title)


def _identifiers(names):
    for name in sorted(set(names) - {"BSD"}):
        yield Template(name, f"SPDX-License-Identifier: {name}", f"spdx {name}")


TEMPLATES = (*_NOTICES, *_families())
TEMPLATES += tuple(_identifiers(t.license for t in TEMPLATES))


def increasing(places: list[int]) -> list[int]:
    """Which elements make a longest increasing subsequence, by piles of patience."""
    tops, at, back = [], [], [-1] * len(places)
    for i, x in enumerate(places):
        k = bisect_left(tops, x)
        back[i] = at[k - 1] if k else -1
        if k == len(tops):
            tops.append(x)
            at.append(i)
        else:
            tops[k], at[k] = x, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places (in a, in b) of the words that patience alignment pairs, in order."""
    out: list[tuple[int, int]] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        a0, a1, b0, b1 = open_.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        seen_a, seen_b = _places(a, a0, a1), _places(b, b0, b1)
        both = [(i, seen_b[w]) for w, i in seen_a.items() if i >= 0 and seen_b.get(w, -1) >= 0]
        both.sort()
        anchors = [both[k] for k in increasing([j for _, j in both])]
        if not anchors:
            continue
        out += anchors
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        open_ += [
            (i + 1, k, j + 1, m)
            for (i, j), (k, m) in zip(ends, ends[1:], strict=False)
            if i + 1 < k and j + 1 < m
        ]
    return sorted(out)


def _places(words: list[int], low: int, high: int) -> dict[int, int]:
    """The place of each word of a stretch, -1 for one that occurs again."""
    seen: dict[int, int] = {}
    for i in range(low, high):
        seen[words[i]] = i if words[i] not in seen else -1
    return seen


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) > 1 else hashes[:0]


class Scanner:
    def __init__(self, templates: tuple[Template, ...]):
        self.templates = []
        for t in templates:
            needed = set(self._hashes(t.needed).tolist())
            hashes = self._hashes(t.text)
            self.templates.append((t.license, hashes, np.unique(_pairs(hashes)), needed))
        self.pairs = np.unique(np.concatenate([own for _, _, own, _ in self.templates]))

    @staticmethod
    def _hashes(text: str) -> np.ndarray:
        return Words(*text_bytes(pa.array([text])), table=ALPHANUMERIC, fold=True).hashes

    def found(self, words: Words):
        """(text, license, coverage, first word, last word) of every notice. Of notices of different
        licences at one place the one with the most aligned words stands."""
        by_text: dict[int, list[tuple]] = {}
        for row in self._covered(words):
            by_text.setdefault(row[0], []).append(row)
        for rows in by_text.values():
            rows.sort(key=lambda r: (-r[5], r[1], r[3]))
            kept: list[tuple] = []
            for r in rows:
                if all(r[1] == k[1] or r[4] < k[3] or k[4] < r[3] for k in kept):
                    kept.append(r)
                    yield r[:5]

    def _covered(self, words: Words):
        """Every region that a template covers, with the number of aligned words. A region spans
        pairs of neighbouring words no further apart than the template is long."""
        pairs = _pairs(words.hashes)
        text = words.text_of()
        some = np.flatnonzero(np.isin(pairs, self.pairs))
        some = some[text[some] == text[some + 1]]
        some_pairs = pairs[some]
        for name, template, own, needed in self.templates:
            hits = some[np.isin(some_pairs, own)]
            if not len(hits):
                continue
            apart = (np.diff(hits) > len(template)) | (np.diff(text[hits]) != 0)
            starts = np.flatnonzero(np.concatenate([[True], apart]))
            stops = np.append(starts[1:], len(hits))
            enough = 100 * (stops - starts) >= 40 * len(own)
            starts, stops = starts[enough], stops[enough]
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                if 100 * len(np.unique(pairs[hits[a:b]])) < 40 * len(own):
                    continue  # an alignment of three quarters keeps more of the pairs together
                owner = int(text[hits[a]])
                low = max(int(words.first[owner]), int(hits[a]) - len(template))
                high = min(int(words.first[owner + 1]), int(hits[b - 1]) + 2 + len(template))
                region = words.hashes[low:high].tolist()
                for i, j, n, met in self._copies(template.tolist(), region):
                    if n >= LEAST_COVERAGE * len(template) and needed <= met:
                        first = low - int(words.first[owner])
                        yield owner, name, n / len(template), first + i, first + j, n

    @staticmethod
    def _copies(template: list[int], region: list[int]):
        """Alignments of a template with the copies that a region may hold one after another."""
        size = len(template)
        starts = range(0, max(1, len(region) - size + 1), max(1, size // 2))
        best_end = -1
        for s in starts:
            if s <= best_end:
                continue
            part = region[s : s + 2 * size]
            pairs = aligned(template, part)
            if not pairs:
                continue
            first, last = s + pairs[0][1], s + pairs[-1][1]
            if len(pairs) >= LEAST_COVERAGE * size:
                best_end = last
            yield first, last, len(pairs), {template[i] for i, _ in pairs}


def _rows(templates: tuple[Template, ...]):
    def run(batches):
        scanner = Scanner(templates)
        for whole in batches:
            for batch in pieces(whole, "text", 1 << 20):
                words = Words(*text_bytes(batch.column("text")), table=ALPHANUMERIC, fold=True)
                rows = list(scanner.found(words))
                ids = batch.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[r[0]] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array([r[2] for r in rows], pa.float64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[4] for r in rows], pa.int64()),
                    ],
                    names=["doc_id", "license", "coverage", "first_word", "last_word"],
                )

    return run


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(`doc_id`, `license`, `coverage`, `first_word`): each licence of each document with its best
    coverage, at its first place.

    Words are runs of letters and digits, A-Z as a-z. A null text holds no licence, rows that share
    a doc_id count as one document, and a null doc_id is one, too. Other columns are ignored.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _rows(templates),
        "doc_id long, license string, coverage double, first_word long, last_word long",
    )
    best = F.max(F.struct("coverage", -F.col("first_word"))).alias("best")
    return found.groupBy("doc_id", "license").agg(best).select(
        "doc_id", "license", "best.coverage", (-F.col("best.col2")).alias("first_word")
    )
