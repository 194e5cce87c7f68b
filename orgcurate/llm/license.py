"""License scan by conditional compression.

A candidate block is a line that has one of the CUES or, where no template is confirmed in
it, that line with its neighbours up to blank ones, as far as REACH words (more than any template
has) before and after it, without comment marks, so that wrapped notices are found. A block is compressed with zstandard once alone and
once with each template as raw dictionary; the templates are ranked by how many bytes that
saves, and the first is taken that the exact wording differences confirm: between the first
and the last word that they share, block and template may differ in FILLER words only; for
templates of LONG words or more, in LOOSE of the words, but not in names, numbers or
negations. A negation right before the shared words rejects as well, and a word of the FORMER
ones in the same sentence. The words confirmed are then cut out and the rest of the block is ranked again, so that a block
names all its licenses. Every line of every whole text is looked at.

SPDX identifiers are read as they are. A short name alone on its line saves no bytes and is not named. A BSD notice whose conditions follow without the
clause on names is BSD-2-Clause.

Defined results: null and empty texts have no blocks; a block that no template confirms is
counted but names no license; ties between templates go to the name that sorts first;
repeated documents are scanned each; only doc_id and text are read; an empty table gives none.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ._spark import arrow_type, ship

# Notices, standard headers, headings and first passages of public licenses.
TEMPLATES = {
    "0BSD": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU Affero General Public License Version 3, 19 November 2007", "Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL version 3 License.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Released under the BSD 3-Clause License."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC0-1.0": ["CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GNU General Public License Version 2, June 1991", "This work is licensed under the GNU General Public License, version 2.", "Released under the GPL version 2 License.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU General Public License Version 3, 29 June 2007", "This work is licensed under the GNU General Public License, version 3.", "Released under the GPL version 3 License.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Released under the ISC License."],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "GNU Lesser General Public License Version 2.1, February 1999",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GNU Lesser General Public License Version 3, 29 June 2007", "This library is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "proprietary": ["All rights reserved."],
}
# Words in which a notice may differ without being another, and words in which it may not.
FILLER = set("a an and any are as at be been by can distributed document code content data file files following for form here in international is it its licence licenced license licensed made material of on or program project provided published released see software source terms text that the their these this to under use v version was which with work works you your".split())
NEGATIONS = set("cannot neither never no non nor not without aren isn".split())
NAMES = set("affero apache boost bsd cc cc0 creative commons eclipse gnu isc lesser library mit mozilla noderivatives noncommercial sharealike nc nd sa".split())
LONG, LOOSE = 20, 0.15
REACH = 200
FORMER = set("former formerly previously".split())
# Names with a version, as they are often written instead of a notice.
for _name in [k for k in TEMPLATES if any(c.isdigit() for c in k) and not k.startswith("CC")]:
    TEMPLATES[_name].append(f"Licensed under {_name}")
SHORT = re.compile(r"\b([la]?gpl)[ -]?v?(\d)(\.\d)?\b", re.I)
SPDX = re.compile(r"SPDX-License-Identifier:\s*([^\n]*)", re.I)
MARKS = re.compile(r"^[\s#*/;%<>!-]+")
CUES = re.compile(r"licen[cs]|copyright|©|\(c\)|rights reserved|creative commons|public domain|spdx|redistribut|warrant|\bcc[ -]by\b|\bcc0\b|permission is hereby|permission to use|\b[la]?gpl[ -]?v?\d|\bapache-2", re.I)
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def spelt(text: str) -> str:
    """In lower case, with short names as one word: GPLv3 and GPL-3.0 are gpl3.0."""
    return SHORT.sub(lambda m: f"{m[1]}{m[2]}{m[3] or '.0'}", text.lower())


def words_of(text: str) -> list[str]:
    return WORD.findall(spelt(text))


@lru_cache(maxsize=1)
def compressors() -> list[tuple[str, zstandard.ZstdCompressor, list[str]]]:
    """(license, compressor with the template as dictionary, the template's words)."""
    raw = lambda t: zstandard.ZstdCompressionDict(t.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return [(k, zstandard.ZstdCompressor(level=3, dict_data=raw(t), write_content_size=False), words_of(t)) for k, ts in sorted(TEMPLATES.items()) for t in ts]


def ranked(block: str) -> list[tuple[int, str, list[str]]]:
    """(bytes saved, license, words) of the templates that save any, the best first."""
    raw = block.lower().encode()
    alone = len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw))
    saved = [(alone - len(c.compress(raw)), k, words) for k, c, words in compressors()]
    return sorted((x for x in saved if x[0] > 0), key=lambda x: (-x[0], x[1], x[2]))


def confirmed(words: list[str], mine: list[str]) -> tuple[int, int] | None:
    """The span of the block's words that are the template's, if they differ only as far as notices may."""
    same = [m for m in difflib.SequenceMatcher(None, words, mine, autojunk=False).get_matching_blocks() if m.size]
    if not same:
        return None
    a, b = same[0].b, same[-1].b + same[-1].size
    taken = {m.a + i for m in same for i in range(m.size)}
    kept = {m.b + i for m in same for i in range(m.size)}
    differ = [w for i, w in enumerate(words) if i not in taken] + [mine[j] for j in range(a, b) if j not in kept]
    if not NEGATIONS.isdisjoint(mine[max(0, a - 2) : a]) or not NEGATIONS.isdisjoint(differ):
        return None
    if len(words) < LONG:
        return (a, b) if FILLER.issuperset(differ) else None
    return (a, b) if len(differ) <= LOOSE * len(words) and NAMES.isdisjoint(differ) and not any(c.isdigit() for w in differ for c in w) else None


@lru_cache(maxsize=4096)
def named(block: str) -> tuple[tuple[str, ...], int]:
    """(licenses in the order in which they were confirmed, bytes saved by their templates, or by the best one if there are none)."""
    found: list[str] = []
    total, left = 0, spelt(block)
    while True:
        order, mine = ranked(left), [m for m in WORD.finditer(left)]
        plain = [m[0] for m in mine]
        hit = next(((saved, k, span) for saved, k, words in order if (span := confirmed(words, plain))), None)
        if hit is None:
            return tuple(found), total if found else order[0][0] if order else 0
        saved, k, (a, b) = hit
        start, end = mine[a].start(), mine[b - 1].end()
        if FORMER.isdisjoint(WORD.findall(left[:start].rpartition(". ")[2])):
            found.append(k)
            total += saved
        left = f"{left[:start]} | {left[end:]}"


def around(lines: list[str], i: int) -> str:
    """Line i with its neighbours up to blank lines, as far as REACH words, without comment marks."""
    a, b = i, i + 1
    words = 0
    while a > 0 and words < REACH and (line := MARKS.sub("", lines[a - 1])):
        words += len(line.split())
        a -= 1
    words = 0
    while b < len(lines) and words < REACH and (line := MARKS.sub("", lines[b])):
        words += len(line.split())
        b += 1
    return " ".join(MARKS.sub("", x).strip() for x in lines[a:b])


def of_line(lines: list[str], i: int) -> tuple[list[str], int]:
    """(licenses, bytes saved) of a line with a cue."""
    spdx = SPDX.search(lines[i])
    if spdx:
        return [x for x in re.findall(r"[A-Za-z0-9][A-Za-z0-9.+-]*", spdx[1]) if x.upper() not in ("AND", "OR", "WITH")], 0
    names, saved = named(lines[i].strip())
    if not names:
        names, saved = named(around(lines, i))
    names = list(dict.fromkeys(names))
    if "BSD-3-Clause" in names:
        rest = " ".join(MARKS.sub("", x) for x in lines[i : i + 40]).lower()
        rest = rest.split("this software is provided")[0]
        if re.search(r"redistributions\s+in\s+binary\s+form", rest) and not re.search(r"neither\s+the\s+name|endorse\s+or\s+promote", rest):
            names[names.index("BSD-3-Clause")] = "BSD-2-Clause"
    return names, saved


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_blocks, n_named, licenses (sorted, comma-joined), saved_bytes of every document."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("n_blocks", pa.int64()), ("n_named", pa.int64()), ("licenses", pa.string()), ("saved_bytes", pa.int64())])

    def scan(text: str | None) -> tuple[int, int, str, int]:
        if not text or not CUES.search(text):
            return 0, 0, "", 0
        lines = text.split("\n")
        got = [of_line(lines, i) for i, x in enumerate(lines) if CUES.search(x)]
        names = sorted({k for ks, _ in got for k in ks})
        return len(got), sum(bool(ks) for ks, _ in got), ",".join(names), sum(s for ks, s in got if ks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan(x) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), list(schema)[1:], strict=True))] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_blocks long, n_named long, licenses string, saved_bytes long")
