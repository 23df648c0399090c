"""License scans by conditional compression.

At every cue (a word of the kind that every template has) each template names the blocks
where it could lie: as many words as it has, placed so that one of its own cues falls on the
cue. Such a block is compressed with the template as a raw zstandard dictionary and without:
what a notice says costs next to nothing once its template is known. The bytes saved rank the
candidates, and the winner is the first in that order that its exact wording confirms: the
template's words, aligned with the text about the cue, must be there nearly all, in order, and
the differences are listed. No candidate is left out of the ranking.

Texts without a cue are left in the JVM.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

# Notices as their licenses give them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}
# Every template has one of these.
CUE = r"licen[sc]ed?|permission|redistribut(?:e|ion)"
WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
# The share of a template's words that may differ.
MOST_DIFFERENT = 0.1
LEVEL = 19
# Sizes of blocks that a task remembers.
REMEMBERED = 1 << 14


@dataclass
class Template:
    license: str
    words: list[str]
    cues: list[int]


def as_block(words: list[str]) -> bytes:
    """Words between two marks, so that a block that ends otherwise saves less."""
    return f"\n{' '.join(words)}\n".encode()


def compile_templates(templates: dict[str, tuple[str, ...]]) -> list[Template]:
    found = []
    for name, notices in templates.items():
        for notice in notices:
            words = [w.lower() for w in WORD.findall(notice)]
            cues = [i for i, word in enumerate(words) if re.search(CUE, word)]
            if not cues:
                raise ValueError(f"a notice of {name} has no cue")
            found.append(Template(name, words, cues))
    return found


def align(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """(differences, begin, end): the stretch of the block's words nearest to the template, by
    words to insert, delete or replace; of equals the one that ends and then begins first."""
    cost = np.zeros(len(block) + 1, dtype=np.int64)
    begin = np.arange(len(block) + 1)
    for i, word in enumerate(template, 1):
        new, origin = np.empty_like(cost), np.empty_like(begin)
        new[0], origin[0] = i, 0
        for j, other in enumerate(block, 1):
            ways = (
                (int(cost[j - 1]) + (word != other), -int(begin[j - 1])),
                (int(cost[j]) + 1, -int(begin[j])),
                (int(new[j - 1]) + 1, -int(origin[j - 1])),
            )
            best = min(ways)
            new[j], origin[j] = best[0], -best[1]
        cost, begin = new, origin
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def differences(template: list[str], stretch: list[str]) -> str:
    """The edits that make the template of the stretch: ``-word`` lacks, ``+word`` is extra."""
    n, m = len(template), len(stretch)
    common = np.zeros((n + 1, m + 1), dtype=np.int32)
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            common[i, j] = (
                common[i + 1, j + 1] + 1
                if template[i] == stretch[j]
                else max(common[i + 1, j], common[i, j + 1])
            )
    i = j = 0
    edits = []
    while i < n or j < m:
        if i < n and j < m and template[i] == stretch[j]:
            i, j = i + 1, j + 1
        elif j == m or (i < n and common[i + 1, j] >= common[i, j + 1]):
            edits.append("-" + template[i])
            i += 1
        else:
            edits.append("+" + stretch[j])
            j += 1
    return " ".join(edits)


class Scanner:
    """Finds notices in one text at a time; holds the templates as dictionaries."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(
                    as_block(t.words), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )
            for t in templates
        ]
        self.counts = [Counter(t.words) for t in templates]
        self.cue = re.compile(CUE)
        # Notices and their surroundings repeat.
        self.size = lru_cache(maxsize=REMEMBERED)(self._size)

    def _size(self, raw: bytes, which: int | None) -> int:
        given = self.plain if which is None else self.given[which]
        return len(given.compress(raw))

    def rank(self, words: list[str], cue: int, begin: int) -> list[tuple[int, float, int, int]]:
        """(saved, reduction, template, first word) of every template's best block about word number
        ``cue``, not before ``begin``: most bytes saved first, then the template given first.
        Templates that save nothing are no candidates."""
        found = []
        for i, template in enumerate(self.templates):
            best = (0, 0.0, i, 0)
            for place in template.cues:
                low, high = max(begin, cue - place), cue - place + len(template.words)
                raw = as_block(words[low:high])
                alone = self.size(raw, None)
                saved = alone - self.size(raw, i)
                if saved > best[0]:
                    best = (saved, saved / alone, i, cue - place)
            if best[0] > 0:
                found.append(best)
        return sorted(found, key=lambda c: (-c[0], c[2]))

    def confirm(
        self, which: int, words: list[str], first: int, cue: int, begin: int
    ) -> tuple[int, int] | None:
        """(begin, end) of the stretch of words that is the template but for a few differences and
        holds the cue, found about the block that begins at ``first``."""
        template = self.templates[which]
        allowed = int(MOST_DIFFERENT * len(template.words))
        low = max(begin, first - allowed)
        near = words[low : first + len(template.words) + allowed]
        # Each word that is not near is a difference at least.
        if (self.counts[which] - Counter(near)).total() > allowed:
            return None
        wrong, at, end = align(template.words, near)
        if wrong <= allowed and low + at <= cue < low + end:
            return low + at, low + end
        return None

    def scan(self, text: str) -> list[tuple[int, int, str, float, str]]:
        """(begin, end, license, reduction, differences) of each notice, in characters."""
        if not self.cue.search(text.lower()):
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        cues = [i for i, w in enumerate(words) if self.cue.search(w)]
        found, done = [], 0
        for at in cues:
            if at < done:
                continue  # inside the notice found last
            for _, reduction, which, first in self.rank(words, at, done):
                stretch = self.confirm(which, words, first, at, done)
                if stretch is not None:
                    begin, done = stretch
                    template = self.templates[which]
                    edits = differences(template.words, words[begin:done])
                    place = (spans[begin][0], spans[done - 1][1])
                    found.append((*place, template.license, reduction, edits))
                    break
        return found


def scan(
    df: DataFrame,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, begin, end, license, reduction, differences): one row for each notice in a text.

    ``begin`` and ``end`` are characters of the whole text, ``reduction`` is the share
    of the block's compressed size that the template saves, ``differences`` lists
    lacking and extra words (empty: word for word). Notices do not overlap. If two templates
    save the same, the one given first is confirmed first. Null and empty texts and empty
    tables have no notices; repeated rows and null ids are scanned each; other columns are not
    read. The work on a long text grows with its cues, each of which looks at blocks
    as long as the templates; its words are held as a list.
    """
    ready = compile_templates(templates)
    columns = df.where(F.col(text_col).rlike(f"(?i){CUE}")).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(ready)
        for batch in batches:
            rows = [
                (doc, *notice)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                for notice in scanner.scan(text.as_py())
            ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            names = ["id", "begin", "end", "license", "reduction", "differences"]
            values = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names=names
            )

    kind = "id long, begin long, end long, license string, reduction double, differences string"
    return columns.mapInArrow(task, kind).withColumnRenamed("id", id_col)
