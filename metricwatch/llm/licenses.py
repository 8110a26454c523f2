"""License scans by conditional compression.

Texts that name a license or its usual words (found by a JVM filter) are cut into passages of bounded
length around every such word, for each template as long as three of it. Each passage is compressed
by zstandard alone and with the template as a raw dictionary. How many bytes the template saves,
measured against what the template itself compresses to, ranks the templates; those below a floor are
dropped. The rest are confirmed by their exact wording inside the passage: at most a tenth of
the template's words inserted, deleted or changed, and no difference at all in the words that tell
it from other templates. Of a template's wordings that overlap the most exact one counts. These are ranked by the
bytes their template saves on them (then by fewest differences, then by the template's place);
from the top, every one that overlaps none before it is a row.

Passages overlap so that any wording around a usual word is whole in one of them, and their length follows
the template, so it doesn't matter how much other text stands around a notice or in its line.

Defined results: null and empty texts have no row; a run of lines with usual words that no confirmed
passage touches is a row with a null license and confirmed = false, its reduction the best
template's; repeated rows are scanned each; line breaks within a passage don't matter.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Public wordings of license notices, and the words that tell similar ones apart.
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so", "sublicense"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at", "apache 2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License", "gnu general 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "bsd 3-clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met", "redistribution"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "attribution 4.0 international"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0.", "cc0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted", "fee"),
    ("Proprietary", "All rights reserved.", "rights reserved"),
)
#: Words that make a line a candidate.
CUE = r"(?i)licen[sc]e|copyright|all rights reserved|public domain|permission|redistribut|\bcc(0| by)|creative commons|warrant"
#: Allowed part of differing words.
ALLOWED = 0.1
#: A template is a candidate for a passage if it saves at least this part of its own compressed size.
FLOOR = 0.08
_word = re.compile(r"[^\W_]+(?:[-.'][^\W_]+)*")


def words(text: str) -> list[str]:
    return [w.lower() for w in _word.findall(text)]


def wording_differences(template: list[str], block: list[str]) -> tuple[int, list[str]]:
    """Fewest word edits from the template to any passage of the block, and the template words not kept."""
    n = len(block)
    rows = [[0] * (n + 1)]
    for i, a in enumerate(template, 1):
        above, row = rows[-1], [i]
        for j, b in enumerate(block, 1):
            row.append(min(above[j - 1] + (a != b), above[j] + 1, row[j - 1] + 1))
        rows.append(row)
    j = min(range(n + 1), key=rows[-1].__getitem__)
    least, lost, i = rows[-1][j], [], len(template)
    while i:
        if j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            lost += [template[i - 1]] * (template[i - 1] != block[j - 1])
            i, j = i - 1, j - 1
        elif rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            lost.append(template[i])
        else:
            j -= 1
    return least, lost[::-1]


#: One edit in a number that holds edits and, below them, the first word of the passage (a later one is less).
EDIT = 1 << 32


def passages(template: list[str], keys: set[str], limit: int, block: list[str]) -> Iterator[tuple[int, int, int]]:
    """(first word, end, edits) of the best passage up to each end, if it takes ``limit`` edits and keeps all keys."""
    never = (limit + 1) * EDIT
    above = [-j for j in range(len(block) + 1)]
    for a in template:
        cost = never if a in keys else EDIT
        row = [above[0] + cost]
        for j, b in enumerate(block):
            row.append(min(above[j] + (0 if a == b else cost), above[j + 1] + cost, row[j] + EDIT))
        above = row
    for end, value in enumerate(above):
        edits = -(-value // EDIT)
        if edits <= limit:
            yield edits * EDIT - value, end, edits


class Passage(NamedTuple):
    saved: int
    differences: int
    template: int
    first: int
    end: int
    reduction: float


def apart(passages_: Iterable[Passage]) -> list[Passage]:
    """From the front, every passage that overlaps none before it; in the order of their places."""
    taken: list[Passage] = []
    for p in passages_:
        at = bisect(taken, p.first, key=lambda q: q.first)
        if (at == 0 or taken[at - 1].end <= p.first) and (at == len(taken) or p.end <= taken[at].first):
            taken.insert(at, p)
    return taken


class Template(NamedTuple):
    license: str
    words: list[str]
    keys: set[str]
    compressor: zstandard.ZstdCompressor
    size: int


class Scanner:
    """Templates prepared once per task."""

    def __init__(self, templates=TEMPLATES) -> None:
        self.plain = zstandard.ZstdCompressor(level=3, write_content_size=False)
        self.templates = []
        for name, text, keys in templates:
            data = text.lower().encode()
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append(Template(name, words(text), set(keys.split()) & set(words(text)),
                                           zstandard.ZstdCompressor(level=3, dict_data=raw, write_content_size=False),
                                           len(self.plain.compress(data))))

    def sizes(self, part: str, k: int | None = None) -> tuple[int, int]:
        """Compressed bytes of a part alone and with template k, or with the template that saves most."""
        data = part.lower().encode("utf-8", "surrogatepass")
        some = self.templates if k is None else self.templates[k:k + 1]
        alone = len(self.plain.compress(data))
        return alone, min((len(t.compressor.compress(data)) for t in some), default=alone)

    def candidates(self, text: str, places: list[tuple[int, int]], cues: list[int]) -> list[tuple[float, int, int, int]]:
        """(part of its size that it saves, template, first word, end) of all passages above the floor, the best first.

        ``places`` are the words' places in the text, ``cues`` the numbers of the words that a cue begins in.
        """
        out = []
        for k, template in enumerate(self.templates):
            reach, covered = len(template.words) + int(ALLOWED * len(template.words)), -1
            for cue in cues:
                if cue <= covered:
                    continue
                covered = cue + reach  # a wording with a cue up to here is whole in this passage
                first, end = max(0, cue - reach), min(len(places), cue + 2 * reach)
                alone, with_it = self.sizes(text[places[first][0]:places[end - 1][1]], k)
                if alone - with_it >= FLOOR * template.size:
                    out.append(((alone - with_it) / template.size, k, first, end))
        return sorted(out, reverse=True)

    def wordings(self, own: list[str], k: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(first word, end, edits) of the passages of words low to high that are close enough to template k."""
        _, template, keys, _, _ = self.templates[k]
        limit, part = int(ALLOWED * len(template)), own[low:high]
        there = set(part)
        if keys <= there and len(set(template) - there) <= limit:
            for first, end, edits in passages(template, keys, limit, part):
                yield low + first, low + end, edits

    def scan(self, text: str, cue: re.Pattern) -> list[tuple[int, int, str, float, int, list[str]]]:
        """(begin, end, license, reduction, differences, lost words) of the confirmed passages, in order."""
        places = [m.span() for m in _word.finditer(text)]
        ends = [end for _, end in places]
        cues = sorted({bisect(ends, m.start()) for m in cue.finditer(text)} - {len(places)})
        own = [text[a:b].lower() for a, b in places]
        found = {(k, *w) for _, k, first, end in self.candidates(text, places, cues) for w in self.wordings(own, k, first, end)}
        ranked = []
        for k, first, end, edits in found:
            alone, with_it = self.sizes(text[places[first][0]:places[end - 1][1]], k)
            ranked.append(Passage(with_it - alone, edits, k, first, end, 1 - with_it / alone))
        exact = sorted(ranked, key=lambda p: (p.template, p.differences, p))  # of a template's own, the most exact ones
        own_best = [p for _, same in groupby(exact, lambda p: p.template) for p in apart(same)]
        taken = apart(sorted(own_best))
        out = []
        for p in taken:
            template = self.templates[p.template]
            lost = wording_differences(template.words, own[p.first:p.end])[1]
            out.append((places[p.first][0], places[p.end - 1][1], template.license, p.reduction, p.differences, lost))
        return out


def blocks(text: str, cue: re.Pattern) -> Iterator[tuple[int, int, str]]:
    """(first line, number of lines, block): runs of lines with a cue; one line without may stand between."""
    lines = text.split("\n")
    first = last = None
    for k, line in enumerate(lines):
        if cue.search(line):
            if first is not None and k - last > 2:
                yield first, last - first + 1, "\n".join(lines[first:last + 1])
                first = None
            first, last = k if first is None else first, k
    if first is not None:
        yield first, last - first + 1, "\n".join(lines[first:last + 1])


def scan_text(text: str, scanner: Scanner, cue: re.Pattern) -> Iterator[tuple]:
    """Rows of a text, without its id: confirmed passages, then the blocks that none of them touches."""
    lines, line, at = set(), 0, 0
    for begin, end, name, reduction, differences, lost in scanner.scan(text, cue):
        line += text.count("\n", at, begin)
        n = text.count("\n", begin, end) + 1
        at = begin
        lines.update(range(line, line + n))
        yield line, n, text[begin:end], name, reduction, differences, lost, True
    for line, n, block in blocks(text, cue):
        if lines.isdisjoint(range(line, line + n)):
            alone, with_best = scanner.sizes(block)
            yield line, n, block, None, 1 - with_best / alone, None, [], False


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed passage or unexplained block: id, line, n_lines, block (the passage's or the lines' text),
    license, reduction, differences, lost_words, confirmed."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(CUE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, cue = Scanner(templates), re.compile(CUE)
        for batch in batches:
            out = []
            for k, text in enumerate(batch.column(1)):
                out.extend((k, *row) for row in scan_text(text.as_py(), scanner, cue))
            cols = list(zip(*out)) if out else [()] * 9
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int32()))] + [pa.array(c, t) for c, t in zip(cols[1:], (
                    pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.list_(pa.string()), pa.bool_()))],
                ["id", "line", "n_lines", "block", "license", "reduction", "differences", "lost_words", "confirmed"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, line int, n_lines int, block string, license string, reduction double, "
                                "differences int, lost_words array<string>, confirmed boolean")
