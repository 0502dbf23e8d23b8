"""License notices: normalised text against templates by the Dice coefficient over word bigrams.

What is compared are the lines of a text, its paragraphs, the whole of it, and windows of words that
begin and end with a bigram of a template. Bigrams of a whole slice are looked up at once; only texts
with enough bigrams of a template are scored, and only against the templates whose size allows the
coefficient to reach the threshold.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

DICE = 0.8

# Public notices, as their licences or common usage word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("Apache-2.0", "Licensed under Apache 2.0."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU GPL version 3."),
    ("GPL-2.0", "Licensed under the GNU GPL version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    *(
        (
            name,
            f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU "
            f"{kind} as published by the Free Software Foundation; either version {version} of the License, or (at "
            "your option) any later version.",
        )
        for name, what, kind, version in (
            ("GPL-2.0", "program", "General Public License", "2"),
            ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
            ("LGPL-3.0", "program", "Lesser General Public License", "3"),
            ("AGPL-3.0", "program", "Affero General Public License", "3"),
        )
    ),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    *(
        (f"CC-{name}-4.0", f"This work is licensed under a Creative Commons {words} 4.0 International License.")
        for name, words in (
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
)

# Whole texts, in ``licenses``.
TEXTS = (
    "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
    "MPL-2.0", "CC0-1.0",
)
TEMPLATES += tuple((name, pkgutil.get_data(__package__, f"licenses/{name}.txt").decode()) for name in TEXTS)

# Up to this many bigrams a template is a notice, whose numbers (versions) a window must have too.
NOTICE = 64


def bigrams(words: np.ndarray) -> np.ndarray:
    """Sorted distinct bigrams of a unit; none if it has fewer than two words."""
    return np.unique(c.Rolling(words).grams(2, 40))


class Templates:
    """Bigrams of all templates, the templates that have each, and the templates' sizes."""

    def __init__(self, templates=TEMPLATES):
        data, offsets = c.text_bytes(pa.array([t for _, t in templates], pa.string()))
        words, first = c.plain_words(data, offsets)
        self.names = [name for name, _ in templates]
        self.sets = [bigrams(words[a:b]) for a, b in zip(first[:-1], first[1:])]
        self.sizes = np.array([len(s) for s in self.sets])
        self.every, number = np.unique(np.concatenate(self.sets), return_inverse=True)
        order = np.argsort(number, kind="stable")
        # Templates with bigram g: owner[start[g] : start[g + 1]].
        self.owner = np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.start = np.searchsorted(number[order], np.arange(len(self.every) + 1))
        # With a coefficient of DICE a template shares at least DICE / (2 - DICE) of its bigrams, and a
        # window has at most (2 - DICE) / DICE times as many; repeats within the template count here.
        self.fewest = np.ceil(self.sizes * DICE / (2 - DICE) - 1e-9).astype(int)
        self.longest = np.floor((np.diff(first) - 1) * (2 - DICE) / DICE + 1e-9).astype(int)
        self.numbers = [
            np.unique([words[first[t] + i] for i, w in enumerate(re.findall("[0-9A-Za-z]+", text)) if w.isdigit()])
            if self.sizes[t] <= NOTICE
            else np.zeros(0, np.uint64)
            for t, (_, text) in enumerate(templates)
        ]

    def places(self, grams: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, template) of every bigram of a template, by place; only where ``inside``."""
        at = np.minimum(np.searchsorted(self.every, grams), len(self.every) - 1)
        place = np.flatnonzero((self.every[at] == grams) & inside)
        at = at[place]
        counts = self.start[at + 1] - self.start[at]
        return np.repeat(place, counts), self.owner[c.spread(self.start[at], counts)]

    def best(self, words: np.ndarray, among: np.ndarray) -> tuple[int, float] | None:
        """The template with the largest coefficient of at least DICE, the first of equals."""
        own = bigrams(words)
        n = len(own)
        # 2 * min / (n + m) bounds the coefficient, so sizes far apart need no look at the bigrams.
        bound = 2 * np.minimum(n, self.sizes[among]) / np.maximum(n + self.sizes[among], 1)
        found = None
        for t in among[bound >= DICE - 1e-12].tolist():
            dice = 2 * np.isin(own, self.sets[t], assume_unique=True).sum() / (n + self.sizes[t])
            if dice >= DICE - 1e-12 and (found is None or dice > found[1]):
                found = (t, float(dice))
        return found

    def windows(self, words: np.ndarray, place: np.ndarray, template: np.ndarray) -> list[tuple]:
        """(first word, end, template, coefficient) of windows that reach DICE, by start.

        A window begins and ends with a bigram of its template: without them it would score more. For
        each beginning the best end is taken; of windows that overlap the one that shares most bigrams
        is kept, of these the one with the largest coefficient."""
        grams = c.Rolling(words).grams(2, 40)
        _, number = np.unique(grams, return_inverse=True)
        order = np.argsort(number, kind="stable")
        before = np.full(len(grams), -1)
        again = np.flatnonzero(number[order][1:] == number[order][:-1]) + 1
        before[order[again]] = order[again - 1]
        found = []
        for t in np.unique(template).tolist():
            at, size, fewest, longest = place[template == t], self.sizes[t], self.fewest[t], self.longest[t]
            dense = at[fewest - 1 :] - at[: len(at) - fewest + 1] < longest
            hit = np.zeros(len(grams), bool)
            hit[at] = True
            for s in at[: len(dense)][dense].tolist():
                fresh = before[s : s + longest] < s
                shared = np.cumsum(fresh & hit[s : s + longest])
                dice = 2 * shared / (np.cumsum(fresh) + size)
                for value in self.numbers[t]:
                    there = np.flatnonzero(words[s : s + longest + 1] == value)
                    dice[: there[0] - 1 if len(there) else None] = 0
                e = int(dice.argmax())
                if dice[e] >= DICE - 1e-12:
                    found.append((int(shared[e]), float(dice[e]), s, s + e + 2, t))
        kept: list[tuple] = []
        for _, dice, a, b, t in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[4])):
            i = bisect_left(kept, (a,))
            if (i == 0 or kept[i - 1][1] <= a) and (i == len(kept) or kept[i][0] >= b):
                kept.insert(i, (a, b, t, dice))
        return kept


FOUND = "doc_id long, unit string, start long, end long, license string, dice double"


def _units(data: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of lines, of paragraphs of several lines, and of texts of several lines."""
    ends = np.append(np.flatnonzero(data == 10), len(data)).tolist()
    lines = list(zip([0, *(e + 1 for e in ends[:-1])], ends))
    yield from (("line", a, b) for a, b in lines)
    group: list[tuple[int, int]] = []
    for a, b in [*lines, (len(data), len(data))]:
        if not c.SPACE[data[a:b]].all():
            group.append((a, b))
        else:
            if 1 < len(group) < len(lines):
                yield "paragraph", group[0][0], group[-1][1]
            group = []
    if len(lines) > 1:
        yield "text", 0, len(data)


def _notices(templates: Templates, data: np.ndarray, words: np.ndarray, place, template) -> Iterator[tuple]:
    """(kind, start, end, template, coefficient) in one document; ``place`` and ``template`` are its
    bigrams of the templates that have enough there. A unit with too few of them is not scored. A
    window is given unless a unit that has the same name and overlaps it is."""
    starts, ends, _ = c.find_words(c.PLAIN[data], np.array([0, len(data)]))
    among = np.unique(template)
    hit = np.zeros(len(words), bool)
    hit[place] = True
    total = np.append(0, np.cumsum(hit))
    units = []
    for kind, a, b in _units(data):
        x, y = np.searchsorted(starts, [a, b])
        if total[y] - total[x] >= templates.fewest[among].min():
            found = templates.best(words[x:y], among)
            if found:
                units.append((x, y, templates.names[found[0]]))
                yield kind, a, b, *found
    for x, y, t, dice in templates.windows(words, place, template):
        if not any(u < y and x < v and name == templates.names[t] for u, v, name in units):
            yield "window", int(starts[x]), int(ends[y - 1]), t, dice


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    templates = Templates()
    many = len(templates.names)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for at, count, data, offsets in c.slices(batch, "text"):
            words, first = c.plain_words(data, offsets)
            # A bigram that begins with the last word of a text is none.
            inside = np.ones(max(len(words) - 1, 0), bool)
            inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(words))] - 1] = False
            place, template = templates.places(c.Rolling(words).grams(2, 40), inside)
            pair = (np.searchsorted(first, place, "right") - 1) * many + template
            enough = np.bincount(pair, minlength=count * many) >= np.tile(templates.fewest, count)
            place, template, document = (x[enough[pair]] for x in (place, template, pair // many))
            for row in np.unique(document).tolist():
                own = data[offsets[row] : offsets[row + 1]]
                x, y = np.searchsorted(document, [row, row + 1])
                inner = words[first[row] : first[row + 1]]
                for kind, a, b, best, dice in _notices(templates, own, inner, place[x:y] - first[row], template[x:y]):
                    # Bytes that continue a character do not count as code points.
                    start = int(np.count_nonzero((own[:a] & 0xC0) != 0x80))
                    end = start + int(np.count_nonzero((own[a:b] & 0xC0) != 0x80))
                    rows.append((ids[at + row], kind, start, end, templates.names[best], dice))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            names=[x.split()[0] for x in FOUND.split(", ")],
        )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, unit, start, end, license, dice): notices in each text.

    A unit is a line, a paragraph (lines up to a blank one), the whole text or, where no such unit of
    the same licence is given, a window of words; start and end are code points, end exclusive. A
    window has at most 1.5 times a template's words, and all numbers of a short template; of windows
    that overlap one is given. A unit is a notice if the Dice coefficient of its distinct word bigrams with a
    template's reaches DICE; the best template is named, of equal ones the first. Words are runs of
    letters and digits, A-Z folded. Null or empty texts have no notice; rows that repeat are answered
    each; a null id stays null. Other columns are ignored; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, FOUND)
