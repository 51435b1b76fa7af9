"""Licence notices by conditional compression.

Words that speak of licences are cues. The text around a cue, on both sides and across
line breaks as far as a template reaches, is compressed alone and with every template
as a raw zstandard dictionary; the bytes saved, as a share of the template's own size,
rank the templates. Those that save bytes are confirmed by their exact wording: the
template's words must occur in order around the cue, except for a few, and numbers and
the words that tell licences apart must be the same. What differs is part of the result.
The search goes on with the cues after the end of a confirmed notice.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import slices

# Wording of common licence notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "MIT short": "Released under the MIT License.",
    "BSD-3-Clause short": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause short": "Licensed under the BSD 2-Clause License.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation; either version 2 of the License",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License",
    "GPL-2.0 short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0 short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0 long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
               "this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
CUE = re.compile(r"licen[sc]|copyright|permission|redistribut|warrant|public domain|creative commons|free software"
                 r"|neighboring rights|\bcc[ -]by|source code form", re.I)
# Words that tell licences apart; one of them in either text must be in both.
_TELLING = frozenset("""mit bsd isc apache gnu general lesser affero mozilla mpl cc by sa nc nd attribution noncommercial
sharealike commercial unencumbered""".split())
#: Share of a template's words that must occur.
WORDS = 0.9

_FOUND = "array<struct<license:string,line:int,saved:double,share:double,differences:array<string>,start:int,end:int>>"


_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+")


def _words(text: str) -> list:
    return _WORD.findall(text.lower())


def differences(template: list, block: list, cue: tuple[int, int], most: int):
    """(share of the template's words found in order, word changes, first, end) for its
    place in ``block`` that holds the words ``cue``, without gaps of over ``most`` words."""
    lo, hi = 0, len(block)
    while lo < hi:
        match = SequenceMatcher(None, template, block[lo:hi], autojunk=False)
        pairs = [(m.a, m.b + lo, m.size) for m in match.get_matching_blocks() if m.size]
        if not pairs:
            break
        wide = next(((x[1] + x[2], y[1]) for x, y in zip(pairs, pairs[1:]) if y[1] - x[1] - x[2] > most), None)
        if wide:  # two places: go on with that of the cue
            lo, hi = (wide[1], hi) if cue[0] >= wide[1] else (lo, wide[0])
            continue
        first, end = pairs[0][1], pairs[-1][1] + pairs[-1][2]
        left = len(template) - pairs[-1][0] - pairs[-1][2]
        if cue[1] <= first - pairs[0][0]:
            hi = first
            continue
        if cue[0] >= end + left:
            lo = end
            continue
        out = ["-" + w for w in template[:pairs[0][0]]]
        for (a, p, n), (c, q, _) in zip(pairs, pairs[1:]):
            out += ["-" + w for w in template[a + n:c]] + ["+" + w for w in block[p + n:q]]
        out += ["-" + w for w in template[len(template) - left:]]
        return sum(n for *_, n in pairs) / len(template), out, first, end
    return 0.0, [], 0, 0


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import zstandard as z

        self.plain = z.ZstdCompressor(level=3)
        self.words = {k: _words(t) for k, t in templates.items()}
        self.size = {k: max(1, len(self.plain.compress(t.encode()))) for k, t in templates.items()}
        self.primed = {k: z.ZstdCompressor(level=3, dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT))
                       for k, t in templates.items()}
        self.reach = {k: 2 * len(t) + 40 for k, t in templates.items()}

    def around(self, text: str, start: int, stop: int, since: int):
        """The best confirmed (license, saved share, word share, differences, start, end)
        that holds the cue text[start:stop] and opens at ``since`` or later, or None."""
        most = max(self.reach.values(), default=0)
        found = list(_WORD.finditer(text, max(since, start - most), stop + most))
        begins, said = [w.start() for w in found], [w[0].lower() for w in found]
        cue = bisect_right(begins, start) - 1, bisect_left(begins, stop)
        out = []
        for k, c in self.primed.items():
            mine, reach = self.words[k], self.reach[k]
            raw = text[max(since, start - reach):stop + reach].encode()  # a notice is as long as its wording
            saved = (len(self.plain.compress(raw)) - len(c.compress(raw))) / self.size[k]
            i, j = bisect_left(begins, start - reach), bisect_left(begins, stop + reach)
            have = set(said[i:j])
            if saved <= 0 or sum(w in have for w in mine) < WORDS * len(mine):
                continue
            limit = max(2, len(mine) // 4)
            share, changed, a, b = differences(mine, said[i:j], (cue[0] - i, cue[1] - i), limit)
            bad = any(w[1:] in _TELLING or w[1:2].isdigit() for w in changed)
            if share >= WORDS and not bad and len(changed) <= limit:
                out.append((k, round(float(saved), 6), float(share), changed, begins[i + a], found[i + b - 1].end()))
        return min(out, key=lambda r: (-r[2], len(r[3]), -len(self.words[r[0]]), r[0]), default=None)

    def scan(self, text: str) -> list:
        out, since = [], 0
        for m in CUE.finditer(text):
            best = self.around(text, m.start(), m.end(), since) if m.start() >= since else None
            if best:
                name, *rest, start, since = best
                out.append((name, text.count("\n", 0, start) + 1, *rest, start, since))
        return out


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, found) for every row of ``docs`` (doc_id, text): each notice, none
    overlapping another, with its licence, the line (from 1) it opens on, saved share,
    share of equal words, changed words and range of characters; an empty array where
    there is none.

    Null or empty texts hold none; null doc_ids and repeated rows are scanned like others;
    an empty table gives an empty result. Narrow; other columns are not read.
    """
    wording = dict(TEMPLATES if templates is None else templates)

    def run(batches):
        scanner = Scanner(wording)
        kind = pa.list_(pa.struct([("license", pa.string()), ("line", pa.int32()), ("saved", pa.float64()),
                                   ("share", pa.float64()), ("differences", pa.list_(pa.string())),
                                   ("start", pa.int32()), ("end", pa.int32())]))
        names = ("license", "line", "saved", "share", "differences", "start", "end")
        for b in slices(batches, 1):
            found = [[dict(zip(names, f)) for f in scanner.scan(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "found"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, found {_FOUND}"))
