"""License scan by patience alignment against license texts and notices.

Words are lower-cased runs of letters and digits. A match of a template may lack a bounded number of its
words, so of one place more than that at least one is kept. The places whose words are rarest in the
text are taken, and the window around every occurrence is aligned with the template: words that are unique in both anchor the
alignment, the longest increasing subsequence of anchors is kept, and the gaps between
them are aligned in the same way; a gap without anchors is matched from both ends. A template is
found when the aligned words cover enough of it and of the span they take in the text (a short
notice must stand word for word). A match inside a longer match of the same license is dropped.

Defined results: null, empty or blank text has no match; ties between overlapping matches go
to the larger coverage, then the longer, then the earlier; repeated notices are counted each;
repeated rows get equal results; null ids are kept; an empty table gives an empty result;
other columns are ignored. Texts are read whole; a notice may stand anywhere.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import LOWER, NON_WORD, slices, text_buffer, word_table

#: (license, text) templates: notices, and the operative paragraphs of license texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("MPL-2.0", "licensed under the Mozilla Public License, version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("All-Rights-Reserved", "All rights reserved"),
)
#: Words too common to look for.
COMMON = frozenset("a all and any at by for free in is it of or that the this to under use with work you".split())
#: Templates under this many words must stand word for word.
SHORT_WORDS = 12
COVERAGE = DENSITY = 0.8
_BITS = 16


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience piles)."""
    tops, at, back = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        back[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience_align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j), a[i] == b[j], both increasing."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        ca, cb = Counter(a[i0:i1]), Counter(b[j0:j1])
        place = {b[j]: j for j in range(j0, j1) if cb[b[j]] == 1}
        both = [(i, place[a[i]]) for i in range(i0, i1) if ca[a[i]] == 1 and a[i] in place]
        if not both:
            continue
        anchors = [both[k] for k in longest_increasing([j for _, j in both])]
        out += anchors
        edges = [(i0 - 1, j0 - 1), *anchors, (i1, j1)]
        todo += [(p + 1, x, q + 1, y) for (p, q), (x, y) in zip(edges, edges[1:])]
    return sorted(out)


class _Template:
    def __init__(self, name, text):
        buf = np.frombuffer(text.encode(), np.uint8)
        start, end, h, _ = word_table(buf, np.array([0, len(buf)]), NON_WORD, LOWER)
        words = [buf[a:z].tobytes().decode().lower() for a, z in zip(start, end)]
        self.name, self.words, self.n = name, h.tolist(), len(h)
        self.short = self.n < SHORT_WORDS
        self.slack = 0 if self.short else self.n // 4
        #: Words that a match may lack.
        self.lack = 0 if self.short else self.n - int(np.ceil(COVERAGE * self.n - 1e-9))
        self.places = [(x, i) for i, (x, w) in enumerate(zip(self.words, words)) if w not in COMMON]
        if len(self.places) <= self.lack or not self.places:
            self.places = [(x, i) for i, x in enumerate(self.words)]
        self.telling = frozenset(x for x, _ in self.places)
        self.least = max(1, len(self.telling) - self.lack)


def _find(words: list[int], where: dict[int, list[int]], t: _Template) -> list[tuple[int, int, float]]:
    """Spans (first word, end word, coverage) of one template in one text."""
    if len(t.telling & where.keys()) < t.least:
        return []
    windows = set()
    for x, i in sorted(t.places, key=lambda x: (len(where.get(x[0], ())), x[1]))[:t.lack + 1]:
        for p in where.get(x, ()):
            lo = max(0, p - i - t.slack)
            windows.add((lo, min(len(words), lo + t.n + 2 * t.slack)))
    out = []
    for lo, hi in sorted(windows):
        if len(t.telling.intersection(words[lo:hi])) < t.least:
            continue
        got = patience_align(words[lo:hi], t.words)
        if not got:
            continue
        a, z = lo + got[0][0], lo + got[-1][0] + 1
        cover, dense = len(got) / t.n, len(got) / (z - a)
        if (cover == 1 and dense == 1) if t.short else (cover >= COVERAGE and dense >= DENSITY):
            out.append((a, z, cover))
    best: list[tuple[int, int, float]] = []
    for a, z, c in sorted(out, key=lambda s: (-s[2], s[0] - s[1], s[0])):
        if all(z <= x or y <= a for x, y, _ in best):
            best.append((a, z, c))
    return best


def scan_words(words: list[int], where: dict[int, list[int]], templates) -> list[tuple[int, int, str, float]]:
    """All matches (first word, end word, license, coverage) of a text, by place."""
    found = [(a, z, t.name, c) for t in templates for a, z, c in _find(words, where, t)]
    return sorted({f for f in found if not any(
        g[2] == f[2] and (g[0], g[1]) != (f[0], f[1]) and g[0] <= f[0] and f[1] <= g[1] for g in found)})


_MATCH = pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("coverage", pa.float64())])


def _scan(templates, schema):
    def run(batches):
        made = [_Template(*t) for t in templates]
        vocab = np.array(sorted({x for t in made for x in t.telling}), np.uint64)
        maybe = np.zeros(1 << _BITS, bool)
        maybe[vocab & np.uint64((1 << _BITS) - 1)] = True
        for b in slices(batches, "text"):
            _, _, h, first = word_table(*text_buffer(b.column("text")), NON_WORD, LOWER)
            at = np.flatnonzero(maybe[h & np.uint64((1 << _BITS) - 1)])
            at = at[np.isin(h[at], vocab)]
            doc = np.searchsorted(first, at, "right") - 1
            out: list[list] = [[] for _ in range(b.num_rows)]
            cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(at) else []
            for i, j in zip(cut[:-1], cut[1:]):
                d = int(doc[i])
                lo = int(first[d])
                where: dict[int, list[int]] = {}
                for p, x in zip((at[i:j] - lo).tolist(), h[at[i:j]].tolist()):
                    where.setdefault(x, []).append(p)
                if any(len(t.telling & where.keys()) >= t.least for t in made):
                    out[d] = [{"license": n, "first_word": a, "end_word": z, "coverage": c}
                              for a, z, n, c in scan_words(h[lo:int(first[d + 1])].tolist(), where, made)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.list_(_MATCH))], schema=schema)
    return run


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per input row: id and its matches (license, first_word, end_word, coverage)."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sch = pa.schema([("id", to_arrow_type(src.schema["id"].dataType)), ("matches", pa.list_(_MATCH))])
    return (src.mapInArrow(_scan(templates, sch), f"id {src.schema['id'].dataType.simpleString()}, "
                           "matches array<struct<license:string,first_word:long,end_word:long,coverage:double>>")
            .withColumnRenamed("id", id_col))
