"""License scans by patience alignment.

A template is aligned with a stretch of text on words: those that occur once in both are anchors,
the longest increasing subsequence of anchors (by patience sorting) is kept, and the gaps between
anchors are aligned the same way; a gap without anchors takes what its ends have in common. A
template's coverage is the share of its words that are aligned.

Stretches. A text that covers a template to the share c misses fewer than (1 - c) of its words, so
of any more of its words than that at least one is there: the stretches around all occurrences of
the ones that are rarest in the text are aligned, and no notice is lost, wherever it stands and
however often it recurs. A stretch may be longer than the template by as many words on either side
as the coverage lets the template miss, and one. Before that, templates of which a text lacks too many words are ruled out
by counts alone.

Names. Notices of different licenses differ in a word or two, so coverage alone cannot tell them.
The telling words of a template (name, version) must all be aligned, those of one phrase without
other words in between, whatever the coverage; one of them must be there, so the stretches around
its occurrences are enough.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm._store import shared

COVERAGE = 0.8

_CC = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

_GNU_HEADER = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
)
_GNU_WARRANTY = (
    " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"


def _gnu(what: str, name: str, version: str, warranty: bool = True) -> str:
    return (_GNU_HEADER + _GNU_WARRANTY * warranty).format(what=what, name=name, version=version)


#: Public license notices, headers and texts.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-header": _gnu("program", _AGPL, "3"),
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "bsd-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "bsl-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"
    ),
    **{f"cc-{kind}-{version}": f"Licensed under CC {kind.upper()} {version}." for kind in _CC for version in ("3.0", "4.0")},
    **{
        f"cc-{kind}-{version}-header": f"This work is licensed under a Creative Commons {name} {version} {place} License."
        for kind, name in _CC.items()
        for version, place in (("3.0", "Unported"), ("4.0", "International"))
    },
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-v": "This work is licensed under the GNU General Public License v2.",
    "gpl-2.0-header": _gnu("program", _GPL, "2"),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-v": "This work is licensed under the GNU General Public License v3.",
    "gpl-3.0-header": _gnu("program", _GPL, "3"),
    "isc": "Released under the ISC License.",
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-header": _gnu("library", _LGPL, "2.1"),
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0-header": _gnu("library", _LGPL, "3"),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files"
    ),
    "mit-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mpl-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at"
    ),
    "unlicense": "Released under the Unlicense.",
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely"
    ),
}

#: Phrases that tell a template's license from others. A template that is not listed
#: needs all of its words if it has at most ``SHORT``, else none in particular.
TELLING = {
    "agpl-3.0": ("gnu affero general public license", "3"),
    "agpl-3.0-header": ("gnu affero general public license", "version 3"),
    "all-rights-reserved": ("all rights reserved",),
    "apache-2.0": ("apache license", "2.0"),
    "apache-2.0-header": ("apache license", "2.0"),
    "bsd": (),
    "bsd-2-clause": ("bsd 2 clause",),
    "bsd-3-clause": ("bsd 3 clause",),
    "bsd-conditions": (),
    "bsd-endorsement": ("endorse or promote products",),
    "bsl-1.0": ("boost software license", "1.0"),
    **{f"cc-{kind}-{version}": (f"cc {kind} {version}",) for kind in _CC for version in ("3.0", "4.0")},
    **{f"cc-{kind}-{version}-header": (f"creative commons {name} {version}",) for kind, name in _CC.items() for version in ("3.0", "4.0")},
    "gpl-2.0": ("gnu general public license", "2"),
    "gpl-2.0-v": ("gnu general public license", "v2"),
    "gpl-2.0-header": ("gnu general public license", "version 2"),
    "gpl-3.0": ("gnu general public license", "3"),
    "gpl-3.0-v": ("gnu general public license", "v3"),
    "gpl-3.0-header": ("gnu general public license", "version 3"),
    "isc": ("isc license",),
    "isc-permission": ("with or without fee", "this permission notice"),
    "lgpl-2.1": ("gnu lesser general public license", "2.1"),
    "lgpl-2.1-header": ("gnu lesser general public license", "version 2.1"),
    "lgpl-3.0": ("gnu lesser general public license", "3"),
    "lgpl-3.0-header": ("gnu lesser general public license", "version 3"),
    "mit": ("mit license",),
    "mit-permission": ("this software and associated documentation files",),
    "mit-text": ("this software and associated documentation files", "the above copyright notice and this permission notice shall be included"),
    "mpl-2.0": ("mozilla public license", "2.0"),
    "mpl-2.0-header": ("mozilla public license", "2.0"),
    "unlicense": ("the unlicense",),
    "unlicense-text": ("free and unencumbered software",),
    "zlib": ("provided as is", "alter it and redistribute it freely"),
}
SHORT = 12

#: Words between telling ones that name one license of several, and words before a name that change it.
JOINING, CHANGING = "or and", "modified same"


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        below[k] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            piles.append(k)
        else:
            tops[pile], piles[pile] = v, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(k)
        k = below[k]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned (text position, template position) pairs, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        once = {text[k]: k for k in range(a, b) if here[text[k]] == 1}
        anchors = [(once[template[k]], k) for k in range(c, d) if there[template[k]] == 1 and template[k] in once]
        kept = [anchors[k] for k in longest_increasing([x for x, _ in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        work += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:])]
    return sorted(out)


def hashed(texts: list[str]) -> list[list[int]]:
    words, _, at = _text.lower_words(pa.array(texts, pa.string()))
    return [words[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def places(phrase: list, template: list) -> tuple[int, ...]:
    """Where the template first holds the phrase."""
    for k in range(len(template) - len(phrase) + 1):
        if template[k : k + len(phrase)] == phrase:
            return tuple(range(k, k + len(phrase)))
    raise ValueError("a telling phrase is not in its template")


class Scanner:
    def __init__(self, templates: Mapping[str, str], coverage: float, telling: Mapping[str, tuple[str, ...]] = TELLING):
        self.coverage = coverage
        self.joining, self.changing, self.numbers = (set(x) for x in hashed([JOINING, CHANGING, " ".join(map(str, range(100)))]))
        words = hashed(list(templates.values()))
        self.names, self.words = zip(*[(n, w) for n, w in zip(templates, words) if w]) if any(words) else ((), ())
        #: the places of each telling phrase of each template
        self.telling = []
        for name, own in zip(self.names, self.words):
            phrases = hashed(list(telling[name])) if name in telling else [own] if len(own) <= SHORT else []
            self.telling.append([places(x, own) for x in phrases])
        self.vocabulary = np.unique(np.array([x for w in self.words for x in w], np.uint64))
        #: how many words of each template (columns) are a given word (rows)
        self.counts = np.zeros((len(self.vocabulary), len(self.words)), np.int64)
        for k, own in enumerate(self.words):
            np.add.at(self.counts, (np.searchsorted(self.vocabulary, np.array(own, np.uint64)), k), 1)
        self.lengths = np.array([len(w) for w in self.words])

    def possible(self, words: np.ndarray, row: np.ndarray, n: int) -> list[tuple[int, int]]:
        """(row, template) pairs where the text has enough of the template's words."""
        if not len(self.vocabulary) or not len(words):
            return []
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words
        pairs = np.unique(row[known] * len(self.vocabulary) + at[known])
        held = np.zeros((n, len(self.words)), np.int64)
        np.add.at(held, pairs // len(self.vocabulary), self.counts[pairs % len(self.vocabulary)])
        rows, templates = np.nonzero(held >= self.coverage * self.lengths - 1e-9)
        return list(zip(rows.tolist(), templates.tolist()))

    def named(self, text: list, pairs: list[tuple[int, int]], phrases: list[tuple[int, ...]]) -> bool:
        """Whether all telling words are aligned, with no word between those of a phrase but in lists
        of licenses, no other number between phrases, and no word before the first that changes it."""
        if not phrases:
            return True
        at, aligned = {j: k for k, j in pairs}, {k for k, _ in pairs}
        if any(j not in at for x in phrases for j in x):
            return False
        other = lambda a, b: {text[k] for k in range(a + 1, b) if k not in aligned}
        for x in phrases:
            for i, j in zip(x, x[1:]):
                if (between := other(at[i], at[j])) and not between & self.joining:
                    return False
        for x, y in zip(phrases, phrases[1:]):
            between = other(at[x[-1]], at[y[0]])
            if between & self.numbers and not between & self.joining:
                return False
        first = at[phrases[0][0]]
        return not (first and text[first - 1] in self.changing)

    def scan(self, text: list, template: list, phrases: list[tuple[int, ...]] = []) -> list[tuple[float, int, int, int]]:  # noqa: B006
        """(coverage, aligned words, first word, word after the last) of disjoint notices, in order."""
        spots: dict = {w: [] for w in template}
        for k, w in enumerate(text):
            if w in spots:
                spots[w].append(k)
        count = Counter(template)
        if phrases:
            # any telling word must be aligned where the template has it
            j = min((j for x in phrases for j in x), key=lambda j: (len(spots[template[j]]), j))
            starts = {k - j for k in spots[template[j]]}
        else:
            missing, least = len(template) - self.coverage * len(template), []
            for w in sorted(spots, key=lambda w: (len(spots[w]) / count[w], w)):
                least.append(w)
                missing -= count[w]
                if missing < -1e-9:
                    break
            starts = {k - j for j, w in enumerate(template) if w in least for k in spots[w]}
        found = []
        slack = int(len(template) * (1 - self.coverage) + 1e-9) + 1
        for start in sorted(starts):
            # the second, without room for other words, has fewer repeats that hide anchors
            for room in (slack, 0):
                a, b = max(0, start - room), max(0, min(len(text), start + len(template) + room))
                pairs = align(text[a:b], template)
                if len(pairs) >= self.coverage * len(template) - 1e-9 and self.named(text, [(a + k, j) for k, j in pairs], phrases):
                    found.append((len(pairs) / len(template), len(pairs), a + pairs[0][0], a + pairs[-1][0] + 1))
                    break
        # of overlapping ones the best, the tightest, the first
        out: list[tuple[float, int, int, int]] = []
        for hit in sorted(set(found), key=lambda x: (-x[0], x[3] - x[2], x[2])):
            if all(hit[3] <= o[2] or hit[2] >= o[3] for o in out):
                out.append(hit)
        return sorted(out, key=lambda x: x[2])


_SCHEMA = "id {id}, license string, coverage double, n_notices int, first_word int, after_word int"


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    telling: Mapping[str, tuple[str, ...]] = TELLING,
) -> DataFrame:
    """(id_col, license, coverage, n_notices, first_word, after_word): a row for each document row
    and template it covers to ``coverage`` or more, all telling words among them; the last two are the words of the best notice
    (the first of several). Words are lower-cased runs of letters, digits and underscores.

    Null and empty texts and texts without a notice give no rows, templates without words are
    never found, rows that repeat give repeated rows, an empty table or no templates no rows.
    """
    scanner = shared(docs.sparkSession, Scanner(templates, coverage, telling))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = pickle.loads(scanner.value)
        for part in _text.chunks(batches, "text"):
            words, row, at = _text.lower_words(part.column("text"))
            out, last, text = [], -1, []
            for r, k in own.possible(words, row, part.num_rows):
                if r != last:
                    last, text = r, words[at[r] : at[r + 1]].tolist()
                hits = own.scan(text, own.words[k], own.telling[k])
                if hits:
                    best = max(hits, key=lambda x: (x[0], -x[2]))
                    out.append((r, own.names[k], best[0], len(hits), best[2], best[3]))
            if out:
                r, name, share, n, first, after = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(r)), pa.array(name), pa.array(share), *[pa.array(x, pa.int32()) for x in (n, first, after)]],
                    names=["id", "license", "coverage", "n_notices", "first_word", "after_word"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _SCHEMA.format(id=kind)).withColumnRenamed("id", id_col)
