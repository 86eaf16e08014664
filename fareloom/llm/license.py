"""License texts found by patience alignment.

The text's words and a template's words are anchored where a word occurs once in both; the longest
increasing run of anchors (by their place in the template) is kept, and the gaps between anchors are
aligned the same way, where words may be unique again. A gap without unique common words is aligned
from both ends. Coverage is the share of the template's words that got a partner.

Only words that occur in some template matter, so a text is first reduced to those, in order and
with their places; a template is aligned only if the distinct words it shares with the text could
reach the wanted coverage. The reduced text is cut at long stretches without any template word
(``reach`` words), since a license is not spread over them, and aligned in windows around the words
that a match cannot lack. All matches count, those of one template without overlap.

A notice of fewer than ``short`` words must be there in full; a longer one needs its telling words
(name, variant, version). From its first to its last matched word a match has at most half as many
words again as the template (three more at least), and no word among them that names a sibling.

Null and empty texts have no words and no rows. A text of any length is read whole: one beyond the size
of a step is a step of its own. Repeated rows give repeated results; a null id stays
null. All templates that reach the coverage are listed, at each place, but for matches that lie
within the span of one with more matched words, or have the very span of one with as many. Offsets count
characters. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import released, steps, uniques, words

_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC": "Attribution-NonCommercial", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_GNU = {
    "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"),
    "AGPL-3.0": ("Affero General", "3"),
}

# Identifiers of well-known public licenses, and the names they go by.
NAMES = {
    "MIT": ("MIT License", "MIT Expat License"),
    "Apache-2.0": ("Apache License 2.0", "Apache License Version 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache License v2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause License"),
    "ISC": ("ISC License",),
    "GPL-2.0": ("GNU General Public License v2.0", "GNU General Public License Version 2", "GNU General Public License Version 2.0", "GNU GPL v2", "GPLv2 License"),
    "GPL-3.0": ("GNU General Public License v3.0", "GNU General Public License Version 3", "GNU General Public License Version 3.0", "GNU GPL v3", "GPLv3 License"),
    "LGPL-2.1": ("GNU Lesser General Public License v2.1", "GNU Lesser General Public License Version 2.1", "GNU LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License v3.0", "GNU Lesser General Public License Version 3", "GNU LGPL v3"),
    "AGPL-3.0": ("GNU Affero General Public License v3.0", "GNU Affero General Public License Version 3", "GNU AGPL v3"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License v2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License Version 2.0", "Eclipse Public License v2.0"),
    "BSL-1.0": ("Boost Software License 1.0", "Boost Software License Version 1.0"),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic License Version 2.0"),
    "CC0-1.0": ("CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal"),
    "Zlib": ("zlib License",),
    "Unlicense": ("Unlicense License", "Unlicense"),
}

#: Words from which a name is a notice by itself.
SAID_ALONE = 4


def named_notices() -> dict[str, str]:
    """Notices made of the names: an SPDX line, "under the ..." (as in licensed, released, distributed
    under the terms of the), also with the name's words joined by hyphens, and long names alone."""
    found = {}
    for key, names in NAMES.items():
        endings = ("", "-only", "-or-later") if "GPL" in key else ("",)
        found |= {f"{key}-spdx{e}": f"SPDX-License-Identifier: {key}{e}" for e in endings}
        for i, name in enumerate(names):
            found[f"{key}-under-{i}"] = f"under the {name}"
            if " " in name:
                found[f"{key}-joined-{i}"] = f"under the {name.replace(' ', '-')}"
            if len(name.split()) >= SAID_ALONE:
                found[f"{key}-name-{i}"] = name
    return found


_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,"
    " BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
    " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
    " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE"
    " OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
    " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and"
    " the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
    " from this software without specific prior written permission. "
)
_COPYING = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."

# Whole texts of short licenses, and how the long ones begin.
TEXTS = {
    "BSD-2-Clause": f"{_BSD_HEAD} {_AS_IS}",
    "BSD-3-Clause": f"{_BSD_HEAD}{_BSD_THIRD}{_AS_IS}",
    "MIT-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
        " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
        " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\""
        " AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY"
        " AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
        " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER"
        " TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for"
        " any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,"
        " including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
        " with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND"
        " DISTRIBUTION 1. Definitions."
    ),
    "GPL-2.0-text": f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_COPYING}",
    "GPL-3.0-text": f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_COPYING}",
    "LGPL-2.1-text": f"GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. {_COPYING}",
    "LGPL-3.0-text": f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_COPYING}",
    "AGPL-3.0-text": f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_COPYING}",
}

# Notices by which well-known public licenses are declared.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "Apache-1.1-line": "Licensed under the Apache License, Version 1.1",
    "MIT-line": "Released under the MIT License",
    "BSD-line": "Released under the BSD License",
    **{f"{k}-line": f"This work is licensed under the GNU {kind} Public License, version {v}" for k, (kind, v) in _GNU.items()},
    **{f"CC-{k}-4.0-line": f"Licensed under CC {k} 4.0" for k in _CC if k != "BY"},
    "CC-BY-4.0-brief": "Licensed under CC BY 4.0",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    **{f"CC-{k}-4.0-work": f"This work is licensed under a Creative Commons {v} 4.0 International License" for k, v in _CC.items() if k != "BY"},
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable"
        " law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom"
        " the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission"
        " notice shall be included in all copies or substantial portions of the Software."
    ),
    **{
        k: f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License"
        f" as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version."
        for k, (kind, v) in _GNU.items()
    },
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and"
        " the following disclaimer."
    ),
    **TEXTS,
    **named_notices(),
}

# Words without which a long notice is another one, and words that make a notice another's.
TELLING = {"Apache-2.0": ("apache", "2.0"), "Apache-2.0-text": ("apache", "2.0"), "MPL-2.0": ("mozilla", "2.0"), "BSD-3-Clause": ("neither", "endorse")}
TELLING |= {f"{k}{e}": (*f"gnu {kind} public".lower().split(), v) for k, (kind, v) in _GNU.items() for e in ("", "-text")}
_QUALIFIERS = {
    "GPL": "lesser library affero",
    "CC-": "sharealike share-alike share noncommercial non-commercial non noderivatives no-derivatives noderivs no-derivs no nc nd sa",
}
BARRED = {k: tuple(w.split()) for k in TEMPLATES for family, w in _QUALIFIERS.items() if k.removeprefix("L").removeprefix("A").startswith(family)}
BARRED["BSD-line"] = ("2-clause", "3-clause", "4-clause", "simplified", "new", "modified")

EDGES = ".,;:!?\"'()[]{}<>|*#$%&"
SCHEMA = "doc_id long, license string, coverage double, matched int, start int, end int"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bare(flat: pa.Array) -> pa.Array:
    return pc.utf8_trim(flat, EDGES)


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by piles of patience."""
    tops: list[int] = []
    holders: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = holders[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            holders.append(i)
        else:
            tops[pile], holders[pile] = v, i
    chain, i = [], holders[-1] if holders else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of two lists of words, in order.

    Gaps wait on a list of their own, so nesting costs no call depth.
    """
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at_b]
        chain = [anchors[k] for k in increasing([j for _, j in anchors])]
        if not chain:
            continue
        pairs += chain
        corners = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(corners, corners[1:], strict=False)]
    return sorted(pairs)


def stretches(places: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Runs of places with at most ``reach`` between neighbours."""
    cuts = [0, *(np.flatnonzero(np.diff(places) > reach) + 1).tolist(), len(places)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class Notice(NamedTuple):
    """A template in numbered words, and what a match of it needs."""

    words: list[int]
    least: int  # matched words
    telling: frozenset[int]  # places in ``words``
    barred: frozenset[int]

    @property
    def span(self) -> int:
        """Words of the text that a match may reach over."""
        return len(self.words) + max(3, len(self.words) // 2)


def tightened(pairs: list[tuple[int, int]], a: list[int]) -> list[tuple[int, int]]:
    """The same matched words of the template by places in ``a`` as near to each other as order lets them be."""
    pairs = list(pairs)
    for k in range(1, len(pairs)):
        i, j = pairs[k]
        pairs[k] = a.index(a[i], pairs[k - 1][0] + 1), j
    for k in range(len(pairs) - 2, -1, -1):
        i, j = pairs[k]
        pairs[k] = next(x for x in range(pairs[k + 1][0] - 1, i - 1, -1) if a[x] == a[i]), j
    return pairs


def densest(pairs: list[tuple[int, int]], at: list[int], span: int) -> list[tuple[int, int]]:
    """The most neighbouring pairs whose places in the text lie within ``span`` words."""
    best, first = (0, 0), 0
    for last in range(len(pairs)):
        while at[pairs[last][0]] - at[pairs[first][0]] >= span:
            first += 1
        if last + 1 - first > best[1] - best[0]:
            best = first, last + 1
    return pairs[best[0] : best[1]]


def in_full(own: list[int], at: list[int], notice: Notice, last: int, floor: int) -> list[int]:
    """Places in ``own`` of all words of a notice whose last word is at ``last``; none if one lacks."""
    found, j = [], len(notice.words) - 1
    for i in range(last, floor - 1, -1):
        if at[last] - at[i] >= notice.span:
            break
        if own[i] == notice.words[j]:
            found.append(i)
            j -= 1
            if j < 0:
                return found[::-1]
    return []


def matches(ids: list[int], places: np.ndarray, notice: Notice, reach: int) -> Iterator[tuple[int, int, int]]:
    """Matched words, and the first and last place, of the matches of a notice in a text."""
    n, wanted = len(notice.words), set(notice.words)
    own, at = [], []
    barred = [p for w, p in zip(ids, places.tolist(), strict=True) if w in notice.barred and w not in wanted]
    for w, p in zip(ids, places.tolist(), strict=True):
        if w in wanted:
            own.append(w)
            at.append(p)
    count = Counter(own)
    if notice.least == n:
        holders = {notice.words[-1]}
    elif notice.telling:
        holders = {min((notice.words[j] for j in notice.telling), key=lambda w: (count[w], w))}
    else:  # a match lacks at most n - least words, so it has one of that many and one more
        holders = set(sorted(wanted, key=lambda w: (count[w], w))[: n - notice.least + 1])
    within = {w: [j for j, x in enumerate(notice.words) if x == w] for w in holders}
    done = -1
    for a, b in stretches(np.array(at), reach):
        for k in range(a, b):
            if own[k] not in holders or at[k] <= done:
                continue
            if notice.least == n:
                # the stretch that holds all its words in order is aligned like any other
                whole = in_full(own, at, notice, k, bisect_left(at, done + 1, a, b))
                pairs = patience(own[whole[0] : k + 1], notice.words) if whole else []
                found = [whole[0] + i for i, _ in pairs] if len(pairs) == n else []
            else:
                low, high = at[k] - max(within[own[k]]) * 3 // 2 - 3, at[k] + (n - min(within[own[k]])) * 3 // 2 + 3
                first, end = bisect_left(at, max(low, done + 1), a, b), bisect_left(at, high + 1, a, b)
                part = own[first:end]
                pairs = densest(tightened(patience(part, notice.words), part), at[first:end], notice.span)
                if len(pairs) < notice.least or not notice.telling <= {j for _, j in pairs}:
                    continue
                found = [first + i for i, _ in pairs]
            if not found:
                continue
            start, stop = at[found[0]], at[found[-1]]
            if bisect_left(barred, start) < bisect_left(barred, stop):
                continue
            yield len(found), start, stop
            done = stop


#: Words of a text for which ``outermost`` keeps a list of spans, so that a match is held against few.
NEAR = 256


def outermost(found: list[tuple]) -> list[tuple]:
    """Matches that do not lie within the span of another with more matched words, or have the very
    span of one with as many, by their places."""
    kept, spans = [], defaultdict(list)
    for name, coverage, matched, a, b in sorted(found, key=lambda x: (-x[2], -x[1], x[0], x[3])):
        if not any(c <= a and b <= d and (matched < m or (a, b) == (c, d)) for c, d, m in spans[a // NEAR]):
            kept.append((name, coverage, matched, a, b))
            for near in range(a // NEAR, b // NEAR + 1):
                spans[near].append((a, b, matched))
    return sorted(kept, key=lambda x: (x[3], x[4], x[0]))


def license_scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, min_coverage: float = 0.8, reach: int = 8,
    id_column: str = "doc_id", text_column: str = "text", short: int = 20,
    telling: Mapping[str, Iterable[str]] = TELLING, barred: Mapping[str, Iterable[str]] = BARRED,
) -> DataFrame:
    """One row for each place of each license in each text: the share of the template covered, its matched
    words, and the characters from its first to its last matched word."""
    names = list(templates)
    split = [bare(words(pa.array([templates[n]]))[0]).to_pylist() for n in names]
    vocabulary = sorted({w for t in split for w in t} | {w for n in names for w in barred.get(n, ())})
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = [[number[w] for w in t] for t in split]
    member = np.zeros((len(names), len(vocabulary) + 1), np.int64)
    for k, t in enumerate(coded):
        member[k, t] = 1
    # words of a template that a text may lack, counted as distinct words
    lacking = np.array([0 if len(t) < short else int((1 - min_coverage) * len(t) + 1e-9) for t in coded])
    needed = member.sum(1) - lacking
    notices = []
    for name, t, lack in zip(names, coded, lacking.tolist(), strict=True):
        told, sibling = ({number[w] for w in words_of.get(name, ()) if w in number} for words_of in (telling, barred))
        notices.append(Notice(t, len(t) - lack, frozenset(j for j, w in enumerate(t) if w in told), frozenset(sibling)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            for part in steps(batch, "text"):
                texts, ids = part.column("text"), part.column("doc_id")
                flat, bounds = words(texts)
                distinct, place = uniques(flat)
                code = pc.fill_null(pc.index_in(bare(distinct), known), len(vocabulary)).to_numpy(zero_copy_only=False)
                code = code[place] if len(flat) else place
                hits = np.flatnonzero(code < len(vocabulary))
                owner = np.searchsorted(bounds, hits, "right") - 1
                rows = []
                for doc, first, last in zip(*_runs(owner), strict=True):
                    own = hits[first:last]
                    there = np.zeros(len(vocabulary) + 1, np.int64)
                    there[code[own]] = 1
                    able = np.flatnonzero(member @ there >= np.maximum(needed, 1))
                    if not len(able):
                        continue
                    found = []
                    for k in able:
                        for match in matches(code[own].tolist(), own - bounds[doc], notices[k], reach):
                            found.append((names[k], match[0] / len(coded[k]), *match))
                    if found:
                        spans = [m.span() for m in _WORD.finditer(texts[int(doc)].as_py())]
                        rows += [(ids[int(doc)].as_py(), n, c, m, spans[a][0], spans[b][1]) for n, c, m, a, b in outermost(found)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(released(run), SCHEMA)


def _runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a sorted array, and where each begins and ends."""
    values, first = np.unique(owner, return_index=True)
    return values, first, np.append(first, len(owner))[1:]


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int32()),
     ("start", pa.int32()), ("end", pa.int32())]
)
