"""License scans by template markup.

A template is license wording with markup: ``[[ ... ]]`` is an optional region, ``{{n}}`` a replaceable region of up to n
words; everything else is mandatory. It is compiled into an automaton over words, which accepts a stretch of a text only if
all mandatory wording is there, word for word. All words of a batch are hashed in numpy; automata run only from places where
a template's first mandatory word stands (with the next one, if that is mandatory too). Regions before that word match
whatever stands there, so they are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from factloom.llm import texts as T
from factloom.llm.runtime import ensure_importable, free

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
    MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE"""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are
    met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
    [[2.]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY {{12}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES
    OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{12}} BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
    USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
    DAMAGE."""
_GNU = """{{12}} is free software: you can redistribute it and/or modify it under the terms of the GNU %s as published by the Free Software
    Foundation, either version %s of the License, or (at your option) any later version. {{12}} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU %s for more
    details."""

#: Wording of public licenses (whole for short ones) and of the notices of long ones, with markup. Labels are those of the method.
TEMPLATES = {
    "mit-notice": "released under the [[terms of the]] MIT License",
    "mit-text": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice [[(including the next paragraph)]] shall be
        included in all copies or substantial portions of the Software. {_AS_IS} AND NONINFRINGEMENT. IN NO EVENT SHALL {{{{8}}}} BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-0-text": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
        {_AS_IS} AND NONINFRINGEMENT. IN NO EVENT SHALL {{{{8}}}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-2.0-notice": "licensed under the Apache License, Version 2.0",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at [[http]] [[https]] www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-3.0-notice": "{{1}} work is licensed under the GNU General Public License, version 3 [[or any later version]]",
    "gpl-2.0-header": _GNU % (("General Public License", "2") + ("General Public License",)),
    "gpl-3.0-header": _GNU % (("General Public License", "3") + ("General Public License",)),
    "lgpl-3.0-header": _GNU % (("Lesser General Public License", "3") + ("Lesser General Public License",)),
    "agpl-3.0-header": _GNU % (("Affero General Public License", "3") + ("Affero General Public License",)),
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at [[http]] [[https]] mozilla.org/MPL/2.0/""",
    "cc-by-nc-4.0-notice": "licensed under [[a]] [[the]] CC BY-NC 4.0 [[license]]",
    "cc-notice": "licensed under [[a]] [[the]] Creative Commons {{6}} License",
    "bsd-2-clause-text": _BSD + _BSD_END,
    "bsd-3-clause-text": _BSD + """[[3.]] Neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products derived
        from this software without specific prior written permission. """ + _BSD_END,
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND {{6}} DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{6}} BE LIABLE
        FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "0bsd-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE
        IS PROVIDED "AS IS" AND {{6}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL {{6}} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
        FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: [[1.]] The origin of this software must not
        be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. [[2.]] Altered source versions must be plainly marked as such, and must not
        be misrepresented as being the original software. [[3.]] This notice may not be removed or altered from any source distribution.""",
    "bsl-1.0-notice": "Distributed under the Boost Software License, Version 1.0",
    "unlicense-text": f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by
        any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
        the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
        under copyright law. {_AS_IS} AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
        IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
        SOFTWARE.""",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd": "SPDX-License-Identifier: BSD-{{1}}-Clause",
    "spdx-gpl": "SPDX-License-Identifier: GPL-{{1}}.0 [[or later]] [[only]]",
}

_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Automaton:
    """Positions 0..n; position k goes to k + 1 over a word (``words[k]``, None: any). skips[k]: positions reached from k without a word."""

    def __init__(self, template: str):
        self.words: list[int | None] = []
        self.mandatory: list[bool] = []
        jumps: list[tuple[int, int]] = []
        opened: list[int] = []
        for m in _MARK.finditer(template.translate(_UPPER)):
            if m[0] == "[[":
                opened.append(len(self.words))
            elif m[0] == "]]":
                jumps.append((opened.pop(), len(self.words)))
            elif m[1] is not None:
                first, n = len(self.words), int(m[1])
                self.words += [None] * n
                self.mandatory += [False] * n
                jumps += [(k, first + n) for k in range(first, first + n)]
            else:
                self.words.append(T.hash_of(m[0].encode()))
                self.mandatory.append(not opened)
        n = len(self.words)
        self.skips: list[tuple[int, ...]] = [()] * (n + 1)
        for k in range(n, -1, -1):
            reach = {k}
            for a, b in jumps:
                if a == k:
                    reach |= {b, *self.skips[b]}
            self.skips[k] = tuple(sorted(reach))
        for k in range(n, -1, -1):
            self.skips[k] = tuple(sorted({y for x in self.skips[k] for y in self.skips[x]} | {k}))
        self.total = sum(self.mandatory)
        #: Mandatory words before each position.
        self.before = [0, *np.cumsum(self.mandatory).tolist()]
        if not self.total:
            raise ValueError("a template needs mandatory wording")
        #: The first mandatory word, and the words from it on that every match has (two at most).
        self.anchor = self.mandatory.index(True)
        self.head = self.words[self.anchor : self.anchor + (2 if self.mandatory[self.anchor + 1 : self.anchor + 2] == [True] else 1)]

    def run(self, words: list[int]) -> tuple[int, float]:
        """Length of the longest accepted stretch from the first word on (0: none), and the share of mandatory wording met."""
        active, best, share = set(self.skips[self.anchor]), 0, 0.0
        n = len(self.words)
        for at, w in enumerate(words):
            nxt: set[int] = set()
            for k in active:
                if k < n and (self.words[k] is None or self.words[k] == w):
                    nxt.update(self.skips[k + 1])
            if not nxt:
                break
            active = nxt
            share = max(share, max(self.before[k] for k in active) / self.total)
            if n in active:
                best = at + 1
        return best, share


def scan_texts(arr: pa.Array, automata: dict[str, Automaton], phrases: dict[str, tuple[str, list[int]]]) -> list[tuple]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) for each text."""
    out: list[tuple] = []
    for data, offsets in T.block_views(arr, 1 << 20):
        data = T.LOWER[data]
        start, end, first = T.runs(T.ALNUM[data], offsets)
        row, rows = T.owners(first), len(offsets) - 1
        words = T.SpanHash(data)(start, end)

        def places(hashes: list[int]) -> np.ndarray:
            n = len(words) - len(hashes) + 1
            if n < 1:
                return np.zeros(0, np.int64)
            ok = words[:n] == np.uint64(hashes[0])
            for k, h in enumerate(hashes[1:], 1):
                at = np.flatnonzero(ok)
                ok[at] = (words[at + k] == np.uint64(h)) & (row[at + k] == row[at])
            return np.flatnonzero(ok)

        found: dict[int, list] = {}
        for base_label, hashes in phrases.values():
            for at in places(hashes).tolist():
                found.setdefault(int(row[at]), []).append((at, base_label))
        method: dict[int, tuple[set, float]] = {}
        for label, auto in automata.items():
            for at in places(auto.head).tolist():
                r = int(row[at])
                accepted, share = auto.run(words[at : min(at + len(auto.words) + 1, first[r + 1])].tolist())
                labels, score = method.get(r, (set(), 0.0))
                method[r] = (labels | {label} if accepted else labels, max(score, share))
        counts = np.diff(first).tolist()
        for r in range(rows):
            hits = found.get(r, [])
            base = {x[1] for x in hits}
            labels, score = method.get(r, (set(), 0.0))
            at = [x[0] - int(first[r]) for x in hits]
            out.append((counts[r], len(hits), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    return out


FIELDS = {"n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"}
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def scan(docs: DataFrame, text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """docs with the columns of FIELDS: places of the base phrases, all labels, and the largest share of a template's wording.

    A null or empty text has no words, no labels (empty strings) and score 0. Columns of these names are replaced, all others stay.
    """
    ensure_importable(docs.sparkSession)

    @F.arrow_udf(f"struct<{','.join(f'{k}:{v}' for k, v in FIELDS.items())}>")
    def scanned(text: pa.Array) -> pa.Array:
        automata = {k: Automaton(v) for k, v in templates.items()}
        phrases = {k: (v, [T.hash_of(w.encode()) for w in k.split()]) for k, v in PHRASES.items()}
        columns = list(zip(*scan_texts(text, automata, phrases))) or [()] * len(FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(columns, FIELDS.values())], list(FIELDS))

    (own,) = free(docs, "_scanned")
    names = [F.col(f"`{c}`") for c in docs.columns if c not in FIELDS]
    return docs.withColumn(own, scanned(F.col(f"`{text_col}`"))).select(*names, f"{own}.*")
