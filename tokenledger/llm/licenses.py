"""License scans by patience alignment.

Each license template is aligned with the places of a text that could hold it: words that
occur once in both are anchors, their longest increasing subsequence is kept, and the gaps
between anchors are aligned the same way (equal words at both ends of a gap count where it has
no anchor).  A place is a finding if the matched words cover at least ``coverage`` of the
template.  A text's places are stretches of ``stretch`` times the template's length that hold
enough of its words at all: an upper bound of the coverage, so no finding is passed over.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters.

Defined cases: null or empty texts have no finding; of findings that share words the one with
the larger coverage stays (then more words, then the first in the template list); repeated rows
give repeated findings; an empty table gives an empty result.  Only key and text are read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenledger.llm import tokens as tk
from tokenledger.llm.decontam import item_words
from tokenledger.llm.shared import per_block, sql_type

# Public license texts and notices.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2.",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-4": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
           "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
           "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
           "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
           "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
           "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
           "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
           "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
           "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
           "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
                "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                "governing permissions and limitations under the License.",
    "gpl-3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
             "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
             "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
}


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched (place in a, place in b), ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        pairs = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in place]
        if pairs:
            tails, ends, back = [], [], [-1] * len(pairs)   # longest increasing subsequence
            for n, (_, j) in enumerate(pairs):
                k = bisect_left(tails, j)
                tails[k: k + 1] = [j]
                ends[k: k + 1] = [n]
                back[n] = ends[k - 1] if k else -1
            n, run = ends[-1], []
            while n >= 0:
                run.append(pairs[n])
                n = back[n]
            run.reverse()
            out += run
            last = (a0 - 1, b0 - 1)
            for i, j in [*run, (a1, b1)]:
                todo.append((last[0] + 1, i, last[1] + 1, j))
                last = (i, j)
            continue
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, stretch: float):
        self.names = list(templates)
        w, first = item_words(pa.array([templates[x] for x in self.names], pa.string()))
        self.words = [w[first[i]: first[i + 1]].tolist() for i in range(len(self.names))]
        self.vocabulary = np.unique(w)
        self.among = np.zeros((len(self.vocabulary) + 1, len(self.names)), bool)
        for i in range(len(self.names)):
            self.among[np.searchsorted(self.vocabulary, w[first[i]: first[i + 1]]), i] = True
        self.needed = [math.ceil(coverage * len(x)) for x in self.words]
        self.span = [math.ceil(stretch * len(x)) for x in self.words]

    def findings(self, texts) -> list[tuple]:
        """(text, template, matched, start word, end word)."""
        w, first = item_words(texts)
        at = np.searchsorted(self.vocabulary, w)
        at[at == len(self.vocabulary)] = 0
        at = np.where(self.vocabulary[at] == w, at, len(self.vocabulary))
        known = at < len(self.vocabulary)
        out = []
        for t, (words, need, span) in enumerate(zip(self.words, self.needed, self.span)):
            hit = np.flatnonzero(known & self.among[at, t])
            if len(hit) < need:
                continue
            # a place: ``need`` hits in a row of one text, no more than a span apart from first to last
            a, b = hit[: len(hit) - need + 1], hit[need - 1:]
            doc = np.searchsorted(first, a, "right") - 1
            ok = (b - a < span) & (b < first[doc + 1])
            done: dict[int, int] = {}
            for p, d in zip(a[ok].tolist(), doc[ok].tolist()):
                if p < done.get(d, -1):
                    continue
                stop = min(p + span, int(first[d + 1]))
                m = patience(w[p:stop].tolist(), words)
                if len(m) >= need:
                    out.append((d, t, len(m), p + m[0][0] - int(first[d]), p + m[-1][0] + 1 - int(first[d])))
                    done[d] = p + m[-1][0] + 1
        best: dict[int, list[tuple]] = {}
        for f in sorted(out, key=lambda f: (-f[2] / len(self.words[f[1]]), -f[2], f[1], f[3])):
            own = best.setdefault(f[0], [])
            if all(f[4] <= g[3] or g[4] <= f[3] for g in own):
                own.append(f)
        return sorted(f for own in best.values() for f in own)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
                  coverage: float = 0.85, stretch: float = 1.25) -> DataFrame:
    """(key, license, coverage, n_matched, n_template, start_word, end_word): one row a finding."""
    s = Scanner(templates or TEMPLATES, coverage, stretch)

    def run(t: pa.Table) -> pa.Table | None:
        found = s.findings(t.column("t"))
        if not found:
            return None
        x = np.array(found, np.int64)
        size = np.array([len(w) for w in s.words])[x[:, 1]]
        return pa.table({"k": t.column("k").take(pa.array(x[:, 0])), "license": pa.array([s.names[i] for i in x[:, 1]]),
                         "coverage": x[:, 2] / size, "n_matched": x[:, 2], "n_template": size, "start_word": x[:, 3], "end_word": x[:, 4]})

    out = per_block(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), "t", run,
                    f"k {sql_type(docs, key)}, license string, coverage double, n_matched long, n_template long, start_word long, end_word long")
    return out.withColumnRenamed("k", key)
