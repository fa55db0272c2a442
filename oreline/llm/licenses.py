"""Licence scan: normalised text compared with licence templates by the Dice coefficient of word bigrams.

A template's bigrams are looked up in the text; windows are formed only where they can reach the threshold: with b distinct template
bigrams a window of w distinct bigrams needs at least t (w + b) / 2 common ones, so w lies between t b / (2 - t) and (2 - t) b / t.
From every hit, all windows up to that many distinct bigrams are compared, so inserted words and left-out ones are found alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import OrderedDict
from heapq import heapify, heappop, heapreplace

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .columns import field, pick

THRESHOLD = 0.9

# fixed values: notices and texts of public licences
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN
NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("LGPL-3.0", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
prior written permission."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    ("CC0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
    ("CC0-1.0", "This work is marked with CC0 1.0 Universal."),
    ("CC0-1.0", "http://creativecommons.org/publicdomain/zero/1.0/"),
]
_TERMS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version, _reach in (("4.0", "International"), ("3.0", "Unported")):
        _long = f"{'-'.join(_TERMS[t] for t in _kind.split('-'))} {_version} {_reach}"
        TEMPLATES += [(f"CC-{_kind}-{_version}", _text) for _text in (
            f"Licensed under CC {_kind} {_version}.", f"This work is licensed under a Creative Commons {_long} License.",
            f"Creative Commons {_long} License", f"{_long} (CC {_kind} {_version})", f"http://creativecommons.org/licenses/{_kind.lower()}/{_version}/")]

_WORD = re.compile(r"[a-z0-9]+")
_SPELLING = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "https": "http"}


def normalised(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) with one spelling of license, lower case, no punctuation; places are those of the text itself."""
    lower = text.lower()
    if len(lower) != len(text):  # some capitals become two characters: they are left as they are, to keep places
        lower = "".join([c.lower() if len(c.lower()) == 1 else c for c in text])
    return [(_SPELLING.get(w := m.group(), w), *m.span()) for m in _WORD.finditer(lower)]


class Scanner:
    """Templates by bigram, and the bounds each of them sets."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        self.threshold = threshold
        self.names, self.sets, self.by_bigram = [], [], {}
        for name, text in templates:
            words = [w for w, _, _ in normalised(text)]
            bigrams = set(zip(words, words[1:]))
            if bigrams:
                for b in bigrams:
                    self.by_bigram.setdefault(b, []).append(len(self.names))
                self.names.append((name, len(words) - 1))
                self.sets.append(bigrams)

    def find(self, text: str) -> list[tuple[str, int, int, float]]:
        """(name, start, end, dice), in order, without overlap: of overlapping matches of one template the better one wins, of
        those of several templates the one that holds more bigrams of its own."""
        words = normalised(text)
        plain = [w for w, _, _ in words]
        bigrams = list(zip(plain, plain[1:]))
        hits: dict[int, set] = {}
        for g in set(bigrams) & self.by_bigram.keys():
            for t in self.by_bigram[g]:
                hits.setdefault(t, set()).add(g)
        found, heads = [], []
        for t, common in hits.items():
            # common bigrams that the smallest window needs
            if len(common) >= self.threshold / (2 - self.threshold) * len(self.sets[t]) - 1e-9:
                if own := self.windows(bigrams, self.sets[t], self.names[t][1]):
                    # best of the template last; its turn comes by how many common bigrams it has
                    found.append((self.names[t][0], sorted(own, key=lambda f: (f[1], -f[2]))))
        for at, (name, own) in enumerate(found):
            heads.append((-own[-1][0], -own[-1][1], own[-1][2], name, at))
        heapify(heads)
        kept: list[tuple[int, int, str, float]] = []
        taken: list[tuple[int, int]] = []
        while heads:
            *_, name, of = heads[0]
            own = found[of][1]
            _, dice, start, end = own.pop()
            if own:
                heapreplace(heads, (-own[-1][0], -own[-1][1], own[-1][2], name, of))
            else:
                heappop(heads)
            at = bisect_left(taken, (start, 0))
            if (at < len(taken) and taken[at][0] <= end) or (at and taken[at - 1][1] >= start):
                continue
            taken.insert(at, (start, end))
            kept.append((start, end, name, dice))
        return [(name, words[a][1], words[b][2], dice) for a, b, name, dice in sorted(kept)]

    def windows(self, bigrams: list, template: set, length: int) -> list[tuple[int, float, int, int]]:
        """(common bigrams, dice, start, end) of the best window from every hit, where it reaches the threshold. It ends with the bigrams that
        only repeat its own, as far as the template's length."""
        least = self.threshold / (2 - self.threshold) * len(template) - 1e-9
        most = int((2 - self.threshold) / self.threshold * len(template) + 1e-9)
        ahead: OrderedDict = OrderedDict()  # the next distinct bigrams and their first places, the nearest one last
        near, out = 0, []
        for start in range(len(bigrams) - 1, -1, -1):
            own = bigrams[start]
            near += own in template and own not in ahead
            ahead[own] = start
            ahead.move_to_end(own)
            if len(ahead) > most:
                near -= ahead.popitem(last=False)[0] in template
            if near < least or own not in template:
                continue
            common, best = 0, (0.0, 0, 0)
            for size, (g, place) in enumerate(reversed(ahead.items()), 1):
                if g in template:
                    common += 1
                    if (dice := 2 * common / (size + len(template))) > best[0]:
                        best = (dice, common, place + 1)
                    if common == near:
                        break
            if best[0] >= self.threshold:
                end, own = best[2], None
                while end < min(start + length, len(bigrams)) and bigrams[end] in template:
                    own = own or set(bigrams[start:end])
                    if bigrams[end] not in own:
                        break
                    end += 1
                out.append((best[1], best[0], start, end))
        return out

    @staticmethod
    def dice(window: list, template: set) -> float:
        own = set(window)
        return 2 * len(own & template) / (len(own) + len(template))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, licenses) per row: array of (name, start, end, dice) in code points.

    Whole texts are scanned in place, without a shuffle; templates are a fixed list, so what every task holds does not grow. Null and
    empty texts have no licences; repeated rows and null ids stay as they are; ties between templates go to the first name.
    """
    rows = pick(docs, **{id_col: id_col, "text_": text_col}).withColumn("text_", F.coalesce(F.col("text_").cast("string"), F.lit("")))
    chosen = TEMPLATES if templates is None else templates
    kind = pa.list_(pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("dice", pa.float64())]))

    def scanned(batches):
        scanner = Scanner(chosen, threshold)
        for batch in batches:
            out = [[dict(zip(("name", "start", "end", "dice"), f)) for f in scanner.find(text.as_py())] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=[id_col, "licenses"])

    item = T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("dice", T.DoubleType())])
    return rows.mapInArrow(scanned, T.StructType([field(rows, id_col), T.StructField("licenses", T.ArrayType(item))]))
