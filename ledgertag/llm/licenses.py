"""Licence texts in documents, by the Dice coefficient of word bigrams.

Texts and templates are reduced to lower-case words. A passage A and a template B with a and b
different bigrams, c in common, have the coefficient 2 c / (a + b). As c is at most a, a coefficient
of t needs c >= b t / (2 - t): a template of which a document has fewer bigrams is not compared.
For the others every passage that begins and ends with one of its bigrams counts. A passage has at
most b (2 - t) / t different bigrams, however many other words stand in it.

Licences of a family differ by a word or a number only, which weighs little in a long text. So a template
also names words that must be in a passage and words that mustn't, and of passages that overlap only the
best is reported.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, text_slices
from ledgertag.llm.words import LETTERS_DIGITS, Words

DICE = 0.8
# Words a passage must have, as often as they are listed, and words it mustn't have.
ToldApart = tuple[tuple[str, ...], frozenset[str]]

# Licence names and their words, without title and copyright line.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT notice": "Released under the MIT License.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone
is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met: 1. Redistributions of source code must
retain the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution. 3.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.""",
    "BSD disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA,
OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is granted
to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not
be misrepresented; you must not claim that you wrote the original software. If you use this software in
a product, an acknowledgment in the product documentation would be appreciated but is not required. 2.
Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy
of the software and accompanying documentation covered by this license (the "Software") to use,
reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of
the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
following: The copyright notices in the Software and this entire statement, including the above license
grant, this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works are
solely in the form of machine-executable object code generated by a source language processor.""",
    "CC0-1.0 notice": """To the extent possible under law, the author has waived all copyright and related or
neighboring rights to this work.""",
    "BSD notice": "Released under the BSD License.",
    "Apache-1.1 notice": "Licensed under the Apache License, Version 1.1.",
    "MPL-1.1 notice": "The contents of this file are subject to the Mozilla Public License Version 1.1.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "EPL-1.0 notice": "Licensed under the Eclipse Public License, Version 1.0.",
    "EPL-2.0 notice": "Licensed under the Eclipse Public License, Version 2.0.",
    "Proprietary notice": "All rights reserved.",
}
# The families that come in versions. Their texts differ in these words only.
GNU_NAMES = {"GPL": "General", "LGPL": "Lesser General", "AGPL": "Affero General"}
GNU_VERSIONS = {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}
GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU {name} Public License as published by the Free Software Foundation, either version {version} of the
License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU {name} Public License for more details."""
GNU_NOTICE = "This work is licensed under the GNU {name} Public License, version {version}."
CC_WORDS = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_VARIANTS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
CC_NOTICE = "This work is licensed under the Creative Commons {name} {version} {port} License."
CC_SHORT = "Licensed under CC {variant} {version}."


def _listed(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[0-9a-z]+", text.lower()))


def _words(text: str) -> frozenset[str]:
    return frozenset(_listed(text))


def _families() -> tuple[dict[str, str], dict[str, ToldApart]]:
    """Texts of all members, and for each name the words it needs and the words it excludes."""
    texts, told = {}, {}
    other_names = _words("Lesser Affero Library")
    for short, versions in GNU_VERSIONS.items():
        for version in versions:
            name = f"{short}-{version if '.' in version else version + '.0'}"
            values = {"name": GNU_NAMES[short], "version": version}
            for kind, form in ((name, GNU_HEADER), (f"{name} notice", GNU_NOTICE)):
                texts[kind] = form.format(**values)
                own = _words(GNU_NAMES[short]) & other_names
                told[kind] = (_listed(" ".join([version, *own])), other_names - own)
    parts = {short: _words(f"{short} {word}") for short, word in CC_WORDS.items()}
    for version, port in CC_VERSIONS.items():
        for variant in CC_VARIANTS:
            own = [short for short in CC_WORDS if short in variant.split("-")]
            name = "-".join(["Attribution", *(CC_WORDS[short] for short in own)])
            values = {"name": name, "variant": variant, "version": version, "port": port}
            excluded = frozenset().union(*(parts[short] for short in CC_WORDS if short not in own))
            for kind, form in (("notice", CC_NOTICE), ("short", CC_SHORT)):
                label = f"CC-{variant}-{version} {kind}"
                texts[label] = form.format(**values)
                wanted = [CC_WORDS[short] if kind == "notice" else short for short in own]
                told[label] = (_listed(" ".join([version, *wanted])), excluded)
    for name in ("Apache-2.0", "Apache-2.0 notice", "Apache-1.1 notice", "MPL-2.0", "MPL-1.1 notice",
                 "MPL-2.0 notice", "EPL-1.0 notice", "EPL-2.0 notice"):
        told[name] = (_listed(name.split()[0].split("-")[1]), frozenset())
    # The third condition is what the longer of the two has.
    told["BSD-3-Clause"] = (_listed("neither endorse"), frozenset())
    told["BSD-2-Clause"] = ((), _words("endorse"))
    return texts, told


FAMILIES, TOLD_APART = _families()
TEMPLATES |= FAMILIES


class Templates:
    """Bigram hashes of each template, and of all together; words that tell templates apart."""

    def __init__(self, texts: dict[str, str], told: dict[str, ToldApart]) -> None:
        words = Words(pa.array(list(texts.values()), pa.string()), LETTERS_DIGITS, lower=True)
        bigrams = words.sequences(words.hashes(), 2)
        self.names = list(texts)
        self.bigrams = [
            np.unique(bigrams[low : max(high - 1, low)])
            for low, high in zip(words.first[:-1], words.first[1:], strict=True)
        ]
        self.all = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.bigrams]))
        self.size = np.array([len(own) for own in self.bigrams], np.int64)
        self.has = np.stack([np.isin(self.all, own) for own in self.bigrams], axis=1) if self.bigrams else None
        apart = [told.get(name, ((), frozenset())) for name in self.names]
        self.needed = [np.unique(self._hashes(needed), return_counts=True) for needed, _ in apart]
        self.excluded = [self._hashes(excluded) for _, excluded in apart]

    @staticmethod
    def _hashes(words: Iterable[str]) -> np.ndarray:
        return Words(pa.array([" ".join(words)]), LETTERS_DIGITS, lower=True).hashes()

    def worth_a_look(self, bigrams: np.ndarray, dice: float) -> list[int]:
        """Templates that share enough with these bigrams, all of them known and different ones."""
        shared = self.has[np.searchsorted(self.all, bigrams)].sum(axis=0)
        enough = (self.size > 0) & (shared >= self.size * dice / (2 - dice) - 1e-9)
        return np.flatnonzero(enough).tolist()

    def allowed(self, k: int, words: np.ndarray) -> bool:
        """Whether a passage with these word hashes may be that template."""
        enough = all((words == word).sum() >= n for word, n in zip(*self.needed[k], strict=True))
        return enough and not np.isin(self.excluded[k], words).any()


class Text:
    """The bigrams of one text, with the places where each occurs before and after."""

    def __init__(self, bigrams: np.ndarray) -> None:
        self.bigrams = bigrams
        n = len(bigrams)
        order = np.argsort(bigrams, kind="stable")
        same = bigrams[order][1:] == bigrams[order][:-1]
        self.before, self.next = np.full(n, -1), np.full(n, n)
        self.before[order[1:][same]] = order[:-1][same]
        self.next[order[:-1][same]] = order[1:][same]


def _best_end(text: Text, hit: np.ndarray, low: int, high: int, count: int, dice: float) -> tuple[float, int]:
    """The best coefficient of a passage from ``low`` on that ends before ``high``, and its end.

    A passage whose first bigram comes again gains nothing by it, so it ends before that. It is looked at
    in growing parts until it has more different bigrams than any match can have.
    """
    high = min(high, int(text.next[low]))
    most, size = count * (2 - dice) / dice + 1e-9, 4 * count + 16
    while True:
        end = min(high, low + size)
        new = text.before[low:end] < low
        different = np.cumsum(new)
        if end == high or different[-1] > most:
            break
        size *= 4
    common = np.cumsum(new & hit[low:end])
    value = np.where(hit[low:end], 2 * common / (different + count), 0)
    at = int(value.argmax())
    return float(value[at]), low + at + 1


def passages(
    text: Text, template: np.ndarray, dice: float, allowed: Callable[[int, int], bool] = lambda a, b: True
) -> list[tuple[int, int, float]]:
    """Passages (first bigram, bigrams, coefficient) of one text, the best first, that don't overlap.

    Equal coefficients: the first in the text. ``allowed`` decides on a passage by its ends.
    """
    hit = np.isin(text.bigrams, template)
    count = len(template)
    waiting = []
    for low in np.flatnonzero(hit).tolist():
        value, high = _best_end(text, hit, low, len(hit), count, dice)
        if value >= dice - 1e-12:
            waiting.append((-value, low, high))
    heapq.heapify(waiting)
    chosen: list[tuple[int, int, float]] = []  # by place
    while waiting:
        value, low, high = heapq.heappop(waiting)
        after = bisect_left(chosen, (low + 1,))
        if after and chosen[after - 1][1] > low:
            continue  # begins inside of a better one
        if after < len(chosen) and chosen[after][0] < high:
            # Runs into a better one: the best that ends before it takes its place.
            value, high = _best_end(text, hit, low, chosen[after][0], count, dice)
            if value >= dice - 1e-12:
                heapq.heappush(waiting, (-value, low, high))
        elif allowed(low, high):
            chosen.insert(after, (low, high, -value))
    return [(low, high - low, value) for low, high, value in chosen]


def best_of_overlapping(found: list[dict]) -> list[dict]:
    """Of passages that share words only the one with the best coefficient (the longer, the first by name)."""
    order = sorted(found, key=lambda m: (-m["dice"], -m["n_words"], m["first_word"], m["license"]))
    kept: list[tuple[int, int, dict]] = []
    for match in order:
        low, high = match["first_word"], match["first_word"] + match["n_words"]
        place = bisect_left(kept, (low,))
        if (place and kept[place - 1][1] > low) or (place < len(kept) and kept[place][0] < high):
            continue
        kept.insert(place, (low, high, match))
    return [match for _, _, match in kept]


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    dice: float = DICE,
    told_apart: dict[str, ToldApart] | None = None,
) -> DataFrame:
    """Licence passages of each row: ``doc_id`` and ``matches``, an array of ``license``,
    ``first_word``, ``n_words`` and ``dice``, by place.

    Passages don't overlap. Of those that would, the best coefficient stays; of equal ones the longer
    passage, then the first in the text, then the first name. ``told_apart`` gives words (lower case)
    that a passage must have, and others that it mustn't, by template. Null, empty and word-free
    texts have none. Templates need two words. Equal rows get equal results, an empty table
    gives no rows, and other columns are left out.
    """
    if not 0 < dice <= 1:
        raise ValueError("the coefficient must be over 0 and at most 1")
    texts = TEMPLATES if templates is None else templates
    told = TOLD_APART if templates is None and told_apart is None else told_apart or {}
    match = T.StructType([
        T.StructField("license", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("dice", T.DoubleType()),
    ])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("matches", T.ArrayType(match))])
    arrow = pa.list_(
        pa.struct([
            ("license", pa.string()),
            ("first_word", pa.int64()),
            ("n_words", pa.int64()),
            ("dice", pa.float64()),
        ])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(texts, told)
        for batch in text_slices(batches, "text"):
            words = Words(column(batch, "text"), LETTERS_DIGITS, lower=True)
            hashes = words.hashes()
            bigrams = words.sequences(hashes, 2)
            common = np.flatnonzero(np.isin(bigrams, known.all) & words.whole(2))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            rows, begins = np.unique(words.row[common], return_index=True)
            for row, own in zip(rows.tolist(), np.split(common, begins[1:]), strict=False):
                low, high = words.first[row], words.first[row + 1] - 1
                text, matches = None, []
                for k in known.worth_a_look(np.unique(bigrams[own]), dice):
                    text = text or Text(bigrams[low:high])

                    def allowed(a: int, b: int, k: int = k, low: int = low) -> bool:
                        return known.allowed(k, hashes[low + a : low + b + 1])

                    for first, count, value in passages(text, known.bigrams[k], dice, allowed):
                        matches.append({
                            "license": known.names[k],
                            "first_word": first,
                            "n_words": count + 1,
                            "dice": value,
                        })
                found[row] = best_of_overlapping(matches)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(found, arrow)], names=schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def summary(found: DataFrame) -> DataFrame:
    """Per row: ``n_matches``, ``licenses`` (names, sorted), ``best_license`` and ``best_dice``."""
    best = F.array_max(
        F.transform("matches", lambda m: F.struct(m["dice"].alias("dice"), m["license"].alias("name")))
    )
    names = F.array_sort(F.array_distinct(F.col("matches.license")))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        best["name"].alias("best_license"),
        best["dice"].alias("best_dice"),
    )
