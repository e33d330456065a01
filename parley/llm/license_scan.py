"""License scans: templates with optional and replaceable regions, compiled into token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import slices

#: (label, phrase): a place is where the phrase's words stand consecutively.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

#: Wording of well-known licenses and notices, as (label, template). ``[[ ]]`` encloses an optional region,
#: ``{{a-b}}`` stands for a to b words of any wording; all other words are mandatory and have to match exactly, in order.
#: Case and punctuation do not count.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under [[the terms of]] the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit-text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
     files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
     merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
     to do so, subject to the following conditions: The above copyright notice and this permission notice [[(including the next
     paragraph)]] shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
     WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
     PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL {{1-20}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
     CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
     that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND {{1-12}} DISCLAIMS
     ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{1-12}} BE
     LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
     PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
     PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-text", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
     conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of conditions and the
     following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
     the following disclaimer in the documentation and/or other materials provided with the distribution. [[[[3.]] Neither the name of
     {{1-20}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific
     prior written permission.]] THIS SOFTWARE IS PROVIDED BY {{1-20}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
     LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {{1-20}}
     BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
     PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
     THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
     THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("zlib-text", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
     damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
     commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: [[1.]] The origin of this
     software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product,
     an acknowledgment in the product documentation would be appreciated but is not required. [[2.]] Altered source versions must be
     plainly marked as such, and must not be misrepresented as being the original software. [[3.]] This notice may not be removed or
     altered from any source distribution."""),
    ("unlicense-text", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
     sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial,
     and by any means."""),
    ("apache", "licensed under the apache license [[version {{1-2}}]]"),
    ("apache-notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
     License. You may obtain a copy of the License at {{1-10}} Unless required by applicable law or agreed to in writing, software
     distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
     implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("gpl-notice", "licensed under the gnu [[lesser]] general public license [[as published by the free software foundation]] [[[[either]] version {{1-2}} [[of the license]] [[or at your option any later version]]]]"),
    ("gpl-notice", "under the terms of the gnu [[lesser]] general public license"),
    ("gpl-notice-text", """{{1-6}} is free software[[:]] you can redistribute it and/or modify it under the terms of the GNU [[Lesser]] [[Affero]] General Public
     License as published by the Free Software Foundation[[,]] either version {{1-2}} of the License, or (at your option) any later version.
     {{1-6}} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("mpl", "subject to the terms of the mozilla public license [[v {{1-2}}]]"),
    ("mpl-notice", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
     this file, You can obtain one at {{1-8}}"""),
    ("cc-by-nc", "licensed under [[a]] [[the]] cc by nc [[{{1-2}}]]"),
    ("cc-by-sa", "licensed under [[a]] [[the]] cc by sa [[{{1-2}}]]"),
    ("creative-commons", "licensed under [[a]] [[the]] creative commons [[{{1-6}}]] license"),
    ("copyright", "copyright [[c]] {{1-8}} all rights reserved"),
)

#: Least share of a template's mandatory words that counts as an incomplete match.
PARTIAL = 0.5

#: Word bytes are letters a-z, digits and all bytes of non-ASCII characters; the rest separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Automaton:
    """States 0..n-1 in template order. ``word[s]``: the literal a state takes (None: any word); ``after[s]``: the states
    that may follow; ``ends``: states after which the template is accepted; ``left[s]``: mandatory words up to s."""

    label: str
    word: tuple[bytes | None, ...]
    first: tuple[int, ...]
    after: tuple[tuple[int, ...], ...]
    ends: frozenset[int]
    left: tuple[int, ...]
    mandatory: int

    def leads(self) -> list[tuple[bytes, int]]:
        """(literal, words before it): where a match can be recognised by its first literal, behind any leading region."""
        out, states, depth = {}, set(self.first), 0
        while states:
            out |= {(self.word[s], depth): None for s in states if self.word[s] is not None}
            states = {n for s in states if self.word[s] is None for n in self.after[s]}
            depth += 1
        return list(out)

    def run(self, words: list[bytes], start: int) -> tuple[int, float]:
        """(end, share): the end of the longest accepted stretch from ``start`` (0 if none), and the greatest share of
        the mandatory words that matched on the way, 0 if that is less than ``PARTIAL``."""
        states, at, end, best = self.first, start, 0, 0
        while states and at < len(words):
            w = words[at]
            taken = [s for s in states if self.word[s] is None or self.word[s] == w]
            at += 1
            for s in taken:
                if s in self.ends:
                    end = at
                if self.left[s] > best and self.word[s] is not None:
                    best = self.left[s]
            states = taken and tuple(dict.fromkeys(n for s in taken for n in self.after[s]))
        if end or best < PARTIAL * self.mandatory:
            return end, float(end > 0)
        return 0, min(best / self.mandatory, 0.99)


def compile_template(label: str, template: str) -> Automaton:
    word: list[bytes | None] = []
    left: list[int] = []
    after: list[list[int]] = []
    mandatory = 0
    stack: list[list[int]] = []
    first: list[int] = []
    #: states (-1: the start) from which the next state can be reached
    open_ends = [-1]

    def add(w: bytes | None) -> None:
        nonlocal open_ends
        word.append(w)
        left.append(mandatory)
        after.append([])
        for s in open_ends:
            (first if s < 0 else after[s]).append(len(word) - 1)
        open_ends = [len(word) - 1]

    for token in re.findall(r"\[\[|\]\]|\{\{\d+-\d+\}\}|[a-z0-9]+", template.lower()):
        if token == "[[":
            stack.append(open_ends)
        elif token == "]]":
            open_ends = [*dict.fromkeys(open_ends + stack.pop())]
        elif token.startswith("{{"):
            low, high = map(int, token[2:-2].split("-"))
            ways: list[int] = []
            for k in range(high):
                if k >= low:
                    ways += open_ends
                add(None)
            open_ends = [*dict.fromkeys(ways + open_ends)]
        else:
            mandatory += not stack
            add(token.encode())
    return Automaton(label, tuple(word), tuple(first), tuple(map(tuple, after)), frozenset(s for s in open_ends if s >= 0), tuple(left), mandatory)


class LicenseScanner:
    def __init__(self, base=BASE, templates=TEMPLATES):
        self.base = [compile_template(label, phrase) for label, phrase in base]
        self.starts: dict[bytes, list[tuple[bool, Automaton, int]]] = {}
        for is_base, automata in ((True, self.base), (False, [compile_template(*t) for t in templates])):
            for a in automata:
                for word, before in a.leads():
                    self.starts.setdefault(word, []).append((is_base, a, before))

    def scan(self, text: str | None) -> dict:
        """n_words; spans (label, start, end, base) of accepted places, in words; score: 1 if there is one, else the greatest
        share, from ``PARTIAL`` on, of a template's mandatory words that stand in the text from its beginning on."""
        words = words_of(text)
        spans, score = [], 0.0
        for w in self.starts.keys() & set(words):
            at = -1
            while True:
                try:
                    at = words.index(w, at + 1)
                except ValueError:
                    break
                for is_base, a, before in self.starts[w]:
                    end, share = a.run(words, at - before) if at >= before else (0, 0.0)
                    # of a base phrase a part is nothing
                    score = max(score, share if end or not is_base else 0.0)
                    if end:
                        spans.append((a.label, at - before, end, is_base))
        spans = sorted(set(spans), key=lambda s: (s[1], s[2], s[0]))
        return {"n_words": len(words), "spans": spans, "score": score}


@lru_cache(maxsize=2)
def scanner() -> LicenseScanner:
    return LicenseScanner()


SCAN = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))), ("score", pa.float64())])


def license_scan(text: Column) -> Column:
    """struct<n_words, spans array<struct<label, start, stop, base>>, score> of each whole text."""

    @F.arrow_udf("n_words long, spans array<struct<label: string, start: long, stop: long, base: boolean>>, score double")
    def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner()
        for part in parts:
            rows = [s.scan(t) for texts in slices(part) for t in texts]
            for r in rows:
                r["spans"] = [dict(zip(("label", "start", "stop", "base"), x)) for x in r["spans"]]
            yield pa.array(rows, SCAN)

    return scan(text)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_words, n_base (places of base phrases), first_word and last_word (the least and greatest
    start of those, else null), base_labels, labels (distinct, sorted, comma-joined; empty string if none), score.

    Null and empty texts have no words and no labels; repeated rows give repeated results; other columns are not looked
    at; an empty table gives an empty result. A narrow map: no shuffle.
    """
    base = F.filter("scan.spans", lambda s: s.base)
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    start = F.transform(base, lambda s: s.start)
    return docs.select(F.col(id_col).alias("doc_id"), license_scan(F.col(text_col)).alias("scan")).select(
        "doc_id", "scan.n_words", F.size(base).cast("long").alias("n_base"), F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("scan.spans")).alias("labels"), "scan.score",
    )
