"""Find licence texts by matching statistics over a generalised suffix automaton of licence words.

The templates are numbers of words in one automaton. A text is streamed through it word by word, which
gives at each word the longest stretch ending there that some template holds as well, and by suffix links
the shorter ones that other templates, or other places, hold. Long stretches are chained: of each template, the
stretches in the same order in both that cover the most join to a span that says how much of it the text covers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakejobs.llm.shared import chunks, text_bytes
from lakejobs.llm.words import ALPHANUMERIC, hash_word, hashes, spans

# The base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences from the public licence texts, by label.
TEMPLATES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF
        OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
        TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
        SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY,
        OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
        USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
        DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not
        claim that you wrote the original software. If you use this software in a product, an acknowledgment in the
        product documentation would be appreciated but is not required. 2. Altered source versions must be plainly
        marked as such, and must not be misrepresented as being the original software. 3. This notice may not be
        removed or altered from any source distribution.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@dataclass
class SuffixAutomaton:
    """Of several sequences of numbers: every stretch of any of them is a path from state 0."""

    next: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _state(self, length: int, steps: dict[int, int], link: int) -> int:
        self.next.append(dict(steps))
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.next[q], self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, number: int, words: list[int]) -> None:
        """Insert a sequence; `ends` gets, for its prefixes' states, (`number`, the place of their last word)."""
        last = 0
        for at, word in enumerate(words):
            if (q := self.next[last].get(word)) is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                p, state = last, self._state(self.length[last] + 1, {}, 0)
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = state
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                last = state
            self.ends[last].add((number, at))

    def spread(self) -> None:
        """Hand each state's ends down to the states it is a suffix of; call once, after the last `add`."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state]:
                self.ends[self.link[state]] |= self.ends[state]

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state and the length of the longest stretch that ends here."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            step = self.next[state].get(word)
            state, length = (0, 0) if step is None else (step, length + 1)
            yield state, length


class Scanner:
    """Templates and base phrases in one automaton, ready to scan texts."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str], stretch: int, cover: float):
        self.stretch, self.cover = stretch, cover
        sequences = [words_of(x) for x in [*templates.values(), *phrases]]
        self.labels = [*templates, *phrases.values()]
        self.sizes = [len(x) for x in sequences]
        self.base_from = len(templates)
        vocabulary = sorted({word for x in sequences for word in x})
        codes = np.array([hash_word(word) for word in vocabulary], np.uint64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order
        number = {word: i for i, word in enumerate(vocabulary)}
        self.automaton = SuffixAutomaton()
        for i, x in enumerate(sequences):
            self.automaton.add(i, [number[word] for word in x])
        self.automaton.spread()
        # A phrase ends where its state is the current one or one of its suffixes.
        self.phrases: list[tuple[int, ...]] = [()] * len(self.automaton.next)
        home: dict[int, int] = {}
        for i in range(self.base_from, len(sequences)):
            for state, _ in self.automaton.statistics([number[word] for word in sequences[i]]):
                home[i] = state
        for state in sorted(range(1, len(self.phrases)), key=self.automaton.length.__getitem__):
            own = tuple(i for i, at in home.items() if at == state)
            self.phrases[state] = self.phrases[self.automaton.link[state]] + own

    def known(self, words: np.ndarray) -> np.ndarray:
        """The words' numbers; -1 for a word that no template has."""
        place = np.searchsorted(self.codes, words)
        place[place == len(self.codes)] = 0
        return np.where(self.codes[place] == words, self.ids[place], -1)

    def scan(self, numbers: np.ndarray) -> dict:
        """Base places, spans and coverage of one text's word numbers."""
        places: list[tuple[int, int]] = []
        stretches: dict[int, list[tuple[int, int, int]]] = {}
        runs = np.flatnonzero(numbers >= 0)
        for run in np.split(runs, np.flatnonzero(np.diff(runs) > 1) + 1) if len(runs) else []:
            if len(run) < 2:
                continue
            first = int(run[0])
            # By template and place against the text: where a stretch that goes on began.
            going: dict[tuple[int, int], int] = {}
            for i, (state, length) in enumerate(self.automaton.statistics(numbers[run].tolist()), first):
                for phrase in self.phrases[state]:
                    if length >= self.sizes[phrase]:
                        places.append((i - self.sizes[phrase] + 1, phrase))
                if going or length >= self.stretch:
                    now = self._ending(state, length, i)
                    self._close(going, now, i, stretches)
                    going = now
            self._close(going, {}, int(run[-1]) + 1, stretches)
        found = []
        for template, parts in stretches.items():
            found.extend(self._chains(template, sorted(parts)))
        return {"places": sorted(places), "spans": sorted(found)}

    def _ending(self, state: int, length: int, i: int) -> dict[tuple[int, int], int]:
        """The stretches that end with word i: by template and place (of the text's word 0), the first word."""
        now: dict[tuple[int, int], int] = {}
        while length >= self.stretch:
            for template, end in self.automaton.ends[state]:
                if template < self.base_from:
                    now.setdefault((template, end - i), i - length + 1)
            state = self.automaton.link[state]
            length = self.automaton.length[state]
        return now

    @staticmethod
    def _close(going: dict[tuple[int, int], int], now: dict[tuple[int, int], int], i: int, stretches: dict) -> None:
        for (template, shift), start in going.items():
            if (template, shift) not in now:
                stretches.setdefault(template, []).append((start, start + shift, i - start))

    def _chains(self, template: int, parts: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, float]]:
        """(start, end, template, covered share) of the chains of one template's stretches, the best one whole.

        In a chain, starts grow in text and template, a step leaps over at most the template's length of text, and
        words that two stretches share count once. Chains are taken by what they cover, the largest first;
        one that runs into a stretch already taken is cut there, and left out if less than `stretch` words remain.
        """
        size = self.sizes[template]
        covers, before = [length for _, _, length in parts], [-1] * len(parts)
        nearest = 0
        for k, (start, at, length) in enumerate(parts):
            # No stretch is longer than the template.
            while parts[nearest][0] < start - 2 * size:
                nearest += 1
            for j in range(nearest, k):
                start2, at2, length2 = parts[j]
                shared = max(0, start2 + length2 - start, at2 + length2 - at)
                if start2 < start and at2 < at and shared < length and start - start2 - length2 <= size:
                    if covers[j] + length - shared > covers[k]:
                        covers[k], before[k] = covers[j] + length - shared, j
        taken = [False] * len(parts)
        for last in sorted(range(len(parts)), key=lambda k: (-covers[k], parts[k])):
            k, head = last, -1
            while k >= 0 and not taken[k]:
                taken[k], head, k = True, k, before[k]
            covered = covers[last] - (covers[k] if k >= 0 else 0)
            if head >= 0 and (k < 0 or covered >= self.stretch):
                yield parts[head][0], parts[last][0] + parts[last][2], template, covered / size


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long,cover:double>>"
)


def scan_licenses(docs: DataFrame, stretch: int = 6, cover: float = 0.5) -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, score, and covered spans.

    A span joins stretches of at least `stretch` words of one template in the order they have there; its label
    counts when it covers a share of `cover` of the template. `score` is the largest share that any span covers, at most 1; 0
    without spans. `docs` needs `doc_id` and `text`; other columns are ignored. A null or wordless text has
    no labels, null places and score 0. Repeated rows give repeated results, a null `doc_id` stays null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(TEMPLATES, BASE_PHRASES, stretch, cover)
        labels = scanner.labels
        for batch in batches:
            for part in chunks(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                starts, ends, first = spans(data, offsets, ALPHANUMERIC)
                numbers = scanner.known(hashes(data, starts, ends))
                rows = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), first[:-1], first[1:], strict=True):
                    found = scanner.scan(numbers[a:b])
                    places, covered = found["places"], found["spans"]
                    base = {labels[phrase] for _, phrase in places}
                    more = {labels[t] for _, _, t, share in covered if share >= cover}
                    rows.append(
                        {
                            "doc_id": doc,
                            "n_words": int(b - a),
                            "n_base": len(places),
                            "first_word": places[0][0] if places else None,
                            "last_word": places[-1][0] if places else None,
                            "base_labels": ",".join(sorted(base)),
                            "labels": ",".join(sorted(base | more)),
                            "score": float(min(1.0, max((x[3] for x in covered), default=0.0))),
                            "spans": [{"label": labels[t], "start": s, "end": e, "cover": c} for s, e, t, c in covered],
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())])
_ARROW = pa.schema(
    [
        *((name, pa.int64()) for name in ("doc_id", "n_words", "n_base", "first_word", "last_word")),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(_SPAN)),
    ]
)
