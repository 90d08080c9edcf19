"""License scan by matching license templates.

A template is the wording of a license or notice with marked regions: words between ``<<optional>>``
and ``<<end>>`` may be missing, ``<<var:m-n>>`` stands for any m to n words. Templates are compiled into
one automaton over words. A place of a text is accepted for a template's label if the words from
there on spell out all mandatory wording, with only the marked regions left out or replaced.

Words are runs of digits, ASCII letters (A-Z lower-cased) and non-ASCII characters, so punctuation,
case and line breaks never decide. Null and empty texts have no words, labels or places. Each row is
scanned by itself, so repeated rows give repeated results; an empty table gives none; other columns of any
name are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachlens.llm.common import lower_words, utf8

#: Phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording by label, all of it fixed values. ``-text`` is a whole license, ``-header`` a whole file header,
#: ``-opening`` a license's grant alone, ``-notice`` a line that names a license.
TEMPLATES = {
    "0bsd-text": (
        "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted "
        "the software is provided as is and <<var:1-8>> disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall <<var:1-8>> be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
        "use or performance of this software",
    ),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use <<var:1-4>> except in compliance with "
        "the license you may obtain a copy of the license at <<var:1-1>> www apache org licenses license 2 0 "
        "<<optional>>txt<<end>> <<optional>>html<<end>> unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied see the license for the specific language governing permissions and limitations "
        "under the license",
    ),
    "apache-2.0-notice": (
        "licensed under the apache license <<optional>>version<<end>> 2 0",
        "apache license <<optional>>version<<end>> 2 0 january 2004",
        "spdx license identifier apache 2 0",
    ),
    "bsd-2-clause-text": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met "
        "<<optional>>1<<end>> redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer "
        "<<optional>>2<<end>> redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution "
        "this software is provided by <<var:1-12>> as is and any express or implied warranties including but not limited "
        "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
        "shall <<var:1-12>> be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in contract strict liability or "
        "tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
        "the possibility of such damage",
    ),
    "bsd-3-clause-text": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met "
        "<<optional>>1<<end>> redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer "
        "<<optional>>2<<end>> redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution "
        "<<optional>>3<<end>> neither the name of <<var:1-12>> nor the names of <<optional>>its<<end>> contributors may be "
        "used to endorse or promote products derived from this software without specific prior written permission "
        "this software is provided by <<var:1-12>> as is and any express or implied warranties including but not limited "
        "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event "
        "shall <<var:1-12>> be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or "
        "business interruption however caused and on any theory of liability whether in contract strict liability or "
        "tort including negligence or otherwise arising in any way out of the use of this software even if advised of "
        "the possibility of such damage",
    ),
    "bsd-notice": ("spdx license identifier bsd <<var:1-1>> clause",),
    "bsd-opening": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    "cc-by-notice": (
        "licensed under <<optional>>a<<end>> <<optional>>the<<end>> cc by <<var:1-1>> 0",
        "creative commons attribution <<var:1-1>> 0 <<optional>>international<<end>> license",
    ),
    "cc-by-nc-notice": (
        "licensed under <<optional>>a<<end>> <<optional>>the<<end>> cc by nc <<var:1-1>> 0",
        "creative commons attribution noncommercial <<var:1-1>> 0 <<optional>>international<<end>> license",
    ),
    "cc-by-sa-notice": (
        "licensed under <<optional>>a<<end>> <<optional>>the<<end>> cc by sa <<var:1-1>> 0",
        "creative commons attribution sharealike <<var:1-1>> 0 <<optional>>international<<end>> license",
    ),
    "gpl-2.0-header": (
        "this <<var:1-4>> is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 2 of the license or at your option "
        "any later version this <<var:1-4>> is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details",
    ),
    "gpl-2.0-notice": (
        "licensed under the gnu general public license version 2 <<optional>>0<<end>>",
        "under the terms of the gnu general public license as published by the free software foundation "
        "<<optional>>either<<end>> version 2",
        "spdx license identifier gpl 2 0 <<optional>>only<<end>>",
    ),
    "gpl-3.0-header": (
        "this <<var:1-4>> is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your option "
        "any later version this <<var:1-4>> is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details",
    ),
    "gpl-3.0-notice": (
        "licensed under the gnu general public license version 3 <<optional>>0<<end>>",
        "under the terms of the gnu general public license as published by the free software foundation "
        "<<optional>>either<<end>> version 3",
        "spdx license identifier gpl 3 0 <<optional>>only<<end>>",
    ),
    "isc-opening": (
        "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "isc-text": (
        "permission to use copy modify and <<optional>>or<<end>> distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and <<var:1-8>> disclaims all warranties with regard to this software including "
        "all implied warranties of merchantability and fitness in no event shall <<var:1-8>> be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the "
        "use or performance of this software",
    ),
    "mit-notice": (
        "released under the mit license",
        "licensed under the mit license",
        "spdx license identifier mit",
    ),
    "mit-opening": (
        "<<optional>>copyright <<optional>>c<<end>> <<var:1-8>><<end>> permission is hereby granted free of charge to "
        "any person obtaining a copy of this <<var:1-4>> and associated documentation files the <<var:1-4>> to deal "
        "in <<optional>>the<<end>> <<var:1-4>> without restriction including without limitation the rights to use "
        "copy modify merge publish distribute sublicense and or sell copies of the <<var:1-4>> and to permit persons "
        "to whom the <<var:1-4>> is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or "
        "substantial portions of the <<var:1-4>>",
    ),
    "mit-text": (
        "<<optional>>copyright <<optional>>c<<end>> <<var:1-8>><<end>> permission is hereby granted free of charge to "
        "any person obtaining a copy of this <<var:1-4>> and associated documentation files the <<var:1-4>> to deal "
        "in <<optional>>the<<end>> <<var:1-4>> without restriction including without limitation the rights to use "
        "copy modify merge publish distribute sublicense and or sell copies of the <<var:1-4>> and to permit persons "
        "to whom the <<var:1-4>> is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice <<optional>>including the next paragraph<<end>> shall be included in all copies or "
        "substantial portions of the <<var:1-4>> "
        "the <<var:1-4>> is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
        "<<var:1-8>> be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the <<var:1-4>> or the use or other dealings in the <<var:1-4>>",
    ),
    "mpl-2.0-notice": (
        "subject to the terms of the mozilla public license <<optional>>v<<end>> <<optional>>version<<end>> 2 0",
        "licensed under the mozilla public license <<optional>>version<<end>> 2 0",
        "spdx license identifier mpl 2 0",
    ),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event will <<var:1-6>> be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely subject "
        "to the following restrictions "
        "<<optional>>1<<end>> the origin of this software must not be misrepresented you must not claim that you wrote the "
        "original software if you use this software in a product an acknowledgment in the product documentation would "
        "be appreciated but is not required "
        "<<optional>>2<<end>> altered source versions must be plainly marked as such and must not be misrepresented as "
        "being the original software "
        "<<optional>>3<<end>> this notice may not be removed or altered from any source distribution",
    ),
}

#: Every accepted text holds one of these; texts without them are only counted.
ANCHORS = (b"licen", b"hereby", b"redistribut")

_MARK = re.compile(r"<<(optional|end|var:(\d+)-(\d+))>>")
_ANY = None


class TokenAutomaton:
    """All templates as one automaton, made deterministic as far as texts drive it.

    A state is a set of (template, position) items; ``step`` leads to the state after a word.
    """

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.edges: list[list[tuple[bytes | None, int]]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        first = [self._compile(wording, label) for label, wordings in templates.items() for wording in wordings]
        self.known = {word for edges in self.edges for word, _ in edges if word is not _ANY}
        self.states: dict[frozenset[int], int] = {}
        self.items: list[frozenset[int]] = []
        self.moves: dict[tuple[int, bytes | None], int] = {}
        self.labels: list[frozenset[str]] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closure(first))
        self.first_words = {word for i in self.items[self.start] for word, _ in self.edges[i]}

    def _node(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _compile(self, wording: str, label: str) -> int:
        """Chain of nodes for a template; free moves skip optional regions and surplus variable words."""
        at = begin = self._node()
        opened: list[int] = []
        place = 0
        for mark in [*_MARK.finditer(wording), None]:
            text = wording[place : mark.start() if mark else len(wording)]
            for word in lower_words(text.encode()):
                nxt = self._node()
                self.edges[at].append((word, nxt))
                at = nxt
            if mark is None:
                break
            place = mark.end()
            if mark[1] == "optional":
                opened.append(at)
            elif mark[1] == "end":
                self.free[opened.pop()].append(at)
            else:
                least, most = int(mark[2]), int(mark[3])
                skips = []
                for n in range(most):
                    if n >= least:
                        skips.append(at)
                    nxt = self._node()
                    self.edges[at].append((_ANY, nxt))
                    at = nxt
                for node in skips:
                    self.free[node].append(at)
        if opened:
            raise ValueError(f"optional region without end: {wording}")
        self.accepts[at] = label
        return begin

    def _closure(self, nodes) -> frozenset[int]:
        todo, seen = list(nodes), set()
        while todo:
            node = todo.pop()
            if node not in seen:
                seen.add(node)
                todo += self.free[node]
        return frozenset(seen)

    def _state(self, items: frozenset[int]) -> int:
        if items not in self.states:
            self.states[items] = len(self.items)
            self.items.append(items)
            self.labels.append(frozenset(self.accepts[i] for i in items if i in self.accepts))
        return self.states[items]

    def step(self, state: int, word: bytes) -> int:
        move = (state, word if word in self.known else _ANY)
        if move not in self.moves:
            reached = [to for i in self.items[state] for on, to in self.edges[i] if on is _ANY or on == word]
            self.moves[move] = self._state(self._closure(reached))
        return self.moves[move]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, str]]:
        """(start, end, label) of the longest accepted run per start and label."""
        found = []
        for start, word in enumerate(words):
            if word not in self.first_words and _ANY not in self.first_words:
                continue
            state, at, longest = self.start, start, {}
            while state != self.dead and at < len(words):
                state = self.step(state, words[at])
                at += 1
                for label in self.labels[state]:
                    longest[label] = at
            found += [(start, end, label) for label, end in longest.items()]
        return found


def phrase_places(words: list[bytes]) -> list[tuple[int, int, str]]:
    """(start, end, label) of every place of a base phrase."""
    found = []
    for phrase, label in PHRASES.items():
        wanted = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(wanted[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(wanted)] == wanted:
                found.append((at, at + len(wanted), label))
    return found


def scan(text: bytes | None, automaton: TokenAutomaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = lower_words(text)
    lowered = text.lower() if text else b""
    if not any(anchor in lowered for anchor in ANCHORS):
        return len(words), 0, None, None, "", "", 0.0
    base, own = phrase_places(words), automaton.matches(words)
    covered = np.zeros(len(words), bool)
    for start, end, _ in base + own:
        covered[start:end] = True
    starts = [start for start, _, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for *_, label in base})), ",".join(sorted({label for *_, label in base + own})),
        float(covered.mean()) if len(words) else 0.0,
    )


SCAN = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
)


def _scan_batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    automaton = TokenAutomaton(TEMPLATES)
    names = [part.split()[0] for part in SCAN.split(", ")]
    for batch in texts:
        rows = pd.DataFrame([scan(text, automaton) for text in batch], columns=names)
        yield rows.astype({"first_word": "Int64", "last_word": "Int64"})


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; ``score`` is the share of its words inside phrases and accepted templates."""
    found = F.pandas_udf(_scan_batches, SCAN)(utf8(text_col)).alias("found")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), found).select("doc_id", "found.*")
