import itertools
import random
import re

import pytest

from breachlens.llm.common import lower_words
from breachlens.llm.licenses import ANCHORS, PHRASES, TEMPLATES, TokenAutomaton, scan, scan_licenses

MIT = (
    "Copyright (c) 2020 Some One\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software."
)


MIT_END = (
    "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
)
BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def pattern_of(wording):
    """The template as a regular expression over space-ended words: another way to the same language."""
    out = ""
    for part in re.split(r"(<<[^>]+>>)", wording):
        if part == "<<optional>>":
            out += "(?:"
        elif part == "<<end>>":
            out += ")?"
        elif part.startswith("<<var:"):
            least, most = part[6:-2].split("-")
            out += rf"(?:\S+ ){{{least},{most}}}"
        else:
            out += "".join(re.escape(w) + " " for w in part.split())
    return re.compile(out)


def slow_labels(words, templates):
    text = "".join(w.decode() + " " for w in words)
    starts = [m.start() for m in re.finditer(r"\S+ ", text)]
    return {label for label, ws in templates.items() for w in ws if any(pattern_of(w).match(text, s) for s in starts)}


def test_automaton_equals_regular_expressions():
    rng = random.Random(1)
    templates = {
        "x": ("a <<optional>>b <<optional>>c<<end>><<end>> d", "b <<var:0-2>> a"),
        "y": ("a b c", "<<optional>>a<<end>> <<var:1-3>> c d"),
        "z": ("<<optional>>d <<var:1-2>><<end>> a a",),
    }
    automaton = TokenAutomaton(templates)
    for _ in range(3000):
        words = [rng.choice([b"a", b"b", b"c", b"d", b"other"]) for _ in range(rng.randrange(9))]
        assert {label for *_, label in automaton.matches(words)} == slow_labels(words, templates), words


def _doubled(wording, words, i):
    """Whether the template still stands without word ``i``, by the regular expression."""
    text = "".join(w + " " for j, w in enumerate(words) if j != i)
    return any(pattern_of(wording).match(text, m.start()) for m in re.finditer(r"\S+ ", text))


@pytest.mark.parametrize("label", TEMPLATES)
def test_every_template_accepts_its_own_wording_and_needs_an_anchor(label):
    automaton = TokenAutomaton(TEMPLATES)
    for wording in TEMPLATES[label]:
        full = re.sub(r"<<(optional|end)>>", " ", re.sub(r"<<var:\d+-\d+>>", " filler ", wording))
        assert any(anchor.decode() in full for anchor in ANCHORS)
        assert label in scan(full.encode(), automaton)[5].split(",")
        words = full.split()
        mandatory, depth = [], 0
        for part in re.findall(r"<<[^>]+>>|[^<\s]+", wording):
            if part.startswith("<<"):
                depth += (part == "<<optional>>") - (part == "<<end>>")
                mandatory += [False] * (part.startswith("<<var"))
            else:
                mandatory.append(not depth)
        assert len(mandatory) == len(words)
        own = TokenAutomaton({label: (wording,)})
        edge = [i for i, m in enumerate(mandatory) if m]
        for i in edge:
            changed = [w.encode() for w in [*words[:i], "changed", *words[i + 1 :]]]
            assert not own.matches(changed), words[i]
            assert not own.matches([w.encode() for w in [*words[:i], *words[i + 1 :]]]) or _doubled(wording, words, i)


def test_license_texts():
    automaton = TokenAutomaton(TEMPLATES)
    labels = lambda text: scan(text.encode(), automaton)[5]
    assert labels(MIT) == "mit-opening"
    assert labels(MIT + MIT_END) == "mit-opening,mit-text"
    assert labels("x " * 50 + MIT + MIT_END + " y") == "mit-opening,mit-text"
    assert labels(MIT.replace("free of charge", "for a fee") + MIT_END) == ""
    assert labels(MIT + MIT_END.replace("WITHOUT WARRANTY", "WITH WARRANTY")) == "mit-opening"
    assert labels((MIT + MIT_END).replace("the Software", "THE WORK").replace("THE SOFTWARE", "the work")) == "mit-opening,mit-text"
    assert labels(BSD_OPENING) == "bsd-opening"
    assert labels(BSD_OPENING + BSD_TWO + BSD_END) == "bsd-2-clause-text,bsd-opening"
    assert labels(BSD_OPENING + BSD_TWO + BSD_THREE + BSD_END) == "bsd-3-clause-text,bsd-opening"
    assert labels(BSD_OPENING + BSD_TWO + BSD_THREE.replace("Neither", "Both") + BSD_END) == "bsd-opening"
    assert labels(BSD_OPENING + BSD_TWO + "4. Pay the author.\n" + BSD_END) == "bsd-opening"
    assert scan(b"Licensed under CC BY-NC 4.0.", automaton)[4:] == ("", "cc-by-nc-notice", 1.0)
    assert scan(b"Released under the MIT License.", automaton)[4:] == ("mit", "mit,mit-notice", 1.0)


def test_scan_equals_brute_force(docs):
    cases = [
        (1, None), (2, ""), (3, "MIT License mit license, MIT-LICENSE"), (4, "mit licenses mitlicense"), (4, "no words"),
        (5, "x " * 30000 + "general public license"), (6, "Apache\nLicense apache licence"), (7, MIT), (8, "mit mit license license"),
        (None, "general general public license"), (9, "é MIT License é"), (10, "***"),
    ]
    found = scan_licenses(docs(*cases).selectExpr("*", "1 AS labels", "2 AS found"))
    expected = []
    for i, text in cases:
        words = [w.decode() for w in lower_words((text or "").encode())]
        places = [
            (at, label)
            for (phrase, label), at in itertools.product(PHRASES.items(), range(len(words)))
            if words[at : at + len(phrase.split())] == phrase.split()
        ]
        starts = [at for at, _ in places]
        expected.append((i, len(words), len(places), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted({label for _, label in places}))))
    rows = [tuple(r) for r in found.collect()]
    assert sorted(map(repr, (r[:6] for r in rows))) == sorted(map(repr, expected))
    assert all(set(filter(None, r[5].split(","))) <= set(r[6].split(",")) and 0 <= r[7] <= 1 for r in rows)


def test_empty_table(docs):
    assert scan_licenses(docs((1, "x")).where("false")).count() == 0
