"""License scan: templates with optional and replaceable regions as token automata.

A template is a license wording with markup: ``<<optional>> ... <</optional>>``
may be left out, ``<<any N>>`` stands for up to N words of free text, and
``{a|b c}`` for one of several wordings. It is compiled into an automaton
over words (A-Z lower-cased). A text is accepted where the automaton runs
from the template's first mandatory word to its last with every mandatory
word matched exactly; the longest accepted run counts.

The score of a text is the share of its words that lie in accepted
templates or in the fixed phrases.

Defined results: a null text is an empty one; repeated rows are scanned row by
row; an empty table gives an empty table. Texts are scanned whole.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame

from .common import DOUBLE, LONG, STRING, field, load_documents, map_columns

# The phrases, each with its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public license notices and texts, with markup for what may vary.
TEMPLATES = {
    "apache-2": [
        "licensed under the apache license version 2 0",
        """licensed under the apache license version 2 0 the license
        you may not use this {file|work|software} except in compliance with the license
        <<optional>>you may obtain a copy of the license at
        <<optional>>http<</optional>> <<optional>>https<</optional>> www apache org licenses license 2 0<</optional>>
        unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied
        see the license for the specific language governing permissions and limitations under the license""",
    ],
    "mit": [
        "{released|licensed|distributed|available} under the <<optional>>terms of the<</optional>> mit license",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to
        permit persons to whom the software is furnished to do so subject to the following conditions
        the above copyright notice and this permission notice <<optional>>including the next paragraph<</optional>>
        shall be included in all copies or substantial portions of the software
        <<optional>>the software is provided as is without warranty of any kind express or implied including but not
        limited to the warranties of merchantability fitness for a particular purpose and noninfringement
        in no event shall <<any 12>> be liable for any claim damages or other liability whether in an action of
        contract tort or otherwise arising from out of or in connection with the software or the use or other
        dealings in the software<</optional>>""",
    ],
    "bsd": [
        """redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met <<optional>>1<</optional>> redistributions of source code must retain the above copyright
        notice this list of conditions and the following disclaimer <<optional>>2<</optional>> redistributions in binary form must
        reproduce the above copyright notice this list of conditions and the following disclaimer in the
        documentation and or other materials provided with the distribution
        <<optional>><<optional>>3<</optional>> neither the name of <<any 12>> nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission<</optional>>""",
        "licensed under <<optional>>the<</optional>> bsd {2 clause|3 clause|style} license",
    ],
    "mpl-2": [
        """this source code form is subject to the terms of the mozilla public license {v 2 0|v2 0|version 2 0}
        <<optional>>if a copy of the mpl was not distributed with this file you can obtain one at
        <<optional>>{http|https}<</optional>> <<optional>>www<</optional>> mozilla org mpl 2 0<</optional>>""",
        "{licensed|released|distributed|available} under the <<optional>>terms of the<</optional>> mozilla public license "
        "{v 2 0|v2 0|version 2 0|2 0}",
        "mozilla public license version 2 0 <<optional>>1 definitions<</optional>>",
    ],
    "mpl-1.1": [
        """the contents of this file are subject to the mozilla public license version 1 1 <<optional>>the license<</optional>>
        you may not use this file except in compliance with the license""",
    ],
    "isc": [
        """permission to use copy modify {and or|and} distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies
        <<optional>>the software is provided as is and <<any 6>> disclaims all warranties with regard to this software
        including all implied warranties of merchantability and fitness<</optional>>""",
        "{licensed|released|distributed|available} under the <<optional>>terms of the<</optional>> isc license",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "zlib": [
        """this software is provided as is without any express or implied warranty in no event will the authors be held
        liable for any damages arising from the use of this software permission is granted to anyone to use this software
        for any purpose including commercial applications and to alter it and redistribute it freely""",
    ],
    "boost-1": [
        "{licensed|released|distributed|available} under the boost software license version 1 0",
        "boost software license version 1 0 <<optional>>august 17th 2003<</optional>>",
    ],
    "epl-2": [
        """made available under the terms of the eclipse public license {v 2 0|v2 0|version 2 0|2 0}
        <<optional>>which {is available|accompanies this distribution and is available} at<</optional>>""",
    ],
    "all-rights-reserved": ["all rights reserved"],
}

# Names, versions and title dates of the GNU licenses.
GNU = {
    "gpl-2": ("gnu general public license", "2", "june 1991"),
    "gpl-3": ("gnu general public license", "3", "29 june 2007"),
    "lgpl-2": ("gnu library general public license", "2", "june 1991"),
    "lgpl-2.1": ("gnu lesser general public license", "2 1", "february 1999"),
    "lgpl-3": ("gnu lesser general public license", "3", "29 june 2007"),
    "agpl-3": ("gnu affero general public license", "3", "19 november 2007"),
}

# Parts of the Creative Commons licenses, as written out and in short.
CREATIVE = {
    "cc-by": ("attribution", "by"),
    "cc-by-sa": ("attribution {sharealike|share alike}", "by sa"),
    "cc-by-nd": ("attribution {noderivatives|noderivs|no derivatives}", "by nd"),
    "cc-by-nc": ("attribution {noncommercial|non commercial}", "by nc"),
    "cc-by-nc-sa": ("attribution {noncommercial|non commercial} {sharealike|share alike}", "by nc sa"),
    "cc-by-nc-nd": ("attribution {noncommercial|non commercial} {noderivatives|noderivs|no derivatives}", "by nc nd"),
}

# Identifiers after "SPDX-License-Identifier:", as words.
SPDX = {
    "apache-2": "apache 2 0", "mit": "{mit|mit 0|x11}", "bsd": "{0bsd|bsd 2 clause|bsd 3 clause}", "isc": "isc",
    "mpl-1.1": "mpl 1 1", "mpl-2": "mpl 2 0", "epl-2": "epl 2 0", "boost-1": "bsl 1 0", "zlib": "zlib", "unlicense": "unlicense",
    "gpl-2": "gpl 2 0", "gpl-3": "gpl 3 0", "lgpl-2": "lgpl 2 0", "lgpl-2.1": "lgpl 2 1", "lgpl-3": "lgpl 3 0", "agpl-3": "agpl 3 0",
    "cc-by": "cc by {1 0|2 0|2 5|3 0|4 0}", "cc-by-sa": "cc by sa {1 0|2 0|2 5|3 0|4 0}", "cc-by-nc": "cc by nc {1 0|2 0|2 5|3 0|4 0}",
    "cc0": "cc0 1 0",
}


def _gnu(name: str, version: str, date: str) -> list[str]:
    number = version if " " in version else f"{version} <<optional>>0<</optional>>"
    number = f"{{version {number}|v {number}|v{number}}}"
    founded = "as published by the free software foundation"
    later = "<<optional>>of the license<</optional>> <<optional>>or at your option any later version<</optional>>"
    return [
        f"""you can redistribute it and or modify it under the terms of the {name}
        {{{founded} <<optional>>either<</optional>> {number}|{number} <<optional>>only<</optional>> {founded}}} {later}""",
        f"""{{licensed|released|distributed|available}} under the <<optional>>terms of the<</optional>> {name}
        <<optional>>{{gpl|lgpl|agpl|{founded}}}<</optional>> <<optional>>either<</optional>> {number} {later}""",
        f"{name} version {version} {date}",
    ]


def _creative(name: str, short: str) -> list[str]:
    versions = "{1 0|2 0|2 5|3 0|4 0}"
    ends = "<<optional>>{international|unported|generic}<</optional>> <<optional>>{license|licence}<</optional>>"
    return [
        f"""licensed under <<optional>>{{a|the}}<</optional>> {{cc {short}|creative commons {name}}}
        {{{versions}|<<optional>>international<</optional>> {{license|licence}}}} {ends}""",
        f"creativecommons org licenses {short} {versions}",
    ]


def _spdx(identifier: str) -> str:
    """The tag, other identifiers joined to it, then the one sought."""
    others = "<<optional>>{" + "|".join(SPDX.values()) + "} <<optional>>{only|or later}<</optional>> {or|and}<</optional>>"
    return f"spdx license identifier {others} {others} {identifier} <<optional>>{{only|or later}}<</optional>>"


def templates() -> dict[str, list[str]]:
    """All templates by label."""
    out = {label: list(texts) for label, texts in TEMPLATES.items()}
    for made in ({k: _gnu(*v) for k, v in GNU.items()}, {k: _creative(*v) for k, v in CREATIVE.items()},
                 {k: [_spdx(v)] for k, v in SPDX.items()}, {"cc0": ["creativecommons org publicdomain zero 1 0"]},
                 # short forms that the phrase for this label also stands for, without a version
                 {"cc-by-nc": ["licensed under <<optional>>{a|the}<</optional>> {cc by nc|creative commons attribution noncommercial|"
                               "creative commons attribution non commercial}"]}):
        for label, texts in made.items():
            out.setdefault(label, []).extend(texts)
    return out

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing, over UTF-8
MARKUP = re.compile(r"<<optional>>|<</optional>>|<<any \d+>>|[{}|]|[^\s{}|<]+")


class Automaton:
    """States over words; ``steps[s]`` maps a word to the next states, ``skips[s]`` are moves without a word."""

    def __init__(self, template: str):
        self.steps: list[dict[bytes, list[int]]] = [{}]
        self.skips: list[list[int]] = [[]]
        self.wild: list[list[int]] = [[]]
        self.tokens = MARKUP.findall(template)
        self.at = 0
        self.end = self._sequence(0, ())
        self.closure = [self._reach(s) for s in range(len(self.steps))]
        self.first = sorted({w for s in self.closure[0] for w in self.steps[s]})

    def _state(self) -> int:
        self.steps.append({})
        self.skips.append([])
        self.wild.append([])
        return len(self.steps) - 1

    def _word(self, state: int, word: str) -> int:
        new = self._state()
        self.steps[state].setdefault(word.encode(), []).append(new)
        return new

    def _sequence(self, state: int, until: tuple[str, ...]) -> int:
        while self.at < len(self.tokens) and self.tokens[self.at] not in until:
            token = self.tokens[self.at]
            self.at += 1
            if token == "<<optional>>":
                end = self._sequence(state, ("<</optional>>",))
                self.at += 1
                self.skips[state].append(end)
                state = end
            elif token == "{":
                ends = [self._sequence(state, ("|", "}"))]
                while self.tokens[self.at] == "|":
                    self.at += 1
                    ends.append(self._sequence(state, ("|", "}")))
                self.at += 1
                joined = self._state()
                for e in ends:
                    self.skips[e].append(joined)
                state = joined
            elif token.startswith("<<any"):
                for _ in range(int(token[6:-2])):
                    new = self._state()
                    self.wild[state].append(new)
                    self.skips[state].append(new)
                    state = new
            else:
                state = self._word(state, token)
        return state

    def _reach(self, state: int) -> frozenset[int]:
        seen, work = {state}, [state]
        while work:
            for s in self.skips[work.pop()]:
                if s not in seen:
                    seen.add(s)
                    work.append(s)
        return frozenset(seen)

    def run(self, words: list[bytes], start: int) -> int | None:
        """Word after the longest accepted run from ``start``; none if there is no such run."""
        states, best = self.closure[0], None
        for i in range(start, len(words)):
            nexts = {n for s in states for n in (*self.steps[s].get(words[i], ()), *self.wild[s])}
            if not nexts:
                return best
            states = frozenset().union(*[self.closure[n] for n in nexts])
            if self.end in states:
                best = i + 1
        return best


@functools.cache
def compiled() -> list[tuple[str, Automaton, bytes]]:
    """(label, automaton, rarest mandatory word) per template. A text without that word needs no run."""
    common = {"the", "of", "and", "to", "in", "a", "is", "this", "or", "for", "under", "by", "all", "be", "on", "with"}
    out = []
    for label, texts in templates().items():
        for text in texts:
            bare = text
            while "{" in bare:
                bare = re.sub(r"\{[^{}]*\}", " ", bare)
            while "<<optional>>" in bare:
                bare = re.sub(r"<<optional>>((?!<<optional>>).)*?<</optional>>", " ", bare, flags=re.S)
            must = [w for w in re.sub(r"<<any \d+>>", " ", bare).split() if w not in common]
            out.append((label, Automaton(text), max(must, key=len).encode()))
    return out


def _phrase_words() -> list[tuple[list[bytes], str]]:
    return [(p.encode().split(), label) for p, label in PHRASES.items()]


@functools.cache
def _sought() -> list[bytes]:
    """A few strings, one of which every phrase and template holds."""
    musts = sorted({m for _, _, m in compiled()} | {b"license"}, key=len)
    return [m for i, m in enumerate(musts) if not any(short in m for short in musts[:i])]


def may_match(low: bytes) -> bool:
    """Whether a text can hold a phrase or template: each has a mandatory word that is sought here."""
    return any(m in low for m in _sought()) or (b"cc" in low and b"by" in low and b"nc" in low)


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    low = (text or "").encode().lower()
    words = WORDS.findall(low)
    if not words or not may_match(low):
        return (len(words), 0, None, None, "", "", 0.0)
    places: dict[bytes, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    base, labels, spans = [], set(), []
    for phrase, label in _phrase_words():
        if not all(w in places for w in phrase):
            continue
        rare = min(range(len(phrase)), key=lambda k: len(places[phrase[k]]))
        for i in places[phrase[rare]]:
            start = i - rare
            if start >= 0 and words[start:start + len(phrase)] == phrase:
                base.append(start)
                labels.add(label)
                spans.append((start, start + len(phrase)))
    base_labels = ",".join(sorted(labels))
    for label, automaton, must in compiled():
        if must not in places:
            continue
        for start in sorted({i for w in automaton.first for i in places.get(w, ())}):
            end = automaton.run(words, start)
            if end is not None:
                labels.add(label)
                spans.append((start, end))
    covered, at = 0, 0
    for start, end in sorted(spans):
        covered += max(0, end - max(start, at))
        at = max(at, end)
    return (len(words), len(base), min(base, default=None), max(base, default=None), base_labels,
            ",".join(sorted(labels)), covered / len(words))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and the findings. One map over the texts, no shuffle."""
    def run(texts):
        rows = [scan(t) for t in texts]
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]

    made = [field(c, LONG) for c in ("n_words", "n_base", "first_word", "last_word")] + [
        field("base_labels", STRING), field("labels", STRING), field("score", DOUBLE)]
    return map_columns(docs, [text_col], made, run, [id_col])


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licenses of every document."""
    return scan_documents(load_documents(spark, sf_dir))
