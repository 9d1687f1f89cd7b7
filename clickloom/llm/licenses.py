"""License scans: texts with template markup, compiled to token automata.

A template is wording with two marks: ``[[...]]`` holds words that may be left out, and
``{{n:m}}`` stands for n to m words of any kind (a name, a year). Its automaton reads the
words of a document (lower case, ASCII letters and digits and all characters beyond ASCII;
punctuation and line breaks don't count) and accepts from every place where all mandatory
words follow one another exactly. All templates run together: states are shared by their
first word, so a text is only walked from places where some template may begin.

Templates are whole licenses (``wordings``) and the notices by which texts refer to licenses.
A license whose terms were changed anywhere isn't accepted, as its mandatory words don't
follow. Where acceptances overlap, the longest counts, so that a license with another's name
in its own isn't taken for both. A notice behind a negation (``NEGATIONS``, up to ``REACH``
words before it) doesn't count.

Besides, base phrases label a text wherever their words stand consecutively.

The score is the share of a text's words that phrases or templates cover, or 1 if a whole
license is accepted.

Defined cases: a null or empty text has no words, no labels and a score of 0; a very long text
is read once, however long; rows with equal ids are scanned each on its own; other columns stay,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textbytes import ALNUM_WORD, LOWER, Words, slices, text_udf

#: Phrases and the labels they give.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_GPL_NOTICE = (
    "this program is free software [[:]] you can redistribute it and or modify it under the terms of the gnu {0}general public"
    " license as published by the free software foundation either version {1} of the license or at your option any later version"
    " this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty"
    " of merchantability or fitness for a particular purpose see the gnu {0}general public license for more details"
)


def _gnu(name: str, version: str) -> list[str]:
    by = "[[as published by the free software foundation either]] [[,]]"
    return [
        f"[[gnu]] {name}general public license {by} version {version}",
        f"[[gnu]] {name}general public license v{version}",
        _GPL_NOTICE.format(name, version),
    ]


#: Notices by which texts refer to licenses.
TEMPLATES = {
    "agpl-3.0": [*_gnu("affero ", "3"), "[[gnu]] agpl [[version]] 3", "[[gnu]] agplv3"],
    "apache-2.0": [
        "licensed under the apache license [[version]] 2.0",
        "licensed under the apache license version 2.0 [[the license]] you may not use this file except in"
        " compliance with the license you may obtain a copy of the license at {{1:8}} unless required by"
        " applicable law or agreed to in writing software distributed under the license is distributed on an"
        " as is basis without warranties or conditions of any kind either express or implied"
        " [[see the license for the specific language governing permissions and limitations under the license]]",
        "spdx license identifier apache 2.0",
    ],
    "bsd": ["[[released]] under the {{0:2}} bsd license"],
    "bsd-2-clause": ["spdx license identifier bsd 2 clause"],
    "bsd-3-clause": ["spdx license identifier bsd 3 clause"],
    "cc-by-4.0": ["licensed under [[a]] [[creative commons attribution]] cc by 4.0 [[international]] [[license]]"],
    "cc-by-nc-4.0": ["licensed under [[a]] [[creative commons]] cc by nc 4.0 [[international]] [[license]]"],
    "cc-by-sa-4.0": ["licensed under [[a]] [[creative commons]] cc by sa 4.0 [[international]] [[license]]"],
    "cc0-1.0": [
        "to the extent possible under law {{1:12}} waived all copyright and related or neighboring rights to",
        "[[licensed under]] [[the]] [[creative commons]] cc0 1.0 universal",
        "spdx license identifier cc0 1.0",
    ],
    "copyright": ["copyright [[c]] {{0:6}} all rights reserved"],
    "gpl-2.0": [*_gnu("", "2"), "[[gnu]] gplv2"],
    "gpl-3.0": [*_gnu("", "3"), "[[gnu]] gplv3"],
    "isc": ["[[released under]] [[licensed under]] the isc license", "spdx license identifier isc"],
    "lgpl-2.1": [*_gnu("lesser ", "2.1"), "[[gnu]] lgpl [[version]] 2.1"],
    "lgpl-3.0": [*_gnu("lesser ", "3"), "[[gnu]] lgplv3"],
    "mit": ["[[released under]] [[licensed under]] the mit license", "spdx license identifier mit"],
    "mpl-2.0": [
        "subject to the terms of the mozilla public license [[,]] v 2.0 [[if a copy of the mpl was not distributed with this file"
        " you can obtain one at]] [[http mozilla org mpl 2 0]] [[https mozilla org mpl 2 0]]",
        "[[licensed under]] the mozilla public license [[version]] 2.0",
        "spdx license identifier mpl 2.0",
    ],
}
#: Words that turn a notice behind them around.
NEGATIONS = frozenset("not never no isn aren wasn weren neither nor without cannot longer".split())
REACH = 3


@lru_cache(maxsize=1)
def whole_licenses() -> dict[str, list[str]]:
    """Templates of complete licenses, by label."""
    return {file.stem: [file.read_text(encoding="utf-8")] for file in sorted((Path(__file__).parent / "wordings").glob("*.txt"))}


SCANNED = (
    "struct<n_words: bigint, phrases: array<string>, phrase_at: array<int>, labels: array<string>, covered: bigint,"
    " score: double>"
)
_SCANNED = pa.struct(
    [
        ("n_words", pa.int64()),
        ("phrases", pa.list_(pa.string())),
        ("phrase_at", pa.list_(pa.int32())),
        ("labels", pa.list_(pa.string())),
        ("covered", pa.int64()),
        ("score", pa.float64()),
    ]
)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"\[\[(?P<optional>.*?)\]\]|\{\{(?P<least>\d+):(?P<most>\d+)\}\}", re.S)


class Automaton:
    """States 0..n of one template; ``moves[s]`` lists (word or None for any, next state), ``skips`` moves without a word."""

    def __init__(self, template: str):
        self.moves: list[list[tuple[str | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        self.mandatory: set[str] = set()
        at = done = 0
        for mark in _MARK.finditer(template):
            at = self._words(at, template[done : mark.start()])
            done = mark.end()
            if mark["optional"] is not None:
                end = self._words(at, mark["optional"], mandatory=False)
                self.skips[at].append(end)
                at = end
            else:
                for k in range(int(mark["most"])):
                    end = self._add(at, None)
                    if k >= int(mark["least"]):
                        self.skips[at].append(end)
                    at = end
        self.last = self._words(at, template[done:])
        if self.last in self._closed([0]):
            raise ValueError(f"template without mandatory words: {template!r}")

    def _add(self, at: int, word: str | None) -> int:
        self.moves.append([])
        self.skips.append([])
        self.moves[at].append((word, len(self.moves) - 1))
        return len(self.moves) - 1

    def _words(self, at: int, text: str, mandatory: bool = True) -> int:
        for word in _WORD.findall(text.lower()):
            at = self._add(at, word)
            if mandatory:
                self.mandatory.add(word)
        return at

    def _closed(self, states: list[int]) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo.extend(self.skips[s])
        return out

    def first_words(self) -> set[str | None]:
        return {word for s in self._closed([0]) for word, _ in self.moves[s]}

    def accept(self, words: list[str], start: int) -> int:
        """The end of the longest acceptance that begins at ``start``, or -1."""
        states, end = self._closed([0]), -1
        for at in range(start, len(words)):
            states = self._closed([n for s in states for word, n in self.moves[s] if word is None or word == words[at]])
            if not states:
                break
            if self.last in states:
                end = at + 1
        return end


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, list[str]], whole: dict[str, list[str]]):
        self.phrases = [(p.split(), label) for p, label in phrases.items()]
        self.automata = [(label, Automaton(t), full) for full, all_of in ((False, templates), (True, whole)) for label, ts in all_of.items() for t in ts]
        self.by_first: dict[str, list[tuple[str, Automaton, bool]]] = {}
        for label, automaton, full in self.automata:
            for word in automaton.first_words():
                if word is None:
                    raise ValueError(f"a template of {label} begins with any word")
                self.by_first.setdefault(word, []).append((label, automaton, full))
        self.starts = set(self.by_first) | {p[0] for p, _ in self.phrases}
        #: Words of which a text must hold one to match anything: the longest that each pattern cannot do without.
        needed = [set(p) for p, _ in self.phrases] + [a.mandatory for _, a, _ in self.automata]
        self.rare = sorted({max(words, key=lambda w: (len(w), w)).encode() for words in needed})

    def scan(self, words: list[str]) -> dict:
        phrases, places, accepted = [], [], []
        cover = np.zeros(len(words), bool)
        for at, word in enumerate(words):
            if word not in self.starts:
                continue
            for phrase, label in self.phrases:
                if words[at : at + len(phrase)] == phrase:
                    phrases.append(label)
                    places.append(at)
                    cover[at : at + len(phrase)] = True
            for label, automaton, full in self.by_first.get(word, ()):
                end = automaton.accept(words, at)
                if end > 0 and (full or not NEGATIONS.intersection(words[max(0, at - REACH) : at])):
                    accepted.append((at - end, at, end, label, full))
        kept = _longest(accepted, len(words))
        for _, at, end, _, _ in kept:
            cover[at:end] = True
        covered = int(cover.sum())
        return {
            "n_words": len(words),
            "phrases": phrases,
            "phrase_at": places,
            "labels": sorted({label for *_, label, _ in kept}),
            "covered": covered,
            "score": 1.0 if any(full for *_, full in kept) else covered / max(len(words), 1),
        }


def _longest(accepted: list[tuple], size: int) -> list[tuple]:
    """The longest acceptances, none of which meets a longer one; of equal ones over the same words all."""
    taken = np.zeros(size + 1, bool)
    kept: list[tuple] = []
    for own in sorted(accepted):
        _, at, end, _, _ = own
        if not taken[at:end].any() or (kept and kept[-1][1:3] == (at, end)):
            kept.append(own)
            taken[at:end] = True
    return kept


def _scanned(phrases: dict[str, str], templates: dict[str, list[str]], whole: dict[str, list[str]]) -> Callable:
    def make():
        scanner = Scanner(phrases, templates, whole)

        def scanned(texts: pa.Array) -> pa.Array:
            out = []
            for part in slices(texts):
                counts = Words(part, ALNUM_WORD, lower=True).counts.tolist()
                lower = LOWER[part.data].tobytes()
                for a, b, n in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist(), counts):
                    if any(lower.find(word, a, b) >= 0 for word in scanner.rare):
                        out.append(scanner.scan(_WORD.findall(lower[a:b].decode())))
                    else:
                        none = {"phrases": [], "phrase_at": [], "labels": [], "covered": 0, "score": 0.0}
                        out.append({"n_words": n, **none})
            return pa.array(out, _SCANNED)

        return scanned

    return make


def scanned(
    text: Column,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    whole: dict[str, list[str]] | None = None,
) -> Column:
    """What phrases and templates of notices and of whole licenses find in each text, as a column ``SCANNED``."""
    return text_udf(_scanned(phrases, templates, whole_licenses() if whole is None else whole), SCANNED)(text)


def license_scan(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    whole: dict[str, list[str]] | None = None,
) -> DataFrame:
    """One row per document: its id and all of ``SCANNED``."""
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.select("doc_id", scanned(F.col("text"), phrases, templates, whole).alias("s")).select("doc_id", "s.*")
