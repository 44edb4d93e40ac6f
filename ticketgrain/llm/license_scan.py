"""License scans: template markup compiled to token automata, and fixed phrases.

A template is wording with optional regions ``[[ ... ]]`` and replaceable regions ``{n}`` (up to
n words of any kind).  It becomes an automaton over words: states between the words, edges for
a word, for any word, and empty ones around optional regions.  A text is accepted where all of
the mandatory wording stands in order and unbroken; matching starts anywhere and takes the whole
text into account.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ticketgrain.llm.common import id_and_text, map_texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The same words before lower-casing, for counting.
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Phrase and label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# SPDX license identifiers; their labels are the same in lower case.
SPDX = (
    "0BSD", "AFL-3.0", "AGPL-3.0", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
    "BSL-1.0", "CC0-1.0", "CC-BY-3.0", "CC-BY-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CDDL-1.0", "CDDL-1.1", "ECL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2",
    "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "LPPL-1.3c", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0",
    "MS-PL", "MS-RL", "NCSA", "ODbL-1.0", "OFL-1.1", "OSL-3.0", "PostgreSQL", "Python-2.0", "QPL-1.0", "Unlicense", "UPL-1.0",
    "Vim", "W3C", "WTFPL", "Zlib", "ZPL-2.1",
)
# Names of licenses with versions; {v} stands for one of the versions.
NAMED = (
    ("gpl", "gnu general public license [[as published by the free software foundation]] [[either]] {v}", ("1.0", "2.0", "3.0")),
    ("lgpl", "gnu lesser general public license [[as published by the free software foundation]] [[either]] {v}", ("2.1", "3.0")),
    ("lgpl", "gnu library general public license [[as published by the free software foundation]] [[either]] {v}", ("2.0",)),
    ("agpl", "gnu affero general public license [[as published by the free software foundation]] [[either]] {v}", ("3.0",)),
    ("apache", "apache license {v}", ("1.1", "2.0")),
    ("mpl", "mozilla public license {v}", ("1.1", "2.0")),
    ("epl", "eclipse public license {v}", ("1.0", "2.0")),
    ("eupl", "european union public [[license]] [[licence]] {v}", ("1.1", "1.2")),
    ("cddl", "common development and distribution license {v}", ("1.0", "1.1")),
    ("bsl", "boost software license {v}", ("1.0",)),
    ("artistic", "artistic license {v}", ("1.0", "2.0")),
    ("ofl", "sil open font license {v}", ("1.1",)),
    ("osl", "open software license {v}", ("2.1", "3.0")),
    ("afl", "academic free license {v}", ("2.1", "3.0")),
    ("zpl", "zope public license {v}", ("2.0", "2.1")),
    ("odbl", "open database license {v}", ("1.0",)),
    ("cc0", "cc0 {v} [[universal]]", ("1.0",)),
    ("cc0", "creative commons zero {v}", ("1.0",)),
)
# Parts of Creative Commons names, and their versions.
CC_WORDS = {"nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "noderivs", "no derivatives")}
CC_KINDS = ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd"))
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")


def spdx_templates() -> Iterator[tuple[str, str]]:
    for name in SPDX:
        yield name.lower(), f"spdx license identifier {' '.join(re.split('[-.]', name.lower()))}"


def version_wordings(version: str) -> list[str]:
    """How "2.0" is written: 2 0, version 2 0, v 2 0, v2 0, and without the zero after a word for version."""
    first, second = version.split(".")
    rest = "[[0]]" if second == "0" else second
    return [f"[[v]] {first} {second}", f"version {first} {rest}", f"v{first} {rest}"]


def named_templates() -> Iterator[tuple[str, str]]:
    for label, wording, versions in NAMED:
        for version in versions:
            for written in version_wordings(version):
                yield f"{label}-{version}", wording.replace("{v}", written)


def creative_commons_templates() -> Iterator[tuple[str, str]]:
    for kind, version in product(CC_KINDS, CC_VERSIONS):
        label, number = "-".join(("cc-by", *kind, version)), version.replace(".", " ")
        yield label, f"licensed under [[a]] [[the]] [[creative commons]] cc by {' '.join(kind)} {number}"
        for words in product(*(CC_WORDS[part] for part in kind)):
            yield label, f"creative commons attribution {' '.join(words)} {number}"


# Label and wording of usual notices and license texts.
TEMPLATES = (
    *spdx_templates(),
    *named_templates(),
    *creative_commons_templates(),
    ("bsd-2-clause", "bsd 2 clause [[simplified]] license"),
    ("bsd-2-clause", "simplified bsd license"),
    ("bsd-3-clause", "bsd 3 clause [[new]] [[or]] [[revised]] license"),
    ("bsd-4-clause", "bsd 4 clause [[original]] license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("isc", "[[licensed under the]] isc license"),
    ("zlib", "[[licensed under the]] zlib license"),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to"),
    (
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license the software to use reproduce display distribute execute and"
        " transmit the software",
    ),
    (
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter"
        " it and redistribute it freely subject to the following restrictions",
    ),
    (
        "0bsd",
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby"
        " granted the software is provided as is",
    ),
    (
        "postgresql",
        "permission to use copy modify and distribute this software and its documentation for any purpose without fee and"
        " without a written agreement is hereby granted",
    ),
    ("wtfpl", "do what the fuck you want to public license"),
    (
        "epl-2.0",
        "this program and the accompanying materials are made available under the terms of the eclipse public license"
        " [[v]] [[version]] 2 0",
    ),
    ("mit", "[[this {6} is]] released under the [[terms of the]] mit license"),
    ("mit", "[[this {6} is]] licensed under the [[terms of the]] mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the"
        " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
        " persons to whom the software is furnished to do so subject to the following conditions the above copyright"
        " notice and this permission notice [[including the next paragraph]] shall be included in all copies or"
        " substantial portions of the software",
    ),
    (
        "isc",
        "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met [[1]] redistributions of source code must retain the above copyright notice this"
        " list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above"
        " copyright notice this list of conditions and the following disclaimer in the documentation and or other"
        " materials provided with the distribution [[[[3]] neither the name of {12} nor the names of its contributors may"
        " be used to endorse or promote products derived from this software without specific prior written permission]]",
    ),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " [[http]] [[https]] [[www]] apache org licenses license 2 0",
    ),
    (
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the"
        " free software foundation either version {1} of the license or at your option any later version",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
ANY = None


@dataclass
class Automaton:
    """Edges by state; state 0 is the start, ``accept`` the end."""

    words: list[dict[str | None, list[int]]] = field(default_factory=lambda: [{}])
    empty: list[list[int]] = field(default_factory=lambda: [[]])
    accept: int = 0

    def state(self) -> int:
        self.words.append({})
        self.empty.append([])
        return len(self.words) - 1

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def step(self, states: frozenset[int], word: str) -> frozenset[int]:
        return self.closure({t for s in states for t in self.words[s].get(word, ()) + self.words[s].get(ANY, ())})

    def first_words(self) -> set[str | None]:
        return {w for s in self.closure({0}) for w in self.words[s]}


def compile_template(markup: str) -> Automaton:
    """``[[ x ]]`` optional (may nest), ``{n}`` up to n words, all else mandatory words."""
    automaton = Automaton()
    at, opened = 0, []
    for token in re.findall(r"\[\[|\]\]|\{[0-9]+\}|[^\s\[\]{}]+", markup):
        if token == "[[":
            opened.append(at)
        elif token == "]]":
            end = automaton.state()
            automaton.empty[at].append(end)
            automaton.empty[opened.pop()].append(end)
            at = end
        elif token[0] == "{":
            end = automaton.state()
            for _ in range(int(token[1:-1])):
                automaton.empty[at].append(end)
                following = automaton.state()
                automaton.words[at].setdefault(ANY, []).append(following)
                at = following
            automaton.empty[at].append(end)
            at = end
        else:
            following = automaton.state()
            automaton.words[at].setdefault(token, []).append(following)
            at = following
    if opened:
        raise ValueError("an optional region is not closed")
    for edges in automaton.words:  # tuples add quickly
        for word, targets in edges.items():
            edges[word] = tuple(targets)
    automaton.accept = at
    return automaton


def mandatory_words(markup: str) -> list[str]:
    """The words outside of optional regions."""
    depth, found = 0, []
    for token in re.findall(r"\[\[|\]\]|\{[0-9]+\}|[^\s\[\]{}]+", markup):
        depth += (token == "[[") - (token == "]]")
        if not depth and token[0] not in "[]{":
            found.append(token)
    return found


# A text holds nothing without one mandatory word ("licens..." or the longest) of some template or phrase.
# Wording of short words alone ("cc by") must stand whole, with any separators.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_MAY_HOLD = "(?i)" + "|".join(
    sorted(
        {
            rarest if len(rarest := max(words, key=lambda w: (w.startswith("licens"), len(w)))) > 4 else _GAP.join(words)
            for words in [p.split() for p in PHRASES] + [mandatory_words(markup) for _, markup in TEMPLATES]
        }
    )
)


class Matcher:
    """All templates at once; the state sets met so far are kept."""

    def __init__(self, templates=TEMPLATES):
        self.templates = [(label, compile_template(markup)) for label, markup in templates]
        self.starts: dict[str, list[int]] = {}
        for i, (_, automaton) in enumerate(self.templates):
            firsts = automaton.first_words()
            if ANY in firsts:
                raise ValueError("a template begins with a word of its own")
            for word in firsts:
                self.starts.setdefault(word, []).append(i)
        self.steps: dict[tuple, frozenset[int]] = {}

    def labels(self, words: list[str]) -> set[str]:
        found: set[str] = set()
        running: dict[int, frozenset[int]] = {}
        for word in words:
            if not running and word not in self.starts:
                continue
            following: dict[int, frozenset[int]] = {}
            for i in {*running, *self.starts.get(word, ())}:
                label, automaton = self.templates[i]
                states = running.get(i, frozenset()) | (automaton.closure({0}) if i in self.starts.get(word, ()) else frozenset())
                key = (i, states, word)
                if key not in self.steps:
                    if len(self.steps) > 50_000:
                        self.steps.clear()
                    self.steps[key] = automaton.step(states, word)
                if after := self.steps[key]:
                    following[i] = after
                    if automaton.accept in after:
                        found.add(label)
            running = following
        return found


def phrase_places(words: list[str]) -> list[tuple[int, str]]:
    """First word and label of every place of a phrase."""
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                places.append((at, label))
    return places


_MATCHERS: list[Matcher] = []


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``.

    doc_id, n_words, n_base (places of all phrases), first_word and last_word (their first and
    last place, null without any), base_labels and labels (distinct, sorted, comma-joined; the
    second with those of the templates), score: 1 if a template accepts, 0.5 with phrases only,
    else 0.  Null and empty texts have no words.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not _MATCHERS:
            _MATCHERS.append(Matcher())
        texts = batch.column("text")
        n_words = pc.cast(pc.count_substring_regex(texts, _WORD_ANY_CASE), pa.int64())
        n = len(texts)
        n_base, first, last, base_labels, labels, score = [0] * n, [None] * n, [None] * n, [""] * n, [""] * n, [0.0] * n
        for i in pc.indices_nonzero(pc.match_substring_regex(texts, _MAY_HOLD)).to_pylist():
            words = WORD.findall(texts[i].as_py().translate(_LOWER))
            places = phrase_places(words)
            accepted = _MATCHERS[0].labels(words)
            base = {label for _, label in places}
            n_base[i] = len(places)
            if places:
                first[i], last[i] = min(places)[0], max(places)[0]
            base_labels[i], labels[i] = ",".join(sorted(base)), ",".join(sorted(base | accepted))
            score[i] = 1.0 if accepted else 0.5 if base else 0.0
        columns = [
            batch.column("doc_id"), n_words, pa.array(n_base, pa.int64()), pa.array(first, pa.int64()),
            pa.array(last, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()),
        ]
        return pa.record_batch(columns, _COLUMNS)

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
    return map_texts(id_and_text(docs, id_col, text_col), run, schema)


_COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
