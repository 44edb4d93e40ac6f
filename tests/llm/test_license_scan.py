import random
import re

import pytest

from tests.conftest import SF
from tests.llm import odd
from ticketgrain.llm import queries
from ticketgrain.llm.license_scan import PHRASES, TEMPLATES, Matcher, compile_template, scan_licenses

TEXTS = [
    "Released under the MIT License.",
    "This work is licensed under CC BY 4.0 and the Apache-License; mit\nLICENSE, cc cc-by by",
    'Licensed under the Apache License, Version 2.0 (the "License");',
    "GNU General Public License GNU GENERAL PUBLIC LICENSE, version 3",
    "This little program is licensed under the GNU General Public License, version 3.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "Permission to use, copy, modify, and distribute this old software for any purpose",
    "mıt license mit éLicense",
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if words[i : i + len(phrase.split())] == phrase.split()
    ]
    joined = " ".join([*words, ""])
    accepted = {label for label, expression in EXPRESSIONS if expression.search(joined)}
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | accepted)), 1.0 if accepted else 0.5 if base else 0.0,
    )


def spelled(markup):
    """The template as one regular expression over words with a blank after each, from the start of a word on."""
    out = "(?<![^ ])"
    for token in re.findall(r"\[\[|\]\]|\{[0-9]+\}|[^\s\[\]{}]+", markup):
        if token in ("[[", "]]"):
            out += "(?:" if token == "[[" else ")?"
        elif token[0] == "{":
            out += f"(?:[^ ]+ ){{0,{token[1:-1]}}}"
        else:
            out += re.escape(token) + " "
    return re.compile(out)


EXPRESSIONS = [(label, spelled(markup)) for label, markup in TEMPLATES]


def check(rows, found):
    assert odd.Counter(tuple(r) for r in found) == odd.Counter((i, *brute(t)) for i, t in rows)


def test_automaton_equals_expression():
    random.seed(6)
    for markup in ("a [[b {2}]] c", "a {3} b [[[[c]] d]]", "a [[a]] b", "a b [[{1} c]] a"):
        matcher = Matcher([("x", markup)])
        for _ in range(400):
            words = [random.choice("abcd") for _ in range(random.randint(0, 9))]
            wanted = any(spelled(markup).match(" ".join([*words[i:], ""])) for i in range(len(words)))
            assert bool(matcher.labels(words)) == wanted, (markup, words)
    with pytest.raises(ValueError):
        compile_template("a [[b")


def test_texts(spark):
    rows = odd.ROWS + list(enumerate(TEXTS, 100))
    found = {r.doc_id: r for r in scan_licenses(odd.table(spark, rows)).collect()}
    assert found[100].labels == "mit" and found[102].labels == "apache,apache-2.0" and found[104].labels == "gpl,gpl-3.0"
    assert found[105].labels == "isc" and found[105].n_base == 0 and found[106].labels == ""
    check(rows, scan_licenses(odd.table(spark, rows)).collect())
    assert scan_licenses(odd.empty(spark)).count() == 0


def test_whole_table(spark):
    found = queries.op7_license_scans(spark, SF).collect()
    check(odd.sf_texts(spark, SF), found)
    assert any(r.n_base for r in found)


def test_wrapped_and_creative_commons(spark):
    rows = [
        (1, "# This is free and unencumbered software released into the public\n# domain."),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "licensed under a Creative Commons CC BY-NC-SA 4.0 International License"),
        (4, "Licensed under CC BY 4.0"),
    ]
    found = scan_licenses(odd.table(spark, rows)).collect()
    assert {r.doc_id: (r.labels, r.score) for r in found} == {
        1: ("unlicense", 1.0), 2: ("cc-by,cc-by-nc-4.0", 1.0), 3: ("cc-by,cc-by-nc-sa-4.0", 1.0), 4: ("cc-by,cc-by-4.0", 1.0),
    }
    check(rows, found)


def test_catalogue(spark):
    """Names, SPDX lines and notices; plain prose about licenses has no label."""
    wanted = {
        "# SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa-4.0",
        "GNU Lesser General Public License v2.1": "lgpl,lgpl-2.1",
        "the GNU Affero General Public License, version 3": "agpl,agpl-3.0",
        "under the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of": "agpl,agpl-3.0",
        "CC0 1.0 Universal": "cc0-1.0",
        "Boost Software License - Version 1.0 - August 17th, 2003": "bsl-1.0",
        "the terms of the Eclipse Public License v. 2.0": "epl-2.0",
        "Eclipse Public License v2.0": "epl-2.0",
        'see the "BSD 3-Clause License"': "bsd-3-clause",
        "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0",
        "a Creative Commons Attribution 3.0 Unported License": "cc-by-3.0",
        "Creative Commons Attribution-Non Commercial-NoDerivs 2.5": "cc-by-nc-nd-2.5",
        "Licensed under CC BY 3.0": "cc-by,cc-by-3.0",
        "Licensed under the Apache License, Version 2.0": "apache,apache-2.0",
        "Mozilla Public License 2.0": "mpl-2.0",
        "SIL Open Font License, Version 1.1": "ofl-1.1",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it"
        " and redistribute it freely, subject to the following restrictions:": "zlib",
        "The city issued a general public license to 3 taverns; the lesser license, version 2, was for open carts.": "",
        "A license identifier on the plate, a boost of software sales and a creative commons room with attribution.": "",
        "Attribution-ShareAlike 4.0": "",
    }
    rows = list(enumerate(wanted))
    found = scan_licenses(odd.table(spark, rows)).collect()
    assert {rows[r.doc_id][1]: r.labels for r in found} == wanted
    check(rows, found)
    assert len({label for label, _ in TEMPLATES}) >= 60
