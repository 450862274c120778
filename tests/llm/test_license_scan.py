import random

from cases import SMALL, none, odd, table
from inkwell.llm import license_scan as scan
from inkwell.llm.queries import QUERIES


def test_statistics_against_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        sequences = [[rnd.randint(0, 3) for _ in range(rnd.randint(0, 12))] for _ in range(3)]
        automaton = scan.SuffixAutomaton(sequences)
        text = [rnd.randint(0, 4) for _ in range(20)]
        inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for end, (state, length) in enumerate(automaton.statistics(text)):
            assert length == max(k for k in range(end + 2) if not k or tuple(text[end + 1 - k:end + 1]) in inside)
            if length:
                stretch = text[end + 1 - length:end + 1]
                assert automaton.last[state] == {
                    (i, j) for i, s in enumerate(sequences) for j in range(length - 1, len(s)) if s[j - length + 1:j + 1] == stretch}


def test_spans_of_whole_and_altered_templates():
    own = scan.scanner()
    for name, template in scan.TEMPLATES.items():
        words = scan.tokens(f"zzz yyy {template} xxx")
        assert (name, 2, len(words) - 1, 1.0) in own.scan(words)[1]
    altered = scan.tokens(scan.TEMPLATES["mit"].replace("furnished", "given").replace("merge, ", ""))
    (found,) = [s for s in own.scan(altered)[1] if s[0] == "mit"]
    assert found[1:3] == (0, len(altered)) and 0.9 < found[3] < 1
    assert own.scan(scan.tokens("the software is provided to the work of the license and more"))[1] == []


def test_query_against_plain_python(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_licenses"](spark, SMALL).collect()}
    for row in table("documents"):
        words = [w.decode() for w in scan.tokens(row["text"])]
        places = [(i, label) for phrase, label in scan.PHRASES.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[row["doc_id"]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_odd_rows_and_none(spark):
    rows = scan.scan(odd(spark, "phrases", "spans", "n_words")).collect()
    sizes = sorted((r["doc_id"] or -1, r["n_words"]) for r in rows)
    assert sizes == [(-1, 3), (1, 0), (2, 0), (3, 0), (4, 4), (4, 4), (5, 4), (6, 40_001), (7, 2)]
    assert scan.scan(none(spark)).count() == 0


NOTICES = {
    "Licensed under CC BY 4.0": "cc-by-4.0", "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0", "Licensed under CC BY-NC-ND 3.0": "cc-by-nc-nd-3.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa-4.0",
    "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
    "This work is licensed under the GNU Lesser General Public License, version 2.1.": "lgpl-2.1",
    "This work is licensed under the GNU Affero General Public License, version 3.": "agpl-3.0",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl-2.0",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
    "License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.": "lgpl-2.1",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free "
    "Software Foundation.": "gpl-2.0",
    scan.TEMPLATES["bsd-2-clause"] + " THIS SOFTWARE IS PROVIDED BY THE AUTHOR AS IS": "bsd-2-clause",
    scan.TEMPLATES["bsd-2-clause"] + " Neither the name of the University nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.": "bsd-3-clause",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: MIT": "mit-spdx", "SPDX-License-Identifier: MIT-0": "mit-0",
    "// SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "SPDX-License-Identifier: CC-BY-NC-4.0": "cc-by-nc-4.0",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause", "SPDX-License-Identifier: Custom": None,
    "Licensed under CC BY 9.0": None, "This work is licensed under the GNU General Public License, version 9.": None,
}


def test_notices_beside_those_of_the_tables_get_their_own_label_only():
    own = scan.scanner()
    for text, licence in NOTICES.items():
        labels = {name for name, *_ in own.scan(scan.tokens(f"Some words before. {text} Some words after."))[1]}
        assert bool(labels) == (licence is not None) and all(label.startswith(licence) for label in labels), (text, labels)


def test_every_template_has_the_labels_of_its_own_licence_only():
    def licence(name):
        for end in ("-notice", "-line", "-short", "-only", "-spdx"):
            name = name.removesuffix(end)
        return name

    own = scan.scanner()
    for name, template in scan.TEMPLATES.items():
        assert {licence(label) for label, *_ in own.scan(scan.tokens(template))[1]} == {licence(name)}, name


def test_labels_are_licences(spark):
    rows = QUERIES["op8_licenses"](spark, SMALL).collect()
    found = {label for r in rows for label in r["labels"].split(",") if label}
    assert found and found <= {scan.licence_of(n) for n in scan.TEMPLATES} | set(scan.PHRASES.values())
    assert any(scan.licence_of(t) != t for r in rows for t in r["templates"].split(","))
