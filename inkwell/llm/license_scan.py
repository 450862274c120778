"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds all token sequences that stand in some template. Streaming a text through it gives at each word the
longest stretch up to there that a template contains (matching statistics). Long stretches become matches, matches of
one template that follow each other in text and template are chained, and chains that cover enough are its spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import map_arrow, read

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices of public licences, as their authors ask to write them or as they begin.
TEMPLATES = {
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    "cc-by-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
    "this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means.",
}

CC_TERMS = {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivs", "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivs",
}
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
GNU = {
    "gpl-1.0": ("", "1"), "gpl-2.0": ("", "2"), "gpl-3.0": ("", "3"), "lgpl-2.0": ("Library", "2"), "lgpl-2.1": ("Lesser", "2.1"),
    "lgpl-3.0": ("Lesser", "3"), "agpl-3.0": ("Affero", "3"),
}

# Words that tell a licence from its relatives: each must stand where the template's words are found, "|" between ways
# to say it; and words that must not.
MARKS: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("apache license", "version 2|v2|license 2"), "apache-2.0-notice": ("apache license", "version 2|v2|license 2"),
    "bsd-3-clause": ("neither the name",), "isc": ("provided that",), "mit": ("above copyright notice",), "mit-notice": ("mit",),
    "mpl-2.0": ("mozilla public license", "v 2 0|version 2 0|v2 0|mpl 2 0"),
}
MARKS_AGAINST: dict[str, tuple[str, ...]] = {
    "bsd-2-clause": ("neither the name", "names of its contributors", "all advertising materials"),
    "bsd-3-clause": ("all advertising materials",),
}
AFTER = 48  # words after a span in which words that must not stand there are looked for


VARIANTS = re.compile("-(notice|line|short|only|spdx)$")


def licence_of(template: str) -> str:
    """The licence that a template's name stands for; several texts of one licence have names with an ending."""
    return VARIANTS.sub("", template)


def _add(name: str, template: str, marks: tuple[str, ...], against: tuple[str, ...] = ()) -> None:
    """A template under ``name``, or beside the one that has the name; one that is there already only gets the marks."""
    own = next((n for n, t in TEMPLATES.items() if tokens(t) == tokens(template)), None)
    if own is None:
        own = next(n for n in (name, f"{name}-notice", f"{name}-line", f"{name}-short", f"{name}-only") if n not in TEMPLATES)
        TEMPLATES[own] = template
    MARKS[own] = marks
    if against:
        MARKS_AGAINST[own] = against


def _add_families() -> None:
    for terms, words in CC_TERMS.items():
        for version, place in CC_VERSIONS.items():
            names = [words] if "NoDerivs" not in words else [words, words.replace("NoDerivs", "NoDerivatives")]
            said = "|".join(f"{n} {version}" for n in names)
            _add(f"cc-{terms}-{version}", f"This work is licensed under the Creative Commons {names[-1] if version == '4.0' else words} "
                 f"{version} {place} License.", (said,))
            _add(f"cc-{terms}-{version}", f"Licensed under CC {terms.upper()} {version}.", (f"cc {terms} {version}",))
    for name, (kind, version) in GNU.items():
        full = f"GNU {kind} General Public License".replace("  ", " ")
        short = f"{name.split('-')[0].upper()}"
        said = f"version {version}|v{version}|license {version}"
        # version 2 is not version 2.1
        against = () if "." in version or kind else (f"version {version} 1", f"v{version} 1")
        _add(name, f"This work is licensed under the {full}, version {version}.", (full, said), against)
        software = "library" if kind in ("Library", "Lesser") and version != "3" else "program"
        _add(name, f"This {software} is free software: you can redistribute it and/or modify it under the terms of the {full} as "
             f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
             "version.", (full, said), against)
        _add(name, f"Licensed under the GNU {short} v{version}.", (f"{short} v{version}|{short} version {version}|{short} {version}",), against)
        _add(name, f"redistribute it and/or modify it under the terms of the {full} version {version} as published by the Free "
             "Software Foundation.", (f"{full} version {version}|{full} v{version}",), against)
    _add("mit-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
         "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
         "persons to whom the Software is furnished to do so.", ("hereby granted",), ("subject to the following", "above copyright notice"))
    _add("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
         "granted.", ("hereby granted",), ("provided that",))
    _add("bsd-4-clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
         "following disclaimer in the documentation and/or other materials provided with the distribution. All advertising "
         "materials mentioning features or use of this software must display the following acknowledgement",
         ("all advertising materials",))
    _add("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
         "use this file except in compliance with the License.", ("mozilla public license", "version 1 1|v1 1"))
    for version in ("1.0", "2.0"):
        _add(f"epl-{version}", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
             f"License v{version}", ("eclipse public license", f"v{version}|v {version}|version {version}|license {version}"))
    _add("bsl-1.0", "Distributed under the Boost Software License, Version 1.0.", ("boost software license",))
    _add("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
         "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
         "any purpose, including commercial applications, and to alter it and redistribute it freely", ("redistribute it freely",))
    for name in ("2", "3"):
        _add(f"bsd-{name}-clause", f"Licensed under the BSD {name}-Clause License.", (f"bsd {name}",))
    for licence in sorted({licence_of(name) for name in TEMPLATES}):
        own = f"{licence}-spdx"
        TEMPLATES[own] = f"SPDX-License-Identifier: {licence}"
        MARKS[own] = (f"license identifier {licence}",)
        longer = [n for n in TEMPLATES if n.startswith(f"{licence}-") and licence_of(n) != licence]
        if longer:  # mit is not mit-0
            MARKS_AGAINST[own] = tuple(sorted({f"license identifier {licence_of(n)}" for n in longer}))


LEAST_MATCH = 4  # words of a stretch that counts as a match
MOST_GAP = 8  # words between two matches of a chain, in text and template
LEAST_COVER = 0.6  # share of a template's words that a chain must match


def tokens(text: str | None) -> list[bytes]:
    """Words of letters a-z, digits and characters beyond ASCII, A-Z in lower case."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


_add_families()


class SuffixAutomaton:
    """All stretches of the given sequences of numbers. State 0 is empty; ``last`` is where a state's stretch first ended."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last: list[set[tuple[int, int]]] = [set()]
        ends = []
        for number, sequence in enumerate(sequences):
            state = 0
            for at, token in enumerate(sequence):
                state = self._extend(state, token)
                ends.append((state, (number, at)))
        for state, place in ends:
            # every suffix of a stretch ends wherever the stretch ends
            while state > 0:
                self.last[state].add(place)
                state = self.link[state]

    def _state(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.last.append(set())
        return len(self.next) - 1

    def _split(self, state: int, token: int) -> int:
        """The state after ``token`` from ``state``, made one of its own if it also stands for longer stretches."""
        old = self.next[state][token]
        if self.length[old] == self.length[state] + 1:
            return old
        new = self._state(dict(self.next[old]), self.link[old], self.length[state] + 1)
        self.link[old] = new
        while state >= 0 and self.next[state].get(token) == old:
            self.next[state][token] = new
            state = self.link[state]
        return new

    def _extend(self, state: int, token: int) -> int:
        if token in self.next[state]:
            return self._split(state, token)
        new = self._state({}, 0, self.length[state] + 1)
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, token)
        return new

    def statistics(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """For each place, the state and length of the longest stretch ending there that some sequence contains."""
        state = length = 0
        for token in sequence:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            yield state, length


def _stands(phrase: list[bytes], words: list[bytes]) -> bool:
    size = len(phrase)
    return any(words[at:at + size] == phrase for at, word in enumerate(words) if word == phrase[0])


class Scanner:
    """Templates, phrases and their automaton, built once in each process."""

    def __init__(self) -> None:
        self.names = [*TEMPLATES]
        self.number: dict[bytes, int] = {}
        sequences = [[self.number.setdefault(w, len(self.number)) for w in tokens(t)] for t in TEMPLATES.values()]
        self.sizes = [len(s) for s in sequences]
        self.phrases = [([self.number.setdefault(w, len(self.number)) for w in tokens(p)], p) for p in PHRASES]
        self.sequences = sequences + [s for s, _ in self.phrases]
        self.automaton = SuffixAutomaton(self.sequences)
        self.marks = [[[tokens(way) for way in mark.split("|")] for mark in MARKS.get(n, ())] for n in self.names]
        self.against = [[tokens(mark) for mark in MARKS_AGAINST.get(n, ())] for n in self.names]

    def _marked(self, template: int, words: list[bytes], chain: list[int]) -> bool:
        """Whether the words that set the template apart stand where its words are, or what lacks of them would be."""
        end = chain[1] + self.sizes[template] - chain[2]
        near = words[max(0, chain[0] - chain[4]):end]
        after = words[chain[0]:end + AFTER]
        return all(any(_stands(way, near) for way in mark) for mark in self.marks[template]) and not any(
            _stands(mark, after) for mark in self.against[template])

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """Places of phrases (phrase, first word), and spans (template, first word, end, share of its words matched)."""
        number = self.number.get
        codes = [number(w, -1) for w in words]
        code = np.array(codes, np.int64)
        known = code >= 0
        if not known.any():
            return [], []
        edges = np.flatnonzero(np.diff(np.r_[0, known.astype(np.int8), 0]))
        phrases: list[tuple[str, int]] = []
        matches: list[tuple[int, int, int, int]] = []  # template, first word in text, first in template, words
        shortest = min(LEAST_MATCH, *(len(p) for p, _ in self.phrases))
        for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - first >= shortest:
                self._stretch(codes[first:end], first, phrases, matches)
        return sorted(phrases, key=lambda p: (p[1], p[0])), self._chains(matches, words)

    def _stretch(self, codes: list[int], first: int, phrases: list, matches: list) -> None:
        """Matches within words that all stand in templates or phrases."""
        automaton = self.automaton
        before = (0, 0)
        for at, (state, length) in enumerate([*automaton.statistics(codes), (0, 0)]):
            # a stretch ends where the next word does not lengthen it
            if before[1] >= LEAST_MATCH and length != before[1] + 1:
                for sequence, last in automaton.last[before[0]]:
                    if sequence < len(self.names):
                        matches.append((sequence, first + at - before[1], last - before[1] + 1, before[1]))
            before = (state, length)
        for sequence, phrase in self.phrases:
            head, size = sequence[0], len(sequence)
            place = -1
            for _ in range(codes.count(head)):
                place = codes.index(head, place + 1)
                if codes[place:place + size] == sequence:
                    phrases.append((phrase, first + place))

    def _chains(self, matches: list[tuple[int, int, int, int]], words: list[bytes]) -> list[tuple[str, int, int, float]]:
        found = []
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for template, at, own, size in matches:
            by_template.setdefault(template, []).append((at, own, size))
        for template, parts in by_template.items():
            open_chains: list[list[int]] = []  # first word, end, end in template, words matched, first in template
            for at, own, size in sorted(parts):
                best = None
                for chain in open_chains:
                    skip = max(0, chain[1] - at, chain[2] - own)  # of words that both have
                    if skip < size and at - chain[1] <= MOST_GAP and own - chain[2] <= MOST_GAP and at + skip >= chain[1]:
                        if best is None or chain[3] > best[3]:
                            best = chain
                if best is None:
                    open_chains.append([at, at + size, own + size, size, own])
                else:
                    skip = max(0, best[1] - at, best[2] - own)
                    best[1], best[2], best[3] = at + size, own + size, best[3] + size - skip
                done = [c for c in open_chains if at - c[1] > MOST_GAP]
                open_chains = [c for c in open_chains if at - c[1] <= MOST_GAP]
                found += [(template, c) for c in done]
            found += [(template, c) for c in open_chains]
        spans = [(self.names[t], c[0], c[1], min(1.0, c[3] / self.sizes[t])) for t, c in found
                 if c[3] >= LEAST_COVER * self.sizes[t] and self._marked(t, words, c)]
        return sorted((s for s in spans if s[3] >= LEAST_COVER), key=lambda s: (s[1], s[0], s[2]))


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, phrases, spans) per row.

    ``phrases``: array of struct(phrase, first), each place of each base phrase. ``spans``: array of struct(template,
    first, end, cover): words [first, end) of the text that match the share ``cover`` of the template. Null and empty
    texts have no words; ids may be null or repeat; other columns are ignored; an empty table gives an empty result.
    Texts are scanned whole, in time that follows their length.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = scanner()
        sizes, phrases, spans = [], [], []
        for text in batch.column(1).to_pylist():
            words = tokens(text)
            places, covered = own.scan(words)
            sizes.append(len(words))
            phrases.append([{"phrase": p, "first": a} for p, a in places])
            spans.append([{"template": t, "first": a, "end": e, "cover": c} for t, a, e, c in covered])
        place = pa.list_(pa.struct([("phrase", pa.string()), ("first", pa.int64())]))
        span = pa.list_(pa.struct([("template", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(phrases, place), pa.array(spans, span)],
            names=[id_col, "n_words", "phrases", "spans"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, n_words long, "
                                "phrases array<struct<phrase:string,first:bigint>>, "
                                "spans array<struct<template:string,first:bigint,end:bigint,cover:double>>")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every document; the score is the best cover, 1 for a base phrase. Labels are
    licences; which of their texts were found is in ``templates``."""
    found = scan(read(spark, sf_dir, "documents"))
    base = F.array_distinct(F.transform("phrases", lambda x: F.element_at(F.create_map(
        *[F.lit(v) for pair in PHRASES.items() for v in pair]), x["phrase"])))
    firsts = F.transform("phrases", lambda x: x["first"])
    templates = F.transform("spans", lambda s: s["template"])
    own = F.transform(templates, lambda t: F.regexp_replace(t, VARIANTS.pattern, ""))
    covers = F.transform("spans", lambda s: s["cover"])
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat("base", own))), ",").alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(covers), F.lit(0.0))).alias("score"),
        F.array_join(F.sort_array(F.array_distinct(templates)), ",").alias("templates"),
    )
