"""Licence texts in documents: fixed phrases, and long matches with licence templates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import small_batches

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of common licences and notices, each with its label.
TEMPLATES = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "SPDX-License-Identifier: MIT"),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details.""",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related or neighboring rights"),
]

# A word is a run of ASCII digits and letters, which are lower-cased, and bytes from 128 on; the rest becomes spaces.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()


class SuffixAutomaton:
    """The smallest automaton of all runs of tokens of several sequences, with the places where each
    run ends.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for position, token in enumerate(sequence):
                last = self._extend(last, token)
                while len(ends) < len(self.length):
                    ends.append([])
                ends[last].append((number, position))
        # Where a run ends, its suffixes end too.
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] += ends[state]
        self.ends = ends

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(following)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, source: int, token: int) -> int:
        """The state after ``token`` from ``source`` whose longest run is one longer than that of ``source``."""
        target = self.next[source][token]
        if self.length[target] == self.length[source] + 1:
            return target
        clone = self._state(self.length[source] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while source >= 0 and self.next[source].get(token) == target:
            self.next[source][token] = clone
            source = self.link[source]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        state = self._state(self.length[last] + 1, {}, 0)
        source = last
        while source >= 0 and token not in self.next[source]:
            self.next[source][token] = state
            source = self.link[source]
        if source >= 0:
            self.link[state] = self._split(source, token)
        return state

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """For each token the state and the length of the longest run that ends there and is in a sequence."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                state = length = 0
            yield state, length


@dataclass(frozen=True)
class Matcher:
    """``shortest`` match in words, longest ``gap`` between chained matches, ``share`` of a template
    that counts.
    """

    shortest: int = 3
    gap: int = 12
    share: float = 0.75
    templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)
    automata: list[SuffixAutomaton] = field(default_factory=list)

    def ready(self) -> Matcher:
        """With the automaton built, once per process."""
        if not self.automata:
            sequences = [words_of(text) for _, text in self.templates]
            for word in (w for words in sequences for w in words):
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
            self.sizes.extend(len(words) for words in sequences)
            self.automata.append(SuffixAutomaton([[self.vocabulary[w] for w in words] for words in sequences]))
        return self

    def matches(self, words: list[bytes]) -> dict[int, list[tuple[int, int, int]]]:
        """Per template the longest matches as ``(start in the text, start in the template, length)``, in order.

        Only stretches of words that templates use go through the automaton: any other word would end a match.
        """
        get, automaton = self.vocabulary.get, self.automata[0]
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        edges = np.flatnonzero(np.diff(ids > 0, prepend=False, append=False)).reshape(-1, 2)
        found: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in edges[edges[:, 1] - edges[:, 0] >= self.shortest].tolist():
            before = (0, 0)
            for i, now in enumerate([*automaton.statistics(ids[a:b].tolist()), (0, 0)], a):
                state, length = before
                if length >= self.shortest and now[1] <= length:
                    for template, end in automaton.ends[state]:
                        found.setdefault(template, []).append((i - length, end - length + 1, length))
                before = now
        return found

    def chain(self, matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
        """``(words covered, first word, last word)`` of the best chain: matches in order both in text
        and template.
        """
        matches = sorted(set(matches))
        best = (0, 0, 0)
        chains: list[tuple[int, int]] = []  # covered, first word
        low = 0
        longest = max(m[2] for m in matches)
        for k, (start, place, length) in enumerate(matches):
            while matches[low][0] + longest + self.gap < start:
                low += 1
            covered, first = length, start
            for j in range(low, k):
                s, p, n = matches[j]
                # Of overlapping matches only the new words count.
                new = length - max(0, s + n - start, p + n - place)
                if s < start and p < place and new > 0 and start - s - n <= self.gap and chains[j][0] + new > covered:
                    covered, first = chains[j][0] + new, chains[j][1]
            chains.append((covered, first))
            best = max(best, (covered, -first, start + length - 1))
        return best[0], -best[1], best[2]

    def scan(self, words: list[bytes]) -> tuple[dict[str, tuple[int, int]], float]:
        """Labels with the span of words that carries them, and the largest covered share of a template."""
        labels: dict[str, tuple[int, int]] = {}
        top = 0.0
        shares: dict[str, float] = {}
        for template, matches in self.matches(words).items():
            covered, first, last = self.chain(matches)
            share = covered / self.sizes[template]
            top = max(top, share)
            label = self.templates[template][0]
            if share >= self.share and share > shares.get(label, 0):
                shares[label], labels[label] = share, (first, last)
        return labels, min(1.0, top)


def base_places(words: list[bytes]) -> dict[str, list[int]]:
    """Per phrase found, the numbers of the words at which it starts, overlaps included."""
    joined = b" " + b" ".join(words) + b" "
    found: dict[str, list[int]] = {}
    for phrase in PHRASES:
        needle = f" {phrase} ".encode()
        at, counted, number = joined.find(needle), 0, 0
        while at >= 0:
            number += joined.count(b" ", counted, at)
            counted = at
            found.setdefault(phrase, []).append(number)
            at = joined.find(needle, at + 1)
    return found


def licenses(text: Column, matcher: Matcher | None = None) -> Column:
    """A struct of what a whole text says about licences.

    ``score`` is the largest share of a template that chained matches cover, and 1 with a base
    phrase. ``template_spans`` has ``label:first word:last word`` of the best chain of each label of
    the method. Null is an empty text.
    """
    matcher = matcher or Matcher()

    def row(text: str | None) -> tuple:
        words = words_of(text)
        places = base_places(words)
        starts = [p for found in places.values() for p in found]
        labels, score = matcher.scan(words)
        base = {PHRASES[p] for p in places}
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | set(labels))),
            1.0 if base else score,
            ",".join(f"{label}:{a}:{b}" for label, (a, b) in sorted(labels.items())),
        )

    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, template_spans string"
    )

    @F.pandas_udf(schema)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher.ready()
        names = [part.split()[0] for part in schema.split(", ")]
        for texts in batches:
            out = pd.DataFrame([row(t) for t in texts], columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return found(text)


def find_licenses(docs: DataFrame, matcher: Matcher | None = None) -> DataFrame:
    """What ``licenses`` finds for every row of ``docs(doc_id, text)``.

    Repeated rows give repeated results; other columns are ignored. An empty table gives no rows.
    """
    return small_batches(docs).select("doc_id", licenses(F.col("text"), matcher).alias("found")).select("doc_id", "found.*")
