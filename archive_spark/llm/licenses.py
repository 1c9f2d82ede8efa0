"""Licences in texts: a generalised suffix automaton over the words of licence templates.

Texts stream through the automaton, which tells for every word the longest run ending there
that stands in some template (matching statistics). Long matches are chained in the order
of the template, and the share of its words that the best chain covers decides the label.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import PLAIN, batch_of, pieces, small, utf8, values

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Wording of public licences and of their usual notices.
TEMPLATES = {
    "text:mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files (the "Software"), to deal in the
        Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in
        all copies or substantial portions of the Software.""",
    "text:bsd": """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:
        Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "text:isc": """Permission to use, copy, modify, and/or distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice
        and this permission notice appear in all copies.""",
    "text:zlib": """This software is provided 'as-is', without any express or implied warranty.
        In no event will the authors be held liable for any damages arising from the use of this
        software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely.""",
    "text:unlicense": """This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    "notice:apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may
        not use this file except in compliance with the License. You may obtain a copy of the
        License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS
        IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "notice:gpl": """This program is free software: you can redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software
        Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE.""",
    "notice:mpl": """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    "line:apache-2": "Licensed under the Apache License, Version 2.0",
    "line:gpl-3": "licensed under the GNU General Public License, version 3",
    "line:mit": "released under the MIT License",
    "line:cc-by": "licensed under a Creative Commons Attribution",
}
LEAST_MATCH = 4
LEAST_COVER = 0.6
MOST_GAP = 12

FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.string()),
    ]
)
FOUND_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans string"
)


def plain_words(text: bytes) -> list[bytes]:
    """Words of small letters, digits and everything beyond ASCII."""
    return text.translate(PLAIN).split()


class SuffixAutomaton:
    """All runs of words of several sequences; where each run ends in each of them.

    A state stands for runs with the same end places. ``ends`` lists these as (sequence,
    place after the run); a longer sequence shares the states of a shorter one.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        own: list[tuple[int, int, int]] = []
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self.extend(last, word)
                own.append((last, number, place + 1))
        for state, number, place in own:
            while state > 0:
                if (number, place) not in self.ends[state]:
                    self.ends[state].append((number, place))
                state = self.link[state]

    def new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(dict(following))
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.length) - 1

    def split(self, state: int, word: int) -> int:
        """The state of the runs of ``state`` followed by ``word``, its longest ones alone."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self.new(self.length[state] + 1, self.link[target], self.next[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self.split(last, word)
        state = self.new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self.split(at, word)
        return state

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place after the word, length of the longest run ending there, its state)."""
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
            yield place + 1, length, state


class Templates:
    """Templates ready to search for."""

    def __init__(self, templates: dict[str, str], least: int, gap: int):
        self.names = list(templates)
        self.least, self.gap = least, gap
        split = [plain_words(templates[n].encode()) for n in self.names]
        self.ids: dict[bytes, int] = {}
        sequences = [[self.ids.setdefault(w, len(self.ids)) for w in s] for s in split]
        self.size = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)

    def matches(self, words: list[int], at: int) -> list[tuple[int, int, int, int]]:
        """Longest matches as (template, place in it, place in the text, length)."""
        found = []
        steps = list(self.automaton.statistics(words))
        for (end, length, state), (_, after, _) in zip(steps, [*steps[1:], (0, 0, 0)]):
            if length >= self.least and after <= length:
                for template, stop in self.automaton.ends[state]:
                    found.append((template, stop - length, at + end - length, length))
        return found

    def chains(
        self, found: list[tuple[int, int, int, int]], least_cover: float
    ) -> list[tuple[float, int, int, int]]:
        """Chains of each template as (share covered, template, first word, end).

        The best one, and apart from it all that cover ``least_cover``, better ones first.
        """
        taken = []
        for template in sorted({m[0] for m in found}):
            todo = [sorted((t, p, n) for k, p, t, n in found if k == template)]
            best = True
            while todo:
                own = todo.pop()
                apart: list[tuple[int, int]] = []
                for cover, start, end in self.chained(template, own):
                    share = min(1.0, cover / self.size[template])
                    if share < least_cover and not best:
                        break
                    k = bisect_left(apart, (start,))
                    if (k and apart[k - 1][1] > start) or (k < len(apart) and apart[k][0] < end):
                        continue
                    apart.insert(k, (start, end))
                    taken.append((share, template, start, end))
                    best = False
                # A chain that ran into a taken one may have a whole one in what is left of it.
                k, left = 0, [[] for _ in range(len(apart) + 1)]
                for t, p, n in own if apart else ():
                    while k < len(apart) and apart[k][1] <= t:
                        k += 1
                    if k == len(apart) or t + n <= apart[k][0]:
                        left[k].append((t, p, n))
                todo += [g for g in left if g and sum(m[2] for m in g) >= least_cover * self.size[template]]
        return taken

    def chained(self, template: int, own: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The best chain to each match as (words covered, first word, end), best first."""
        cover, start, ends = [], [], []
        for k, (t, p, n) in enumerate(own):
            cover.append(n)
            start.append(t)
            ends.append(t + n)
            low = bisect_left(own, (t - self.size[template] - self.gap,))
            for j in range(low, k):
                tj, pj, nj = own[j]
                new = min(n, p + n - (pj + nj), t + n - (tj + nj))
                near = t - (tj + nj) <= self.gap
                if near and tj < t and pj < p and new > 0 and cover[j] + new > cover[k]:
                    cover[k], start[k] = cover[j] + new, start[j]
        order = sorted(range(len(own)), key=lambda k: (-cover[k], start[k]))
        return [(cover[k], start[k], ends[k]) for k in order]


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    least_match: int = LEAST_MATCH,
    least_cover: float = LEAST_COVER,
    most_gap: int = MOST_GAP,
) -> DataFrame:
    """Licence phrases and licence templates in every document; nothing is shuffled.

    Base columns tell where the fixed phrases stand (n_base counts all places). ``labels``
    adds each template of which matches of ``least_match`` words or more, chained with at
    most ``most_gap`` words between them, cover ``least_cover``; ``spans`` gives every such
    chain apart from better ones of its template as ``label:first word:end``. ``score`` is
    the best cover, 1 with a phrase. A missing or empty text has no words, no labels (empty strings) and score 0; repeated rows are
    searched each; an empty table gives no rows; columns other than doc_id and text are not
    looked at.
    """
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, least_match, most_gap)
        ids = known.ids
        phrases = [
            (label, [ids.setdefault(w, len(ids)) for w in plain_words(p.encode())])
            for p, label in PHRASES.items()
        ]
        for batch in small(batches):
            texts = utf8(batch, "text")
            rows: list[tuple] = []
            for piece in pieces(texts):
                words: list[bytes] = []
                counts = []
                for text in texts[piece]:
                    own = plain_words(text)
                    counts.append(len(own))
                    words += own
                rows += search(words, counts, known, ids, phrases)
            columns = list(zip(*rows)) if rows else [[]] * (len(FOUND) - 1)
            yield batch_of(FOUND, [values(batch, "doc_id"), *columns])

    def search(words, counts, known, ids, phrases):
        code = np.fromiter((ids.get(w, -1) for w in words), np.int64, len(words))
        doc = np.repeat(np.arange(len(counts)), counts)
        first = np.concatenate([[0], np.cumsum(counts)])
        base: dict[int, list[tuple[int, str]]] = {}
        for label, phrase in phrases:
            n = len(code) - len(phrase) + 1
            if n > 0:
                hit = doc[:n] == doc[len(phrase) - 1 :]
                for k, word in enumerate(phrase):
                    hit &= code[k : n + k] == word
                for at in np.flatnonzero(hit).tolist():
                    d = int(doc[at])
                    base.setdefault(d, []).append((at - int(first[d]), label))
        found: dict[int, list] = {}
        n = len(code) - known.least + 1
        if n > 0:
            run_of = (code[:n] >= 0) & (doc[:n] == doc[known.least - 1 :])
            for k in range(1, known.least):
                run_of &= code[k : n + k] >= 0
            starts = np.flatnonzero(run_of)
            if len(starts):
                new = np.flatnonzero(
                    (np.diff(starts, prepend=-2) != 1) | (np.diff(doc[starts], prepend=-1) != 0)
                )
                for low, high in zip(new, [*new[1:], len(starts)]):
                    s, e = int(starts[low]), int(starts[high - 1]) + known.least
                    d = int(doc[s])
                    matched = known.matches(code[s:e].tolist(), s - int(first[d]))
                    if matched:
                        found.setdefault(d, []).extend(matched)
        for d, n_words in enumerate(counts):
            at = sorted(base.get(d, ()))
            labels = {label for _, label in at}
            score = 1.0 if at else 0.0
            spans = []
            for cover, template, start, end in known.chains(found.get(d, []), least_cover):
                score = max(score, cover)
                if cover >= least_cover:
                    spans.append((start, end, known.names[template]))
            yield (
                n_words,
                len(at),
                at[0][0] if at else None,
                at[-1][0] if at else None,
                ",".join(sorted(labels)),
                ",".join(sorted(labels | {name for _, _, name in spans})),
                score,
                ",".join(f"{name}:{start}:{end}" for start, end, name in sorted(spans)),
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, FOUND_DDL)
