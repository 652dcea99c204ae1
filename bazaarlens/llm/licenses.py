"""License scans: a generalised suffix automaton of licence tokens.

All templates go into one automaton over words. A file's words are streamed through
it, which gives for every word the length of the longest run ending there that
occurs in some template (its matching statistics). Runs of some length are chained
per template while they move forward in file and template, and a chain that covers
enough of the template is a span.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from bazaarlens.llm.common import append_columns, filled, table

# Phrases whose every place counts, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Paragraphs of well-known licences, in words.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or "
        "the use or other dealings in the software",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0 the license you may not use this "
        "file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "this software is provided by the copyright holders and contributors as is and any "
        "express or implied warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose are disclaimed",
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the "
        "terms of the gnu general public license as published by the free software foundation",
        "this program is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a "
        "particular purpose see the gnu general public license for more details",
    ),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    "cc-by": ("this work is licensed under a creative commons attribution",),
    "all-rights-reserved": ("all rights reserved",),
}
#: Texts by label: any number of paragraphs or whole licences each.
Templates = Mapping[str, str | Sequence[str]]
#: Words a run needs to enter a chain, words a chain may skip, share of a template.
LEAST_RUN, MOST_GAP, LEAST_COVER = 3, 8, 0.6

_PLACE = StructType(
    [StructField("label", StringType()), StructField("start", LongType()), StructField("end", LongType())]
)
_SPAN = StructType([*_PLACE.fields, StructField("cover", DoubleType())])
FIELDS = [
    StructField("n_words", LongType()),
    StructField("places", ArrayType(_PLACE)),
    StructField("spans", ArrayType(_SPAN)),
]

# Every byte outside words becomes a space; A-Z become a-z. Bytes from 0x80 on are
# parts of letters beyond ASCII, which are words too.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Words: runs of a-z (lower-cased A-Z), 0-9 and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over token ids."""

    def __init__(self, strings: list[list[int]]):
        self.moves: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: per state, template -> last words of its occurrences
        self.ends: list[dict[int, list[int]]] = [{}]
        for number, string in enumerate(strings):
            last = 0
            for at, token in enumerate(string):
                last = self._extend(last, token)
                state = last
                while state > 0:
                    self.ends[state].setdefault(number, []).append(at)
                    state = self.link[state]

    def _state(self, length: int, link: int, moves: dict, ends: dict) -> int:
        self.moves.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(ends)
        return len(self.link) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """The state of the strings of q no longer than p's by one token."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(
            self.length[p] + 1,
            self.link[q],
            dict(self.moves[q]),
            {number: list(at) for number, at in self.ends[q].items()},
        )
        self.link[q] = clone
        while p >= 0 and self.moves[p].get(token) == q:
            self.moves[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.moves[last]:
            return self._split(last, self.moves[last][token], token)
        new = self._state(self.length[last] + 1, 0, {}, {})
        p = last
        while p >= 0 and token not in self.moves[p]:
            self.moves[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.moves[p][token], token)
        return new

    def find(self, string: list[int]) -> int:
        state = 0
        for token in string:
            state = self.moves[state][token]
        return state


def scanner(
    phrases: dict[str, str], templates: Templates
) -> Callable[[str], tuple[int, list, list]]:
    """A function from a text to its number of words, phrase places and spans."""
    strings = [
        (label, words_of(text))
        for label, texts in templates.items()
        for text in ([texts] if isinstance(texts, str) else texts)
    ]
    marks = [(label, words_of(text)) for text, label in phrases.items()]
    numbers: dict[bytes, int] = {}
    for _, words in strings + marks:
        for word in words:
            numbers.setdefault(word, len(numbers))
    coded = [[numbers[w] for w in words] for _, words in strings + marks]
    automaton = Automaton(coded)
    own: dict[int, list[tuple[int, str]]] = {}
    for (label, words), string in zip(marks, coded[len(strings) :], strict=True):
        own.setdefault(automaton.find(string), []).append((len(words), label))
    # phrases that end wherever a state's longest string ends, by way of suffix links
    ending: list[list[tuple[int, str]]] = []
    for state in range(len(automaton.link)):
        found, s = [], state
        while s > 0:
            found += own.get(s, [])
            s = automaton.link[s]
        ending.append(found)
    moves, link, length, ends = automaton.moves, automaton.link, automaton.length, automaton.ends
    get = numbers.get

    def runs_of(ids: list) -> tuple[list, list]:
        """Phrase places, and maximal runs (last word, length, state)."""
        places, runs = [], []
        state = size = 0
        for at, token in enumerate(ids):
            if token is None:
                if size >= LEAST_RUN:
                    runs.append((at - 1, size, state))
                state = size = 0
                continue
            before, was = size, state
            while state and token not in moves[state]:
                state = link[state]
                size = length[state]
            if token in moves[state]:
                state = moves[state][token]
                size += 1
            if before >= LEAST_RUN and size <= before:
                runs.append((at - 1, before, was))
            for n, label in ending[state]:
                if n <= size:
                    places.append((label, at - n + 1, at + 1))
        if size >= LEAST_RUN:
            runs.append((len(ids) - 1, size, state))
        return places, runs

    def chained(runs: list) -> list:
        """Spans of the templates: the best chains of runs that cover enough of each."""
        ready: dict[int, list] = {}
        # template -> its last word reached -> first word, word after the last, words covered
        open_chains: dict[int, dict[int, tuple]] = {}

        def close(number: int, chains: list[tuple]) -> None:
            least = LEAST_COVER * len(strings[number][1])
            ready.setdefault(number, []).extend(c for c in chains if c[2] >= least)

        for last, size, state in runs:
            from_word = last - size + 1
            for number, ats in ends[state].items():
                if number >= len(strings):
                    continue
                chains = open_chains.setdefault(number, {})
                old = [at for at, c in chains.items() if from_word - c[1] > MOST_GAP]
                close(number, [chains.pop(at) for at in old])
                before = list(chains.items())
                for at in ats:
                    best = (from_word, last + 1, size)
                    for reached, (start, end, covered) in before:
                        fresh = min(size, at - reached, last + 1 - end)
                        if fresh > 0 and covered + fresh > best[2]:
                            best = (start, last + 1, covered + fresh)
                    if at not in chains or chains[at][2] <= best[2]:
                        close(number, [chains[at]] if at in chains else [])
                        chains[at] = best
        for number, chains in open_chains.items():
            close(number, list(chains.values()))
        spans = []
        for number, chains in ready.items():
            taken: list[tuple] = []
            for chain in sorted(chains, key=lambda c: (-c[2], c[1] - c[0], c[0])):
                if all(chain[1] <= t[0] or t[1] <= chain[0] for t in taken):
                    taken.append(chain)
            label, words = strings[number]
            spans += [(label, start, end, min(1.0, n / len(words))) for start, end, n in taken]
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))

    def scan(text: str) -> tuple[int, list, list]:
        words = words_of(text)
        ids = list(map(get, words))
        places, runs = runs_of(ids)
        return len(words), places, chained(runs)

    return scan


def scan_licenses(
    df: DataFrame,
    text: Column | None = None,
    phrases: dict[str, str] = PHRASES,
    templates: Templates = TEMPLATES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``n_words``, phrase ``places`` and template ``spans``, in words from 0.

    One row for each row, repeated ones included. A null or empty text has no words,
    an empty table stays empty, texts are read whole, columns of these names are
    replaced. Overlapping places all count. A place covers its phrase fully; a span
    states the share of its template's words that it covers.
    """

    def make() -> Callable[[list], list]:
        scan = scanner(phrases, templates)
        return lambda texts: [list(x) for x in zip(*map(scan, texts))] if texts else [[], [], []]

    return append_columns(df, [filled() if text is None else text], FIELDS, make, keep)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places, labels and score of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    more = F.transform("spans", lambda s: s["label"])
    covers = F.transform("spans", lambda s: s["cover"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(covers), F.lit(0.0)))
        .alias("score"),
    )
