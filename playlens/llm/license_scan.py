"""License scan: license templates with markup, compiled to automata over words.

A template is the wording of a license or notice with two kinds of markup, as in the public template
notation of license lists:

    [[ ... ]]      an optional region; regions nest
    <<name:a-b>>   a replaceable region of a to b words of any kind

It is compiled to an automaton whose states are sets of word positions: optional regions become
steps that may be left out, replaceable ones runs of places that take any word. A place in a text is
accepted when all mandatory words stand there in order and nothing else but what the markup allows;
of the ends that one start can have, the last counts. States are made when a text first needs them
and are remembered, so a text costs one step per word after a possible start.

Words are runs of ASCII letters (A-Z in lower case), digits and characters beyond ASCII. A template
is tried only in texts that have its longest mandatory word, and only where one of its first words
stands. Every replaceable region is bounded, so no start reads more words than its template can
hold, and time is linear in the text.

Edge cases
    null, empty text      no words, no places: counts 0, first_word and last_word null, labels ''
    very long text        one pass, memory in proportion to the text
    ties, repeated rows   every row gets its own result; places may lie within one another
    null doc_id           scanned like any other row
    empty table           empty result
    other columns         ignored, whatever their names
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# How far a match decides: the whole text of a license, a notice that grants one, its bare name.
TEXT, NOTICE, NAME = 1.0, 0.9, 0.5

MIT_TEXT = """
    [[<<holder:0-12>>]] permission is hereby granted free of charge to any person obtaining a copy
    of this software and associated documentation files the software to deal in the software
    without restriction including without limitation the rights to use copy modify merge publish
    distribute sublicense and or sell copies of the software and to permit persons to whom the
    software is furnished to do so subject to the following conditions the above copyright notice
    and this permission notice [[including the next paragraph]] shall be included in all copies or
    substantial portions of the software
    [[the software is provided as is without warranty of any kind express or implied including but
    not limited to the warranties of merchantability fitness for a particular purpose and
    noninfringement in no event shall <<holders:1-12>> be liable for any claim damages or other
    liability whether in an action of contract tort or otherwise arising from out of or in
    connection with the software or the use or other dealings in the software]]"""

BSD_HEAD = """
    redistribution and use in source and binary forms with or without modification are permitted
    provided that the following conditions are met [[1]] redistributions of source code must retain
    the above copyright notice this list of conditions and the following disclaimer [[2]]
    redistributions in binary form must reproduce the above copyright notice this list of
    conditions and the following disclaimer in the documentation and or other materials provided
    with the distribution"""

BSD_THIRD = """
    [[3]] neither the name of <<holder:1-12>> nor the names of its contributors may be used to
    endorse or promote products derived from this software without specific prior written
    permission"""

ISC_TEXT = """
    permission to use copy modify and [[or]] distribute this software for any purpose with or
    without fee is hereby granted provided that the above copyright notice and this permission
    notice appear in all copies"""

APACHE_NOTICE = """
    licensed under the apache license version 2 0 [[the license you may not use this
    <<object:1-4>> except in compliance with the license [[you may obtain a copy of the license at
    [[https]] [[http]] www apache org licenses license 2 0]] ]]"""

GPL_NOTICE = """
    this <<object:1-6>> is free software you can redistribute it and or modify it under the terms
    of the gnu [[lesser]] general public license as published by the free software foundation
    either version <<version:1-2>> of the license or at your option any later version"""

# label: (wording, weight)
TEMPLATES = {
    "mit-text": (MIT_TEXT, TEXT),
    "bsd-2-clause-text": (BSD_HEAD, TEXT),
    "bsd-3-clause-text": (BSD_HEAD + BSD_THIRD, TEXT),
    "isc-text": (ISC_TEXT, TEXT),
    "apache-2.0-notice": (APACHE_NOTICE, NOTICE),
    "gpl-notice": (GPL_NOTICE, NOTICE),
    "mit-notice": ("[[<<work:0-4>>]] released under the [[terms of the]] mit license", NOTICE),
    "mit-notice ": ("licensed under the [[terms of the]] mit license", NOTICE),
    "gpl-notice ": ("licensed under the [[terms of the]] gnu general public license "
                    "[[version <<version:1-2>>]]", NOTICE),
    "mpl-2.0-notice": ("this source code form is subject to the terms of the mozilla public license "
                       "v 2 0", NOTICE),
    "spdx-tag": ("spdx license identifier <<name:1-4>>", NOTICE),
}

MARKUP = re.compile(r"\[\[|\]\]|<<\w+:(\d+)-(\d+)>>|([^\s<\[\]]+)")

# Bytes of a text in UTF-8: ASCII letters and digits stay, in lower case, other ASCII is a gap.
GAPS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()

# States of one automaton that a worker remembers.
REMEMBERED_STATES = 20_000

ANY = None


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(GAPS).split() if text else []


@dataclass
class Region:
    """A part of a template: its items are words, ANY, or optional regions."""

    items: list = field(default_factory=list)


def parse(template: str) -> Region:
    """The regions of a template; a replaceable region becomes a..b places of which b-a are optional."""
    top = Region()
    stack = [top]
    for match in MARKUP.finditer(template):
        if match[0] == "[[":
            inner = Region()
            stack[-1].items.append(inner)
            stack.append(inner)
        elif match[0] == "]]":
            if len(stack) == 1:
                raise ValueError("a region ends that did not begin")
            stack.pop()
        elif match[3]:
            stack[-1].items += words_of(match[3])
        else:
            least, most = int(match[1]), int(match[2])
            stack[-1].items += [ANY] * least
            rest = None
            for _ in range(most - least):
                rest = Region([ANY, rest] if rest else [ANY])
            if rest:
                stack[-1].items.append(rest)
    if len(stack) > 1:
        raise ValueError("a region does not end")
    return _bare(top)


def _bare(region: Region) -> Region:
    """Without optional regions and free places at either end, which tell nothing."""
    items = list(region.items)
    while items and (items[0] is ANY or isinstance(items[0], Region)):
        items.pop(0)
    while items and items[-1] is ANY:
        items.pop()
    return Region(items)


class Automaton:
    """Accepts the word runs of a template; states are sets of places reached, made on demand."""

    def __init__(self, template: str):
        self.places: list[bytes | None] = []
        self.follow: list[set[int]] = []
        region = parse(template)
        first, last, empty = self._link(region.items)
        if empty or not first:
            raise ValueError("a template needs mandatory words")
        self.first, self.last = frozenset(first), frozenset(last)
        self.first_words = frozenset(self.places[p] for p in first)
        # A text without this word cannot match.
        self.needed = max((w for w in region.items if isinstance(w, bytes)), key=len)
        self.words = frozenset(w for w in self.places if w is not ANY)
        self.steps: dict[tuple[frozenset, bytes | None], frozenset] = {}

    def _link(self, items: list) -> tuple[set[int], set[int], bool]:
        """First and last places of a run of items, and whether it may be left out."""
        first: set[int] = set()
        last: set[int] = set()
        empty = True
        for item in items:
            if isinstance(item, Region):
                starts, ends, _ = self._link(item.items)
                optional = True
            else:
                starts = ends = {len(self.places)}
                self.places.append(item)
                self.follow.append(set())
                optional = False
            for place in last:
                self.follow[place] |= starts
            if empty:
                first |= starts
            last = last | ends if optional else set(ends)
            empty = empty and optional
        return first, last, empty

    def step(self, state: frozenset, word: bytes) -> frozenset:
        key = (state, word if word in self.words else ANY)
        found = self.steps.get(key)
        if found is None:
            if len(self.steps) >= REMEMBERED_STATES:
                self.steps.clear()
            near = set().union(*(self.follow[p] for p in state))
            found = self.steps[key] = frozenset(
                p for p in near if self.places[p] is ANY or self.places[p] == word)
        return found

    def end(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest match that begins at `start`."""
        state = frozenset(p for p in self.first if self.places[p] == words[start])
        at, found = start + 1, None
        while state:
            if state & self.last:
                found = at
            if at == len(words):
                break
            state = self.step(state, words[at])
            at += 1
        return found


@cache
def automata() -> list[tuple[str, float, bool, Automaton]]:
    """Label, weight, whether a base phrase, and automaton of every template."""
    base = [(label, NAME, True, Automaton(phrase)) for phrase, label in BASE.items()]
    own = [(label.strip(), weight, False, Automaton(text))
           for label, (text, weight) in TEMPLATES.items()]
    return base + own


def places_of(words: list[bytes], joined: bytes | None = None) -> list[dict]:
    """Every accepted place: label, first word, end (exclusive), weight, base."""
    found = []
    there = set(words) if joined is None else None
    for label, weight, base, automaton in automata():
        if automaton.needed not in (joined if there is None else there):
            continue
        for at in starts(words, automaton.first_words):
            end = automaton.end(words, at)
            if end is not None:
                found.append({"label": label, "start": at, "end": end, "weight": weight,
                              "base": base})
    return sorted(found, key=lambda p: (p["start"], p["end"], p["label"]))


def starts(words: list[bytes], first: Iterable[bytes]) -> Iterator[int]:
    for word in first:
        at = -1
        for _ in range(words.count(word)):
            at = words.index(word, at + 1)
            yield at


PLACE = "label string, start long, end long, weight double, base boolean"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and the accepted places of every document."""
    kinds = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("weight", pa.float64()), ("base", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in batch.column("text"):
                body = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(GAPS)
                words = body.split()
                counts.append(len(words))
                found.append(places_of(words, body))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kinds)],
                ["doc_id", "n_words", "places"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"doc_id {kind}, n_words long, places array<struct<{_struct()}>>")


def _struct() -> str:
    return ", ".join(part.replace(" ", ": ", 1) for part in PLACE.split(", "))


def digest(found: DataFrame) -> DataFrame:
    """Counts and borders of the base places, labels of both kinds, and the score.

    The score is the weight of the strongest place: 1 for a license text, 0.9 for a notice, 0.5 for
    a bare name, 0 without any.
    """
    base = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(
        F.transform(places, lambda p: p["label"]))), ",")
    start = F.transform(base, lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["weight"])), F.lit(0.0))
        .alias("score"))
