"""License wording found by templates.

A template is text with marked regions: ``[[ ... ]]`` may be left out, and
``{{name|words}}`` stands for up to that many words of any kind. It is compiled
into an automaton over words; a text holds the template where the automaton
accepts consecutive words, so all wording outside the marks must be there,
exactly and in order. The longest run of mandatory words is looked up first;
the automaton then runs only around its places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.texts import as_bytes, small

#: Phrases whose places are counted, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Notices as licensors publish them; regions that vary are marked.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license [[version]] 2.0"),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at"),
    ("mit", "[[the software is]] released under the [[{{style|2}}]] mit license"),
    ("mit", "[[this software is]] licensed under the [[terms of the]] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files {{name|3}} to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("gpl-3.0", "[[this {{work|3}} is]] licensed under the [[terms of the]] gnu general public license [[version]] 3 [[0]]"),
    ("gpl-2.0", "[[this {{work|3}} is]] licensed under the [[terms of the]] gnu general public license [[version]] 2 [[0]]"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu [[{{kind|1}}]] general public "
            "license as published by the free software foundation"),
    ("cc-by-nc-4.0", "licensed under [[a]] [[the]] cc by nc 4 0 [[{{scope|1}} license]]"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] cc by 4 0 [[{{scope|1}} license]]"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 [[international]] license"),
    ("spdx", "spdx license identifier {{id|4}}"),
    ("copyright", "copyright [[c]] {{year_and_holder|12}} all rights reserved"),
)

#: Letters and digits of ASCII and all other characters make words; the rest parts them.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))
_TOKEN = re.compile(r"\[\[|\]\]|\{\{[^|}]*\|\d+\}\}|[^\s\[\]{}]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Automaton:
    """States are numbers; ``steps`` leads on a word, ``any`` on every word, ``free`` on none."""

    steps: list[dict[bytes, int]] = field(default_factory=list)
    any: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    anchor: list[bytes] = field(default_factory=list)
    before: int = 0
    longest: int = 0

    def state(self) -> int:
        self.steps.append({})
        self.any.append(set())
        self.free.append(set())
        return len(self.steps) - 1

    def closed(self, states: set[int]) -> set[int]:
        found, waiting = set(states), list(states)
        while waiting:
            for s in self.free[waiting.pop()] - found:
                found.add(s)
                waiting.append(s)
        return found

    def end(self, text: list[bytes], start: int) -> int | None:
        """End of the longest accepted run of words from ``start``."""
        final, states, best = len(self.steps) - 1, self.closed({0}), None
        at = start
        while states:
            if final in states:
                best = at
            if at == len(text):
                break
            word = text[at]
            states = self.closed({self.steps[s][word] for s in states if word in self.steps[s]}
                                 | {t for s in states for t in self.any[s]})
            at += 1
        return best


def compile_template(template: str) -> Automaton:
    """Automaton of a template. The template must have mandatory words."""
    found = Automaton()
    now = found.state()
    opened: list[int] = []
    runs: list[tuple[int, list[bytes]]] = [(0, [])]
    for token in _TOKEN.findall(template):
        if token == "[[":
            opened.append(now)
            following = found.state()
            found.free[now].add(following)
            now = following
        elif token == "]]":
            following = found.state()
            found.free[now].add(following)
            found.free[opened.pop()].add(following)
            now = following
        elif token.startswith("{{"):
            n = int(token[:-2].rpartition("|")[2])
            ends = [now]
            for _ in range(n):
                following = found.state()
                found.any[now].add(following)
                ends.append(following)
                now = following
                found.longest += 1
            following = found.state()
            for s in ends:
                found.free[s].add(following)
            now = following
        else:
            for word in words(token.encode()):
                following = found.state()
                found.steps[now][word] = following
                now = following
                found.longest += 1
                if not opened and runs[-1][0] + len(runs[-1][1]) == found.longest - 1:
                    runs[-1][1].append(word)
                elif not opened:
                    runs.append((found.longest - 1, [word]))
            continue
        runs.append((found.longest, []))
    if opened:
        raise ValueError("a region is not closed")
    # What may stand before the anchor bounds where a match can begin.
    found.before, found.anchor = max(runs, key=lambda r: len(r[1]))
    if not found.anchor:
        raise ValueError("a template needs mandatory words")
    return found


def places(text: list[bytes], joined: bytes, phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand one after the other; ``joined`` is the text's words between blanks."""
    if b" " + b" ".join(phrase) + b" " not in joined:
        return []
    first, n = phrase[0], len(phrase)
    found, at = [], -1
    while True:
        try:
            at = text.index(first, at + 1)
        except ValueError:
            return found
        if text[at:at + n] == phrase:
            found.append(at)


def matches(text: list[bytes], joined: bytes, automaton: Automaton) -> list[tuple[int, int]]:
    """First and last word of every accepted stretch that lies in no longer one."""
    found: list[tuple[int, int]] = []
    for place in places(text, joined, automaton.anchor):
        for start in range(max(0, place - automaton.before), place + 1):
            end = automaton.end(text, start)
            if end is not None and end > place:
                if not found or end - 1 > found[-1][1]:
                    found.append((start, end - 1))
                break
    return found


@dataclass(frozen=True)
class Scan:
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float


def scan_text(text: bytes, phrases, templates) -> Scan:
    own = words(text)
    joined = b" " + b" ".join(own) + b" "
    starts, base, covered = [], set(), set()
    for phrase, label in phrases:
        at = places(own, joined, phrase)
        if at:
            starts += at
            base.add(label)
            covered.update(i for p in at for i in range(p, p + len(phrase)))
    labels = set(base)
    for label, automaton in templates:
        spans = matches(own, joined, automaton)
        if spans:
            labels.add(label)
            covered.update(i for a, b in spans for i in range(a, b + 1))
    return Scan(len(own), len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), len(covered) / len(own) if own else 0.0)


FIELDS = (("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"),
          ("base_labels", "string"), ("labels", "string"), ("score", "double"))


def scan(docs: DataFrame, keys: list[str], text: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """The ``keys`` of every row with what its whole text holds.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: number of places of the
    phrases and the smallest and largest first word (null if none); ``base_labels``;
    ``labels``: of phrases and templates; ``score``: share of the words inside places
    and accepted stretches. Null is the empty text; no words give a score of zero.
    """
    source = docs.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("_body"))
    own_phrases = [([w for w in words(p.encode())], label) for p, label in phrases]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(label, compile_template(t)) for label, t in templates]
        for batch in small(batches):
            found = [scan_text(t, own_phrases, compiled) for t in as_bytes(batch, "_body")]
            kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys),
                 *(pa.array([getattr(f, n) for f in found], kinds[kind]) for n, kind in FIELDS)],
                [*keys, *(n for n, _ in FIELDS)])

    schema = source.select(*[F.col(f"`{k}`") for k in keys]).schema
    for name, kind in FIELDS:
        schema = schema.add(name, kind)
    return source.mapInArrow(task, schema)
