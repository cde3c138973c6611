"""License scans by template markup compiled into token automata.

A template is license wording with two kinds of marked regions: ``[[ ... ]]`` is optional (it may
be there or not, whole) and ``<<name>>`` is replaceable (any one to ``SLOT`` words, such as a year or
a copyright holder). Everything else is mandatory wording, matched word for word. Each template is
compiled once into a token automaton (one consuming move a state, free moves into and around the
optional parts, a chain of any-word moves for a replaceable part). A text matches a template at a
word if some run of the automaton from there reaches the end; runs start only at words that the
template can begin with, looked up in an index of the text's words, so a text is read once and
the automata run only where a license can begin.

Words are runs of ASCII letters and digits and of non-ASCII characters, after A-Z are lower-cased;
punctuation and markup therefore do not take part. The base phrases are compiled the same way (all
mandatory) and counted at every place they stand; the method's own labels are those templates that
match somewhere. ``score`` is, over the templates, the largest share of a template's mandatory words
that one run consumed: 1.0 where a template matched, 0.0 without words.

Rows are handled one by one: null texts are empty (no words, nulls for the places, empty labels,
score 0), repeated rows and ties give equal results, an empty table gives an empty result, and no
other input column is read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.chunks import texts_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Most words a replaceable region stands for.
SLOT = 12

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Public license wording as templates, with the method's own labels.
TEMPLATES = (
    ("mit-text", """[[copyright <<year and holder>>]] permission is hereby granted, free of charge, to any person
     obtaining a copy of this software and associated documentation files (the "software"), to deal in the software
     without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
     sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do
     so, subject to the following conditions: the above copyright notice and this permission notice shall be included
     in all copies or substantial portions of the software."""),
    ("bsd-2-clause", """redistribution and use in source and binary forms, with or without modification, are permitted
     provided that the following conditions are met: [[1.]] redistributions of source code must retain the above
     copyright notice, this list of conditions and the following disclaimer. [[2.]] redistributions in binary form
     must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
     documentation and/or other materials provided with the distribution. this software is provided by <<holder>>
     "as is" and any express or implied warranties"""),
    ("bsd-3-clause", """redistribution and use in source and binary forms, with or without modification, are permitted
     provided that the following conditions are met: [[1.]] redistributions of source code must retain the above
     copyright notice, this list of conditions and the following disclaimer. [[2.]] redistributions in binary form
     must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
     documentation and/or other materials provided with the distribution. [[3.]] neither the name of <<holder>> nor
     the names of its contributors may be used to endorse or promote products derived from this software without
     specific prior written permission."""),
    ("apache-2.0-notice", """licensed under the apache license, version 2.0 (the "license"); you may not use this file
     except in compliance with the license. you may obtain a copy of the license at
     [[http://www.apache.org/licenses/license-2.0]]"""),
    ("gpl-notice", """this <<work>> is free software[[;]] you can redistribute it and/or modify it under the terms of the
     gnu [[lesser]] [[affero]] general public license as published by the free software foundation"""),
    ("isc-text", """permission to use, copy, modify, and/or distribute this software for any purpose with or without
     fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
     copies."""),
)

_MARK = re.compile(r"\[\[|\]\]|<<[^>]*>>")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


class Automaton:
    """A template's token automaton: state 0 starts, ``accept`` ends; one consuming move a state at most."""

    def __init__(self, template: str):
        self.word: list[str | None] = []
        self.any: list[bool] = []
        self.next: list[int] = []
        self.free: list[list[int]] = []
        self.progress: list[int] = []
        items = self._parse(template)
        start = self._state(0)
        self.accept, self.mandatory = self._compile(items, start, 0, True)
        self.closure = [self._close(s) for s in range(len(self.word))]
        self.first = {self.word[s] for s in self.closure[0] if self.word[s] is not None}
        if any(self.any[s] for s in self.closure[0]):
            raise ValueError("a template must not begin with a replaceable region")

    @staticmethod
    def _parse(template: str) -> list:
        stack: list[list] = [[]]
        at = 0
        for mark in _MARK.finditer(template):
            stack[-1].extend(("word", w) for w in words(template[at:mark.start()]))
            at = mark.end()
            if mark.group() == "[[":
                stack.append([])
            elif mark.group() == "]]":
                inner = stack.pop()
                stack[-1].append(("optional", inner))
            else:
                stack[-1].append(("slot", mark.group()[2:-2]))
        stack[-1].extend(("word", w) for w in words(template[at:]))
        if len(stack) != 1:
            raise ValueError("unbalanced optional region")
        return stack[0]

    def _state(self, progress: int) -> int:
        self.word.append(None)
        self.any.append(False)
        self.next.append(-1)
        self.free.append([])
        self.progress.append(progress)
        return len(self.word) - 1

    def _compile(self, items: list, at: int, done: int, counted: bool) -> tuple[int, int]:
        for kind, value in items:
            if kind == "word":
                done += counted
                step = self._state(done)
                self.word[at], self.next[at], at = value, step, step
            elif kind == "slot":
                end = self._state(done)
                for _ in range(SLOT):
                    step = self._state(done)
                    self.any[at], self.next[at] = True, step
                    self.free[step].append(end)
                    at = step
                at = end
            else:
                inner = self._state(done)
                self.free[at].append(inner)
                inner_end, _ = self._compile(value, inner, done, False)
                out = self._state(done)
                self.free[at].append(out)
                self.free[inner_end].append(out)
                at = out
        return at, done

    def _close(self, state: int) -> frozenset[int]:
        seen, todo = {state}, [state]
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def run(self, text_words: list[str], start: int) -> tuple[int | None, int]:
        """``(end, best)``: the word after the shortest match from ``start`` (None if none), most mandatory words read."""
        states = self.closure[0]
        best = 0
        for at in range(start, len(text_words)):
            word = text_words[at]
            moved: set[int] = set()
            for s in states:
                if self.any[s] or self.word[s] == word:
                    moved |= self.closure[self.next[s]]
            if not moved:
                break
            states = moved
            best = max(best, max(self.progress[s] for s in states))
            if self.accept in states:
                return at + 1, best
        return None, best


def _compiled(pairs) -> list[tuple[str, Automaton]]:
    return [(label, Automaton(wording)) for wording, label in pairs]


BASE_AUTOMATA = _compiled(BASE)
OWN_AUTOMATA = _compiled((wording, label) for label, wording in TEMPLATES)


def scan(text: str | None):
    """``(n_words, places, found, score)`` of one text: base places (start, label), template matches (label, start, end)."""
    found_words = words(text)
    starts: dict[str, list[int]] = {}
    anchors = set().union(*(a.first for _, a in BASE_AUTOMATA + OWN_AUTOMATA))
    for at, word in enumerate(found_words):
        if word in anchors:
            starts.setdefault(word, []).append(at)

    def runs(automaton: Automaton) -> Iterator[tuple[int, int | None, int]]:
        for start in sorted(p for w in automaton.first for p in starts.get(w, ())):
            end, best = automaton.run(found_words, start)
            yield start, end, best

    places = [(start, label) for label, a in BASE_AUTOMATA for start, end, _ in runs(a) if end is not None]
    found, score = [], 0.0
    for label, automaton in OWN_AUTOMATA:
        for start, end, best in runs(automaton):
            score = max(score, best / automaton.mandatory)
            if end is not None:
                found.append((label, start, end))
    return len(found_words), sorted(places), found, score


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("places", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("label", T.StringType())]))),
    T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())]))),
    T.StructField("score", T.DoubleType()),
])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, places`` (base), ``found`` (template matches), ``score``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    arrow = pa.schema([
        pa.field("doc_id", pa.int64()), pa.field("n_words", pa.int64()),
        pa.field("places", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
        pa.field("found", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        pa.field("score", pa.float64()),
    ])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [scan(t) for t in texts_of(part.column("_text"))]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([m[0] for m in made], pa.int64()),
                    pa.array([[{"start": s, "label": lb} for s, lb in m[1]] for m in made], arrow.field("places").type),
                    pa.array([[{"label": lb, "start": s, "end": e} for lb, s, e in m[2]] for m in made],
                             arrow.field("found").type),
                    pa.array([m[3] for m in made], pa.float64()),
                ], schema=arrow)

    return rows.mapInArrow(scanned, RESULT)


def summary(scanned: DataFrame) -> DataFrame:
    """The scan as the query reports it: counts, first and last base place, sorted distinct labels, score."""
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    own = F.transform("found", lambda m: m["label"])
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        "score",
    )
