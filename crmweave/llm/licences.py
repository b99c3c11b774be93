"""Licence scans: matching statistics against a generalised suffix automaton of licence texts, chained into spans.

Each text streams through the automaton of all templates. Matches that cannot be extended and have MIN_MATCH words or
more are chained where they stand in the same order and near each other (GAP) in the text and in one template. The
share of the template's words that a chain covers is its coverage; from COVERAGE on, the template's label is given. A
template's best chain is taken, then the best one of the words left, and so on, so each place of a notice has its span. Base phrases are found at all places, with their own labels.

Nulls and empty texts have no words, no labels and score 0. Repeated rows are rows of their own. Extra columns pass
through; the added column gets a free name. Of chains of equal cover the first is taken. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from crmweave.llm.automaton import SuffixAutomaton, Vocabulary, known_runs
from crmweave.llm.text import ALNUM, LOWER, Piece, annotated, lists_of, pieces, struct_of

MIN_MATCH, GAP, COVERAGE = 4, 6, 0.6

# Phrases whose every place is reported, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public notices of well-known licences, with the labels this scan gives them.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
     "later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

SCAN = StructType(
    [
        StructField("n_words", LongType()), StructField("n_base", LongType()), StructField("first_word", LongType()),
        StructField("last_word", LongType()), StructField("base_labels", StringType()), StructField("labels", StringType()),
        StructField("score", DoubleType()), StructField("from_", ArrayType(LongType())), StructField("to_", ArrayType(LongType())),
        StructField("label", ArrayType(StringType())),
    ]
)


def word_hashes(text: str) -> np.ndarray:
    return next(pieces(pa.array([text]))).words(ALNUM, LOWER).hashes()


class Templates:
    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, base: Mapping[str, str] = BASE):
        hashed = [word_hashes(t) for _, t in templates]
        phrases = [word_hashes(p) for p in base]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(h) for h in hashed]
        self.vocabulary = Vocabulary(np.concatenate([*hashed, *phrases]))
        made = self.automaton = SuffixAutomaton([self.vocabulary.ids(h).tolist() for h in [*hashed, *phrases]])
        # Where each state's strings end in the templates, and the base phrases that end with them.
        self.places: list[list[tuple[int, int]]] = [[] for _ in made.go]
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in made.go]
        for t, path in enumerate(made.ends[: len(templates)]):
            for end, state in enumerate(path, 1):
                self.places[state].append((t, end))
        for (_, label), path in zip(base.items(), made.ends[len(templates) :], strict=True):
            self.phrases[path[-1]].append((len(path), label))
        order = made.shorter_first().tolist()
        for state in reversed(order[1:]):
            self.places[made.link[state]].extend(self.places[state])
        for state in order[1:]:
            self.phrases[state] = [*self.phrases[made.link[state]], *self.phrases[state]]
        self.least = min(MIN_MATCH, *(len(p) for p in phrases))

    def scan(self, ids: list[int], shift: int, base: list, matches: list) -> None:
        """Append base places (start, label) and long matches (template, its start, start in the text, words)."""
        before = (0, 0)
        for i, now in enumerate([*self.automaton.stream(ids), (0, 0)], 1):
            state, length = before
            if now[1] <= length and length >= MIN_MATCH:  # it could not be extended
                matches.extend((t, end - length, shift + i - 1 - length, length) for t, end in self.places[state])
            for size, label in self.phrases[now[0]]:
                if size <= now[1]:
                    base.append((shift + i - size, label))
            before = now

    def best_chains(self, own: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The chains of most cover among sorted matches (start in text, in template, words) of one template, apart from
        each other: (covered, first word, end)."""
        best: list[tuple[int, int, int, int]] = []  # covered, first word, end in text, end in template
        for d, s, n in own:
            covered, start = n, d
            for c, first, d_end, s_end in reversed(best):
                if d - d_end > GAP + max(self.sizes):
                    break
                if 0 <= d - d_end <= GAP and 0 <= s - s_end <= GAP and c + n > covered:
                    covered, start = c + n, first
            best.append((covered, start, d + n, s + n))
        most = max(c for c, *_ in best)
        out: list[tuple[int, int, int]] = []
        for start, end in sorted((start, end) for c, start, end, _ in best if c == most):
            if not out or start >= out[-1][2]:
                out.append((most, start, end))
        return out

    def chains(self, matches: list) -> list[tuple[int, int, int, float]]:
        """Chains of each template that reach COVERAGE, apart from each other: (template, first word, end, coverage)."""
        out = []
        for template in sorted({m[0] for m in matches}):
            size, found = self.sizes[template], []
            own = sorted((d, s, n) for t, s, d, n in set(matches) if t == template)
            while own and (best := self.best_chains(own))[0][0] / size >= COVERAGE:
                found.extend((template, start, end, covered / size) for covered, start, end in best)
                own = without(own, [(start, end) for _, start, end in best])
            out.extend(sorted(found))
        return out


def without(own: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The sorted matches less the words of the taken spans, which ascend; what stays of a match has MIN_MATCH words or more."""
    ends, out = [end for _, end in taken], set()
    for d, s, n in own:
        at, to = d, d + n
        k = bisect_right(ends, d)
        while k < len(taken) and taken[k][0] < to:
            a, b = taken[k]
            k += 1
            if a - at >= MIN_MATCH:
                out.add((at, s + at - d, a - at))
            at = b
        if to - at >= MIN_MATCH:
            out.add((at, s + at - d, to - at))
    return sorted(out)


def scanned_in(piece: Piece, templates: Templates) -> pa.Array:
    words = piece.words(ALNUM, LOWER)
    n = len(piece)
    ids = templates.vocabulary.ids(words.hashes())
    a, b = known_runs(ids, words.of, templates.least)
    doc = np.searchsorted(words.of, a, "right") - 1
    base: dict[int, list] = {}
    matches: dict[int, list] = {}
    for i, start, end in zip(doc.tolist(), a.tolist(), b.tolist(), strict=True):
        templates.scan(ids[start:end].tolist(), start - int(words.of[i]), base.setdefault(i, []), matches.setdefault(i, []))
    n_base, score = np.zeros(n, np.int64), np.zeros(n)
    first: list = [None] * n
    last: list = [None] * n
    base_labels, labels = [""] * n, [""] * n
    spans: list[list] = [[] for _ in range(n)]
    for i, found in base.items():
        if found:
            n_base[i], score[i] = len(found), 1.0
            first[i], last[i] = min(x for x, _ in found), max(x for x, _ in found)
            base_labels[i] = ",".join(sorted({x for _, x in found}))
        good = templates.chains(matches[i])
        spans[i] = [(start, end, templates.labels[t]) for t, start, end, _ in good]
        score[i] = max([score[i], *(c[3] for c in good)])
        labels[i] = ",".join(sorted({x for _, x in found} | {x for _, _, x in spans[i]}))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
    flat = [x for s in spans for x in s]
    return struct_of(
        SCAN, n_words=words.counts.astype(np.int64), n_base=n_base, first_word=first, last_word=last, base_labels=base_labels,
        labels=labels, score=np.minimum(score, 1.0), from_=lists_of(np.array([x[0] for x in flat], np.int64), bounds),
        to_=lists_of(np.array([x[1] for x in flat], np.int64), bounds), label=lists_of(pa.array([x[2] for x in flat], pa.string()), bounds),
    )


def scan(docs: DataFrame, text: str = "text", templates: Templates | None = None) -> tuple[DataFrame, str]:
    """The frame with a struct column of the findings (its name is returned too). Templates are part of the program's
    text and so of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(templates or Templates())
    return annotated(docs, text, "licences", SCAN, lambda piece: scanned_in(piece, shared.value))


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, counts, labels, score and the covered spans of every row."""
    found, c = scan(docs.select(key, text), text)
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return found.select(
        key, *(F.col(c)[x].alias(x) for x in names), F.col(c)["from_"].alias("span_from"), F.col(c)["to_"].alias("span_to"),
        F.col(c)["label"].alias("span_label"),
    )
