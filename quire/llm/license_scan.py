"""Licence detection: a positional index of licence words, verified by key phrases.

Templates are short public licence texts; a word's weight is its inverse
document frequency over all scanned documents and the templates.  The index
lists, with their positions, a template's highest-weighted words, as many as it
takes for all its other words together to stay below ``min_share``: a place
that reaches the share has one of them.  In each document these words are
looked up; every posting gives an alignment (template, document position minus
template position), and all alignments within ``slack`` of it are scored by the
share of the template's words, weighted, that stand within ``slack`` words of
their place.  A template counts only if its mandatory key phrases stand in the
aligned stretch.  So the result is that of scoring every alignment.

Besides the templates' labels every document gets base labels from three
phrases, wherever their words stand consecutively.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased.  Defined results: null and wordless texts have no words, places or
labels and score 0; repeated rows are scored alike; texts of any length are
scanned whole; an empty table gives an empty result; only ``doc_id`` and ``text``
are looked at.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import textkit as tk

# Phrases and labels of the base scan.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Openings and notices of public licences, with their label and mandatory phrases.
TEMPLATES = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software""",
        ["permission is hereby granted free of charge"],
    ),
    ("mit", "Released under the MIT License.", ["mit license"]),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at""",
        ["apache license version 2 0"],
    ),
    ("apache", "Licensed under the Apache License, Version 2.0.", ["apache license version 2 0"]),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version.""",
        ["general public license", "free software"],
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3.", ["gnu general public license"]),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
        ["redistribution and use in source and binary forms"],
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies.""",
        ["permission to use copy modify", "with or without fee"],
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.""",
        ["mozilla public license"],
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ["cc by nc 4 0"]),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        ["creative commons attribution 4 0"],
    ),
    ("all-rights-reserved", "All rights reserved.", ["all rights reserved"]),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain.",
        ["unencumbered software released into the public domain"],
    ),
]


@dataclass(frozen=True)
class LicenseParams:
    #: words that an aligned word may stand off its place
    slack: int = 3
    #: least weighted share of a template's words in place
    min_share: float = 0.75


PARAMS = LicenseParams()


def _words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return tk.word_hashes(tk.LOWER[raw], np.array([0, len(raw)]), tk.NOT_ALNUM)[0]


class Index:
    """Positional postings of the template words; as large as the templates."""

    def __init__(self, weights: dict[int, float], p: LicenseParams = PARAMS):
        self.p = p
        self.labels = [t[0] for t in TEMPLATES]
        self.texts = [_words(t[1]) for t in TEMPLATES]
        self.keys = [[_words(k) for k in t[2]] for t in TEMPLATES]
        self.vocabulary = np.unique(np.concatenate(self.texts))
        self.weight = np.array([weights.get(int(w), 0.0) for w in self.vocabulary.view(np.int64)])
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.place: list[np.ndarray] = []
        for t, words in enumerate(self.texts):
            at = np.searchsorted(self.vocabulary, words)
            self.place.append(at)
            weight = self.weight[at] + 1e-9
            order = np.argsort(-weight, kind="stable")
            # what the words from each on weigh; posted up to where the rest cannot make the share (less rounding)
            rest = np.cumsum(weight[order][::-1])[::-1]
            for i in order[rest >= p.min_share * weight.sum() * (1 - 1e-9)].tolist():
                self.postings[int(at[i])].append((t, i))
        self.lookups = np.array(sorted(self.postings))
        self.base = [_words(k) for k in BASE_PHRASES]

    def find(self, words: np.ndarray) -> np.ndarray:
        """Place in the vocabulary of each word, -1 for others."""
        k = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[k] == words, k, -1)

    def base_places(self, words: np.ndarray) -> list[np.ndarray]:
        """Start positions of each base phrase."""
        return [_places(words, phrase) for phrase in self.base]

    def templates(self, words: np.ndarray, found: np.ndarray) -> dict[int, tuple[float, int]]:
        """Template -> (best share, first word of the best place) of one document."""
        slack = self.p.slack
        seen: dict[int, list[np.ndarray]] = defaultdict(list)
        looked_up = np.flatnonzero(np.isin(found, self.lookups))
        for k in np.unique(found[looked_up]).tolist():
            here = looked_up[found[looked_up] == k]
            for t, at in self.postings[k]:
                seen[t].append(here - at)
        best: dict[int, tuple[float, int]] = {}
        for t, offs in seen.items():
            # a word may be missing or added: every place that has the looked-up word within slack
            offs = np.unique(np.unique(np.concatenate(offs))[:, None] + np.arange(-slack, slack + 1))
            share, exact = self._shares(t, offs, found)
            good = np.flatnonzero(share >= self.p.min_share)
            for i in good[np.lexsort((offs[good], -exact[good], -share[good]))].tolist():
                if self._has_keys(t, int(offs[i]), words):
                    best[t] = (float(share[i]), max(0, int(offs[i])))
                    break
        return best

    def _shares(self, t: int, offs: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weighted share of a template's words within slack of their place, and exactly there, by place."""
        at, slack = self.place[t], self.p.slack
        weight = self.weight[at] + 1e-9
        pad = len(at) + 2 * slack
        padded = np.concatenate((np.full(pad, -1), found, np.full(pad, -1)))
        share, exact = np.zeros(len(offs)), np.zeros(len(offs))
        for i in range(0, len(offs), 4096):
            where = offs[i : i + 4096, None] + np.arange(len(at)) + pad
            there = padded[where] == at
            exact[i : i + 4096] = (there * weight).sum(axis=1)
            for d in range(1, slack + 1):
                there |= (padded[where - d] == at) | (padded[where + d] == at)
            share[i : i + 4096] = (there * weight).sum(axis=1) / weight.sum()
        return share, exact

    def _has_keys(self, t: int, off: int, words: np.ndarray) -> bool:
        slack = self.p.slack
        there = words[max(0, off - slack) : off + len(self.texts[t]) + slack]
        return all(len(_places(there, k)) for k in self.keys[t])


def _places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = words[:n] == phrase[0]
    for k in range(1, len(phrase)):
        hit &= words[k : n + k] == phrase[k]
    return np.flatnonzero(hit)


def _frequency_batches(vocabulary: np.ndarray):
    """Documents that hold each licence word, one row per word and chunk; word 0 counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for lo, hi, buf, starts in tk.chunks(batch.column(0)):
                words, first = tk.word_hashes(tk.LOWER[buf], starts, tk.NOT_ALNUM)
                k = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[k] == words)
                doc = np.searchsorted(first, hit, side="right") - 1
                pairs = np.unique(doc * len(vocabulary) + k[hit])
                seen += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
                total += hi - lo
        words = np.concatenate(([0], vocabulary.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.concatenate(([total], seen)))], names=["word", "n"])

    return run


def word_weights(docs: DataFrame) -> dict[int, float]:
    """Inverse document frequency of every template word over all documents and the templates."""
    vocabulary = np.unique(np.concatenate([_words(t[1]) for t in TEMPLATES]))
    counts = docs.select(F.col("text").cast("string")).mapInArrow(_frequency_batches(vocabulary), "word long, n long")
    # one row per template word
    rows = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = rows.pop(0, 0) + len(TEMPLATES)
    in_templates = defaultdict(int)
    for t in TEMPLATES:
        for w in set(_words(t[1]).view(np.int64).tolist()):
            in_templates[w] += 1
    return {w: math.log((1 + total) / (1 + rows.get(w, 0) + in_templates[w])) for w in in_templates}


def _scan_batches(index: Index):
    base_labels = list(BASE_PHRASES.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64()), ("word", pa.int64())]))
        for batch in batches:
            for lo, hi, buf, starts in tk.chunks(batch.column(1)):
                words, first = tk.word_hashes(tk.LOWER[buf], starts, tk.NOT_ALNUM)
                found = index.find(words)
                count = np.diff(first)
                out = {k: [] for k in ("n_base", "first_word", "last_word", "base", "labels", "score", "matches")}
                known = np.concatenate(([0], np.cumsum(found >= 0)))
                for d in range(hi - lo):
                    a, b = int(first[d]), int(first[d + 1])
                    base, at, best = set(), [], {}
                    if known[b] > known[a]:
                        for label, places in zip(base_labels, index.base_places(words[a:b]), strict=True):
                            if len(places):
                                base.add(label)
                                at += places.tolist()
                        best = index.templates(words[a:b], found[a:b])
                    labels = base | {index.labels[t] for t in best}
                    score = max([share for share, _ in best.values()], default=0.0)
                    out["n_base"].append(len(at))
                    out["first_word"].append(min(at) if at else None)
                    out["last_word"].append(max(at) if at else None)
                    out["base"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(labels)))
                    out["score"].append(max(min(1.0, score), 0.5 if base else 0.0))
                    out["matches"].append(
                        [{"label": index.labels[t], "share": s, "word": w} for t, (s, w) in sorted(best.items())]
                    )
                kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(), kind]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(count),
                        *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)],
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"],
                )

    return run


def scan(docs: DataFrame, p: LicenseParams = PARAMS) -> DataFrame:
    """Words, base places, labels, score and template matches of every row."""
    index = Index(word_weights(docs), p)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _scan_batches(index),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, matches array<struct<label:string,share:double,word:long>>",
    )
