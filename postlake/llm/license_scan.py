"""License scan: exact set-similarity join of text blocks and license templates, and stated phrases.

Blocks are the lines of a text and, for templates of many words, its paragraphs (runs of lines with words). A template
is found in a block that holds at least ``CONTAINMENT`` of its distinct words. The join is exact: template words are
ordered by their frequency over all texts, rarest first; a block must hold one of the first ``size - needed + 1`` words
(prefix filter), must have ``needed`` words at all (length filter), and the words still to come on both sides, counted
from the match on, must suffice (positional filter). What passes is compared as sets of words.

With ``wrapped``, as the query has it, templates of few words are also found across the lines of a paragraph, in any
window of about as many words as the template has. A template whose words all belong to another template found in the
same block gives way to it only if, in each of its places, at least half of its words support the other one.

The templates are a fixed list, so their few hundred words travel to the tasks; texts are not shuffled.

Defined results: a null or empty text has no words and no labels, score 0. Repeated rows and null ids keep their rows.
An empty table gives no rows; without templates only the stated phrases count. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.tables import table, with_columns
from postlake.llm.words import ALPHANUMERIC, Words, words_of

CONTAINMENT = 0.95
LONG_TEMPLATE = 20  # distinct words from which paragraphs are blocks too

#: The stated phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices of public licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
                 "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "Licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
              "option) any later version."),
    ("lgpl-3", "Licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3", "Licensed under the GNU Affero General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def spelled(texts: list[str]) -> list[list[bytes]]:
    """Words of each text."""
    out = []
    for words in words_of(pa.array(texts, pa.string()), ALPHANUMERIC, lower=True):
        every = [words.word(i) for i in range(len(words.hashes))]
        out += [every[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    return out


def hashed(words: list[bytes]) -> np.ndarray:
    return np.concatenate([w.hashes for w in words_of(pa.array(words, pa.binary()).cast(pa.string()), ALPHANUMERIC, True)])


class Vocabulary:
    """Words of the templates and phrases, found in chunks of texts by hash and confirmed by spelling."""

    def __init__(self, words: set[bytes]) -> None:
        ordered = sorted(words)
        hashes = hashed(ordered) if ordered else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.words = [ordered[i] for i in order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.hashes >> np.uint64(48)] = True

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of vocabulary words and which they are."""
        at = np.flatnonzero(self.seen[words.hashes >> np.uint64(48)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.hashes, words.hashes[at]), len(self.hashes) - 1)
        same = self.hashes[which] == words.hashes[at]
        return at[same], which[same]


def frequencies(docs: DataFrame, vocabulary: Vocabulary) -> dict[bytes, int]:
    """Occurrences over all texts of each vocabulary word; tasks count first, one row for each word is returned."""

    def count(batches):
        total = np.zeros(len(vocabulary.words), np.int64)
        for batch in batches:
            for words in words_of(batch.column(0), ALPHANUMERIC, lower=True):
                total += np.bincount(vocabulary.find(words)[1], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {vocabulary.words[r.word]: r.n for r in rows}


class Templates:
    """Templates with their words in the global order, listed under the words of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], containment: float) -> None:
        self.labels = [label for label, _ in templates]
        listed = spelled([text for _, text in templates])
        self.sets = [set(words) for words in listed]
        self.reach = [len(words) + max(2, len(words) // 4) for words in listed]  # words of a window
        self.needed = [max(1, math.ceil(containment * len(s) - 1e-9)) for s in self.sets]
        self.long = [len(s) >= LONG_TEMPLATE for s in self.sets]
        every = sorted({w for s in self.sets for w in s}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(every)}
        self.prefix = defaultdict(list)  # word to (template, its place in the template)
        for t, words in enumerate(self.sets):
            ordered = sorted(words, key=self.rank.__getitem__)
            for place, word in enumerate(ordered[: len(ordered) - self.needed[t] + 1]):
                self.prefix[word].append((t, place))

    def candidates(self, block: list[bytes], long_only: bool) -> list[tuple[int, float]]:
        """Templates found in the template words of a block, with their containment."""
        words = sorted(set(block), key=self.rank.__getitem__)
        seen, out = set(), []
        for at, word in enumerate(words):
            for t, place in self.prefix.get(word, ()):
                if t in seen or (long_only and not self.long[t]) or len(words) < self.needed[t]:
                    continue
                # words before this one hold no prefix word of the template, so the overlap starts here
                if 1 + min(len(self.sets[t]) - place - 1, len(words) - at - 1) < self.needed[t]:
                    continue
                seen.add(t)
                shared = len(self.sets[t].intersection(words))
                if shared >= self.needed[t]:
                    out.append((t, shared / len(self.sets[t])))
        return out

    def match(self, block: list[bytes], paragraph: bool) -> list[tuple[int, float]]:
        """Templates found in a line or, if long, a paragraph; one within another gives way."""
        out = self.candidates(block, paragraph)
        names = [t for t, _ in out]
        return [(t, share) for t, share in out if not any(self.sets[t] < self.sets[u] for u in names)]

    def match_wrapped(self, block: list[bytes], at: list[int], paragraph: bool) -> list[tuple[int, float]]:
        """Templates found in a block, short ones of a paragraph in windows of words; ``at`` has the places of words."""
        found = {}
        for t, share in self.candidates(block, False):
            limit = self.reach[t] if paragraph and not self.long[t] else None
            most, windows = self.windows(t, block, at, limit)
            if windows:
                found[t] = (share if limit is None else most / len(self.sets[t]), windows)
        out = []
        for t, (share, windows) in found.items():
            around = [u for u in found if self.sets[t] < self.sets[u]]
            taken = set().union(*[self.support(block, found[u][1], self.sets[u] - self.sets[t]) for u in around])
            own = (len({block[i] for i in w if i not in taken}) for w in windows)
            if not taken or any(2 * n > len(self.sets[t]) for n in own):
                out.append((t, share))
        return out

    def windows(self, t: int, block: list[bytes], at: list[int], limit: int | None) -> tuple[int, list[list[int]]]:
        """The most words of a template within ``limit`` words of text, and its shortest windows with enough of them."""
        use = [i for i, w in enumerate(block) if w in self.sets[t]]
        most, out = 0, []
        for shrink in (False, True):
            counts, low = defaultdict(int), 0
            for high, i in enumerate(use):
                counts[block[i]] += 1
                while limit is not None and at[i] - at[use[low]] >= limit:
                    low = self._drop(counts, block[use[low]], low)
                most = max(most, len(counts))
                if not shrink or len(counts) < self.needed[t]:
                    continue
                while counts[block[use[low]]] > 1 or len(counts) > self.needed[t]:
                    low = self._drop(counts, block[use[low]], low)
                out.append(use[low : high + 1])
                low = self._drop(counts, block[use[low]], low)
        return most, out

    @staticmethod
    def _drop(counts: dict[bytes, int], word: bytes, low: int) -> int:
        counts[word] -= 1
        if not counts[word]:
            del counts[word]
        return low + 1

    def support(self, block: list[bytes], windows: list[list[int]], telling: set[bytes]) -> set[int]:
        """Places of the words that a template stands on: of each window, closest first, those nearest to a telling word."""
        chosen = []
        for window in windows:
            told = [i for i in window if block[i] in telling] or window
            middle = min(told, key=lambda i: self.rank[block[i]])
            nearest: dict[bytes, int] = {}
            for i in sorted(window, key=lambda i: abs(i - middle)):
                nearest.setdefault(block[i], i)
            chosen.append((sum(abs(i - middle) for i in nearest.values()), window[0], nearest.values()))
        taken: set[int] = set()
        for _, _, places in sorted(chosen, key=lambda c: c[:2]):
            if taken.isdisjoint(places):
                taken.update(places)
        return taken


def scan(column: pa.Array, vocabulary: Vocabulary, templates: Templates, wrapped: bool = False) -> list[pa.Array]:
    """``FIELDS`` for each text."""
    phrases = [(spelled([p])[0], label) for p, label in PHRASES.items()]
    parts = [[] for _ in range(7)]
    for words in words_of(column, ALPHANUMERIC, lower=True):
        places: list[list[int]] = [[] for _ in range(words.rows)]
        base: list[set[str]] = [set() for _ in range(words.rows)]
        found: list[dict[int, float]] = [{} for _ in range(words.rows)]
        at, which = vocabulary.find(words)
        row = np.searchsorted(words.first, at, side="right") - 1
        _phrases(words, at, which, row, vocabulary, phrases, places, base)
        for t, r, share in _templates(words, at, which, row, vocabulary, templates, wrapped):
            found[r][t] = max(share, found[r].get(t, 0.0))
        parts[0] += words.counts.tolist()
        for p, b, f in zip(places, base, found):
            parts[1].append(len(p))
            parts[2].append(min(p) if p else None)
            parts[3].append(max(p) if p else None)
            parts[4].append(",".join(sorted(b)))
            parts[5].append(",".join(sorted(b | {templates.labels[t] for t in f})))
            parts[6].append(1.0 if b else max(f.values(), default=0.0))
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    return [pa.array(p, t) for p, t in zip(parts, types)]


def _phrases(words: Words, at, which, row, vocabulary: Vocabulary, phrases, places, base) -> None:
    for phrase, label in phrases:
        first = vocabulary.words.index(phrase[-1])  # the last word is the rarer one
        hit = which == first
        for end, r in zip(at[hit].tolist(), row[hit].tolist()):
            start = end - len(phrase) + 1
            if start >= words.first[r] and all(words.word(start + k) == w for k, w in enumerate(phrase)):
                places[r].append(start - int(words.first[r]))
                base[r].add(label)


def _templates(words: Words, at, which, row, vocabulary: Vocabulary, templates: Templates, wrapped: bool):
    """(template, text, containment) for each block with a prefix word."""
    prefix = np.array([w in templates.prefix for w in vocabulary.words] or [False])
    known = np.array([w in templates.rank for w in vocabulary.words] or [False])
    use = known[which] if len(which) else np.zeros(0, bool)
    at, which, row = at[use], which[use], row[use]
    breaks = np.flatnonzero(words.raw == 0x0A)
    line = np.searchsorted(breaks, words.starts[at]) if len(at) else at
    filled = np.unique(np.searchsorted(breaks, words.starts))  # lines with words, by number
    place = np.searchsorted(filled, line)
    gap = np.concatenate([[0], np.cumsum(np.diff(filled) > 1)]) if len(filled) else filled
    paragraph = gap[place] if len(at) else line
    for kind, group in ((False, line), (True, paragraph)):
        key = row * (len(breaks) + 2) + group
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else key
        starts = prefix[which]
        counts = np.add.reduceat(starts.astype(int), edges[:-1]) if len(key) else key
        for a, b in zip(edges[:-1][counts > 0].tolist() if len(key) else [], edges[1:][counts > 0].tolist() if len(key) else []):
            places = at[a:b].tolist()
            block = [words.word(i) for i in places]  # all of them words of templates
            for t, share in templates.match_wrapped(block, places, kind) if wrapped else templates.match(block, kind):
                yield t, int(row[a]), share


def scanned(
    docs: DataFrame, keep: list[str], templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    every = {w for words in spelled([*PHRASES, *[text for _, text in templates]]) for w in words}
    vocabulary = Vocabulary(every)
    ordered = Templates(templates, frequencies(docs, vocabulary), containment)
    return with_columns(docs, "text", lambda column: scan(column, vocabulary, ordered, wrapped=True), FIELDS, keep)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words, places of stated phrases, labels, score."""
    return scanned(table(spark, sf_dir, "documents"), ["doc_id"])
