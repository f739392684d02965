"""Licence text in documents: fixed phrases, and an exact set-similarity join with templates.

A block is a run of words of one text, across line breaks, and a set of words.  It
matches a template of m words when it has at most m * 100 / percent words (so as
many foreign ones as the threshold lets a template's own words be missing) and
holds the threshold's share of the template's distinct words.  A template may
name deciding words, which a block must hold, and barred words, which it must
not: a short notice differs from another licence's by a name or a version alone,
which the threshold would let be missing.  All template
words stand in one order, rarest first by their count over the whole input.  A
block can only match a template if it holds one of the first
|T| - need + 1 words of it (prefix filter); from the place of its first word in
the order enough of the template is left then (positional filter).  It needs as
many places of template words as the template asks for within its length (length
filter).  What passes is verified with the whole sets.

The templates are the stated query set: their words and order are the only data
that all tasks get, and their size does not depend on the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm import words as W
from tillroll.llm.tables import plain

_U = np.uint64
PERCENT = 80

# Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

@dataclass(frozen=True)
class Notice:
    """A template's text; the words of it that a block must hold, and words that none may hold, because
    they tell its licence from others with nearly the same words."""

    text: str
    deciding: str = ""
    barred: str = ""


# The standard short notices of public licences, by label.
TEMPLATES = {
    "apache-2.0": [Notice("Licensed under the Apache License, Version 2.0", "apache 2")],
    "bsd": [
        Notice("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ],
    "cc-by-nc": [Notice("Licensed under CC BY-NC 4.0", "cc nc", "sa nd")],
    "cc0": [Notice("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work")],
    "gpl-3.0": [Notice("This work is licensed under the GNU General Public License, version 3", "general 3", "lesser library affero")],
    "isc": [Notice("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")],
    "mit": [
        Notice("Released under the MIT License", "mit"),
        Notice("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ],
    "mpl-2.0": [Notice("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla 2")],
    "public-domain": [Notice("This is free and unencumbered software released into the public domain")],
}

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long"


def _names(text: str) -> np.ndarray:
    return W.words_of(pa.array([text], pa.large_string()), fold=True, separators=W.NON_ALNUM).hash


class TemplateIndex:
    """The templates with their words in the global order."""

    def __init__(self, templates: dict[str, list[Notice]], percent: int, counts: dict[int, int]):
        self.templates: list[Template] = []
        vocabulary = {int(h) for notices in templates.values() for t in notices for h in _names(f"{t.text} {t.barred}")}
        self.order = {h: i for i, h in enumerate(sorted(vocabulary, key=lambda h: (counts.get(h, 0), h)))}
        for label, notices in templates.items():
            for notice in notices:
                sequence = _names(notice.text)
                words = sorted({int(h) for h in sequence}, key=self.order.get)
                if not words:
                    continue
                need = -(-percent * len(words) // 100)
                prefix = np.array(sorted(words[: len(words) - need + 1]), dtype=_U)
                deciding, barred = np.unique(_names(notice.deciding)), np.unique(_names(notice.barred))
                held = np.array(sorted(words), dtype=_U)
                if not _among(deciding, held).all() or _among(barred, held).any():
                    raise ValueError(f"{label}: deciding words must be words of the notice, barred words must not")
                self.templates.append(Template(label, held, prefix, need, -(-100 * len(sequence) // percent), deciding, barred))
        self.known = np.array(sorted(vocabulary), dtype=_U)


@dataclass
class Template:
    """words and prefix in the order of their names; a block has at most ``reach`` words and ``need`` of the template's."""

    label: str
    words: np.ndarray
    prefix: np.ndarray
    need: int
    reach: int
    deciding: np.ndarray
    barred: np.ndarray

    def matches(self, place: np.ndarray, name: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, containment) by end of a matching block: the shortest block that ends there, and the
        largest containment of one that does.  From the places and names of template words, and the
        number of the first word of each one's text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(self.barred) and len(place):
            # a block starts behind the last barred word
            behind = np.maximum.accumulate(np.where(_among(name, self.barred), place + 1, 0))
            opens = np.maximum(opens, behind)
        use = _among(name, self.words)
        place, name, opens = place[use], name[use], opens[use]
        # a block holds a word of the prefix
        early = place[_among(name, self.prefix)] if len(name) else place
        if not len(early):
            return none
        after = np.searchsorted(early, place)
        use = place - early[np.maximum(np.searchsorted(early, place, side="right") - 1, 0)]
        use = (use >= 0) & (use < self.reach)
        ahead = early[np.minimum(after, len(early) - 1)] - place
        use |= (ahead >= 0) & (ahead < self.reach)
        place, name, opens = place[use], name[use], opens[use]
        low = np.maximum(place - self.reach + 1, opens)
        # and as many places as the template asks for
        enough = np.flatnonzero(np.arange(len(place)) - np.searchsorted(place, low) + 1 >= self.need)
        if not len(enough):
            return none
        shared = np.zeros(len(enough), dtype=np.int64)
        for h in self.words:
            shared += self._last(place, name, h)[enough] >= low[enough]
        fits = shared >= self.need
        decided = np.full(len(enough), np.iinfo(np.int64).max)
        for h in self.deciding:
            decided = np.minimum(decided, self._last(place, name, h)[enough])
        fits &= decided >= low[enough]
        found = enough[fits]
        if not len(found):
            return none
        latest = np.sort(np.stack([self._last(place, name, h)[found] for h in self.words]), axis=0)
        return np.minimum(latest[-self.need], decided[fits]), place[found], shared[fits] / len(self.words)

    @staticmethod
    def _last(place: np.ndarray, name: np.ndarray, h: int) -> np.ndarray:
        """At each place, the last one so far that has the word."""
        return np.maximum.accumulate(np.where(name == h, place, -1))


def _apart(start: np.ndarray, end: np.ndarray) -> list[int]:
    """From blocks in the order of their ends (and starts): the first one, the first behind it, and so on."""
    got, k = [], 0
    while k < len(start):
        got.append(k)
        k = int(np.searchsorted(start, end[k], side="right"))
    return got


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def scan_licences(docs: DataFrame, templates: dict[str, list[Notice]] | None = None, phrases: dict[str, str] | None = None, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: ``SCHEMA``.

    Reads doc_id and text.  A-Z are folded; words are runs of digits, letters
    and all characters beyond ASCII.  n_base counts the places of the phrases,
    first_word and last_word are the smallest and largest word number at which
    one starts (null without one).  base_labels has the phrases' labels, labels
    also those of the matched templates (distinct, sorted, comma-joined; the
    empty string without any).  n_blocks counts the blocks that match a template,
    for each template from the left without overlap; blocks of several templates
    that overlap count once.
    score is 1 where a phrase stands, else the largest containment among the
    matches, else 0.  Null text counts as empty; repeated rows give a row each;
    a null doc_id stays null; an empty table gives an empty result.  Other
    columns are not read.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    docs = plain(docs, doc_id="long", text="string")
    plainly = TemplateIndex(templates, percent, {}).known

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(plainly), dtype=np.int64)
        for piece in W.pieces(batches):
            names = W.words_of(piece.column("text"), fold=True, separators=W.NON_ALNUM).hash
            at = np.searchsorted(plainly, names[_among(names, plainly)])
            totals += np.bincount(at, minlength=len(plainly))
        yield pa.RecordBatch.from_arrays([pa.array(plainly.view(np.int64)), pa.array(totals)], names=["name", "n"])

    counted = docs.mapInArrow(count, "name long, n long").groupBy("name").agg({"n": "sum"}).collect()  # the templates' words
    index = TemplateIndex(templates, percent, {x[0] % 2**64: x[1] for x in counted})
    sought = [(_names(p), label) for p, label in phrases.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches):
            words = W.words_of(piece.column("text"), fold=True, separators=W.NON_ALNUM)
            names, n_texts = words.hash, piece.num_rows
            base: list[set] = [set() for _ in range(n_texts)]
            n_base = np.zeros(n_texts, dtype=np.int64)
            first = np.full(n_texts, np.iinfo(np.int64).max)
            last = np.full(n_texts, -1)
            for phrase, label in sought:
                at = W.window_starts(words.first, len(phrase))
                for k, h in enumerate(phrase):
                    at = at[names[at + k] == h]
                text = np.searchsorted(words.first, at, side="right") - 1
                n_base += np.bincount(text, minlength=n_texts)
                np.minimum.at(first, text, at - words.first[text])
                np.maximum.at(last, text, at - words.first[text])
                for i in np.unique(text):
                    base[i].add(label)
            more = [set(x) for x in base]
            score = np.where(n_base > 0, 1.0, 0.0)
            place = np.flatnonzero(_among(names, index.known)) if len(names) else np.zeros(0, np.int64)
            opens = words.first[np.searchsorted(words.first, place, side="right") - 1]
            blocks = [np.zeros((0, 2), np.int64)]
            for template in index.templates:
                start, end, share = template.matches(place, names[place], opens)
                text = np.searchsorted(words.first, end, side="right") - 1
                np.maximum.at(score, text, share)
                for i in np.unique(text):
                    more[i].add(template.label)
                pick = _apart(start, end)
                blocks.append(np.stack([start[pick], end[pick]], axis=1))
            block = np.concatenate(blocks)
            block = block[np.lexsort((block[:, 1], block[:, 0]))]
            behind = np.ones(len(block), dtype=bool)
            behind[1:] = block[1:, 0] > np.maximum.accumulate(block[:, 1])[:-1]
            n_blocks = np.bincount(np.searchsorted(words.first, block[behind, 0], side="right") - 1, minlength=n_texts)
            some = n_base > 0
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words.counts), pa.array(n_base), pa.array(first, mask=~some), pa.array(last, mask=~some),
                 pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in more]), pa.array(score), pa.array(n_blocks)],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return docs.mapInArrow(scan, SCHEMA)
