"""Licence scans by a positional index of licence texts that is looked up by each file's rarest licence words."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffcast.llm.common import ALPHANUMERIC, LOWER, Vocabulary, chunks, read_table, word_spans

RARE_WORDS = 8  # licence words of a file that look a template up
SLOP = 8  # words by which a filled-in name or year may move what follows
LEAST_SHARE = 0.8  # of a template's weight that must stand at its places
LEAST_SEEN = 0.5  # a template with less of its weight anywhere in a file is not aligned


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]  # each must stand in the file as it is


# Phrases and labels of the base scan.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Public licence notices as their authors publish them for use in files.
TEMPLATES = (
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
        "ANY KIND, either express or implied.",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        ("gnu lesser general public license", "free software foundation"),
    ),
    Template(
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ("gnu affero general public license", "free software foundation"),
    ),
    Template(
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        ("mozilla public license", "source code form"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
        ("redistribution and use in source and binary forms", "must retain the above copyright notice"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions",
        ("including commercial applications", "redistribute it freely"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
        ("free and unencumbered software", "public domain"),
    ),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template(
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("creative commons attribution sharealike",),
    ),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
)

PLACES = "array<struct<label string, start long, end long, share double, kind string>>"


def _words(text: str) -> list[bytes]:
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())


def runs_of(terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the numbers ``wanted`` stand one after the other in ``terms``."""
    last = len(terms) - len(wanted) + 1
    if last <= 0 or not len(wanted):
        return np.zeros(0, np.int64)
    at = np.flatnonzero(terms[:last] == wanted[0])
    for offset in range(1, len(wanted)):
        at = at[terms[at + offset] == wanted[offset]]
    return at


class LicenseIndex:
    """Positional postings of all templates, and the words of their phrases as numbers of one vocabulary."""

    def __init__(self, templates: Sequence[Template], phrases: Sequence[tuple[str, str]]):
        parts = [t.text for t in templates] + [p for t in templates for p in t.phrases] + [p for p, _ in phrases]
        self.vocabulary = Vocabulary([w for part in parts for w in _words(part)])
        numbers = lambda text: np.array([self.vocabulary.number(w) for w in _words(text)], np.int32)
        self.labels = [t.label for t in templates]
        self.texts = [numbers(t.text) for t in templates]
        self.keys = [[numbers(p) for p in t.phrases] for t in templates]
        self.phrases = [(numbers(p), label) for p, label in phrases]
        size = len(self.vocabulary.words)
        # How often each template holds each word.
        self.held = np.array([np.bincount(t, minlength=size) for t in self.texts]).reshape(len(self.texts), size)

    def terms(self, at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vocabulary number of each word of a piece (-1 for others), and each document's first word."""
        raw = LOWER[raw]
        starts, ends, first = word_spans(at, raw, ALPHANUMERIC)
        return self.vocabulary.find(raw, starts, ends), first

    def likely(self, terms: np.ndarray, first: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, template) pairs where the document holds enough of the template's weight to be worth aligning."""
        known = np.flatnonzero(terms >= 0)
        if not len(known) or not len(self.texts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        document = np.searchsorted(first, known, "right") - 1
        size = len(self.vocabulary.words)
        pairs = np.unique(document * size + terms[known])
        document, term = np.divmod(pairs, size)
        heads = np.flatnonzero(np.diff(document, prepend=-1))
        weight = self.held * idf
        found = []
        for k, total in enumerate(weight.sum(1)):
            seen = np.add.reduceat(weight[k][term], heads)
            found += [(d, k) for d in document[heads[seen >= LEAST_SEEN * total]].tolist() if total > 0]
        return tuple(np.array(x, np.int64) for x in zip(*sorted(found), strict=True)) if found else (np.zeros(0, np.int64),) * 2

    def align(self, terms: np.ndarray, k: int, idf: np.ndarray) -> list[tuple[int, int, float]]:
        """(start, end, share) where template ``k`` stands in a document, the best of those that overlap.

        The document's rarest words of the template give pairs of a place in the document and one in the template; their
        difference is where the template would begin. Differences that enough of these words share, within the slop, are
        places to look at: there, the share of the template's weight counts whose words stand where they should.
        """
        text, size = self.texts[k], len(self.texts[k])
        slop = max(1, min(SLOP, size // 2))
        own = np.intersect1d(terms, text)
        own = own[own >= 0]
        rare = own[np.lexsort((own, -idf[own]))][:RARE_WORDS]
        begins, voters = [], []
        for word in rare.tolist():
            starts = (np.flatnonzero(terms == word)[:, None] - np.flatnonzero(text == word)[None, :]).ravel()
            begins.append(starts)
            voters.append(np.full(len(starts), word))
        if not begins:
            return []
        begin, voter = np.concatenate(begins), np.concatenate(voters)
        # Bands two slops wide that overlap by one: near differences share a band.
        band = np.floor_divide(begin, slop)
        votes = np.unique(np.concatenate([np.stack([band, voter]), np.stack([band - 1, voter])], axis=1), axis=1)
        heads = np.flatnonzero(np.diff(votes[0], prepend=votes[0][0] - 1))
        enough = np.add.reduceat(idf[votes[1]], heads) >= LEAST_SEEN * idf[rare].sum()
        weight = idf[text]
        places: list[tuple[int, int, float]] = []
        for low in (votes[0][heads[enough]] * slop).tolist():
            moves = np.arange(low, low + 2 * slop)
            where = moves[:, None] + np.arange(size)[None, :]
            inside = (where >= 0) & (where < len(terms))
            meets = inside & (terms[np.where(inside, where, 0)] == text[None, :])
            hit = meets.any(0)
            share = float(weight[hit].sum() / weight.sum())
            if not hit.any():
                continue
            # Of several places a word counts where it is nearest to the move that most of the weight shares.
            moved = np.abs(moves - moves[int((meets * weight).sum(1).argmax())])
            nearest = np.where(meets, moved[:, None], 4 * slop).argmin(0)
            stand = where[nearest, np.arange(size)][hit]
            place = (int(stand.min()), int(stand.max()) + 1, share)
            if places and place[0] < places[-1][1]:
                places[-1] = max(places[-1], place, key=lambda p: (p[2], -p[0]))
            else:
                places.append(place)
        return places

    def verified(self, terms: np.ndarray, k: int, start: int, end: int) -> bool:
        """True if all mandatory phrases stand in the stretch."""
        stretch = terms[max(0, start - SLOP) : end + SLOP]
        return all(len(runs_of(stretch, key)) for key in self.keys[k])

    def scan(self, terms: np.ndarray, first: np.ndarray, idf: np.ndarray) -> list[list[tuple[str, int, int, float, str]]]:
        """(label, start, end, share, kind) of all places in each document: phrase, template or near."""
        out: list[list] = [[] for _ in range(len(first) - 1)]
        for words, label in self.phrases:
            at = runs_of(terms, words)
            document = np.searchsorted(first, at, "right") - 1
            whole = at + len(words) <= first[document + 1]
            for d, place in zip(document[whole].tolist(), (at - first[document])[whole].tolist(), strict=True):
                out[d].append((label, place, place + len(words), 1.0, "phrase"))
        for d, k in zip(*self.likely(terms, first, idf), strict=True):
            own = terms[first[d] : first[d + 1]]
            for start, end, share in self.align(own, k, idf):
                fits = share >= LEAST_SHARE and self.verified(own, k, start, end)
                out[d].append((self.labels[k], start, end, share, "template" if fits else "near"))
        for places in out:
            places.sort(key=lambda p: (p[1], p[2], p[0], p[4]))
        return out


def _frequencies(batches: Iterator[pa.RecordBatch], index: LicenseIndex) -> Iterator[pa.RecordBatch]:
    """How many of a task's documents hold each licence word; number -1 counts all documents."""
    size = len(index.vocabulary.words)
    total = np.zeros(size + 1, np.int64)
    for batch in batches:
        for first_row, end_row, at, raw in chunks(batch.column("text")):
            terms, first = index.terms(at, raw)
            known = np.flatnonzero(terms >= 0)
            pairs = np.unique((np.searchsorted(first, known, "right") - 1) * size + terms[known])
            total[:-1] += np.bincount(pairs % size, minlength=size) if size else 0
            total[-1] += end_row - first_row
    if total[-1]:
        yield pa.RecordBatch.from_arrays([pa.array([*range(size), -1], pa.int32()), pa.array(total)], names=["term", "n"])


def _scan(batches: Iterator[pa.RecordBatch], index: LicenseIndex, idf: np.ndarray, fields: list[pa.Field]) -> Iterator[pa.RecordBatch]:
    names = ["label", "start", "end", "share", "kind"]
    for batch in batches:
        for first_row, end_row, at, raw in chunks(batch.column("text")):
            terms, first = index.terms(at, raw)
            places = [[dict(zip(names, p, strict=True)) for p in own] for own in index.scan(terms, first, idf)]
            part = batch.slice(first_row, end_row - first_row)
            columns = [part.column("kept"), pa.array(np.diff(first), pa.int64()), pa.array(places, fields[0].type)]
            yield pa.RecordBatch.from_arrays(columns, names=["kept", "n_words", "places"])


def scan_licenses(
    docs: DataFrame, text_column: str, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """All columns of ``docs`` but the text as a struct ``kept``, ``n_words``, and ``places`` by start.

    Words are runs of ASCII letters, lower-cased, digits and characters beyond ASCII. A place has its label, first word, the word
    after its last, share and kind: ``phrase`` wherever the words of one of ``phrases`` stand one after the other;
    ``template`` where a licence text stands with at least 0.8 of its weight in place and all its mandatory phrases; ``near``
    where it is aligned but fails one of the two. A word weighs log(1 + documents / (1 + documents with it)), counted over all of ``docs``.

    Null and empty texts have no words and no places, repeated rows are scanned each by itself, an empty table gives an empty
    result, and columns may have any names. Texts are read twice and not shuffled; only counts of the templates' words, as many
    as these have, come to the driver.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    kept = (F.struct(*rest) if rest else F.struct(F.lit(None).cast("string").alias("none"))).alias("kept")
    rows = docs.select(kept, F.col(f"`{text_column}`").cast("string").alias("text"))
    index = LicenseIndex(templates, phrases)
    counted = rows.select("text").mapInArrow(lambda b: _frequencies(b, index), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}
    total = found.get(-1, 0)
    idf = np.array([np.log1p(total / (1 + found.get(i, 0))) for i in range(len(index.vocabulary.words))], float)
    places = T._parse_datatype_string(PLACES)
    struct = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64()), ("kind", pa.string())])
    fields = [pa.field("places", pa.list_(struct))]
    schema = T.StructType([rows.schema["kept"], T.StructField("n_words", T.LongType()), T.StructField("places", places)])
    return rows.mapInArrow(lambda b: _scan(b, index, idf, fields), schema)


def op13_rare_tokens(spark, sf_dir: str) -> DataFrame:
    """Base places are the phrases; the score is the largest share of any place, 0 without one."""
    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    base = F.filter("places", lambda p: p["kind"] == "phrase")
    sure = F.filter("places", lambda p: p["kind"] != "near")
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["start"])
    return found.select(
        "kept.doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(sure).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
