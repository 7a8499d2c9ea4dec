"""Licence scans: a positional index of rare licence words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.llm.shared import texts_of


@dataclass(frozen=True)
class Template:
    """A licence text, and a phrase of it that must stand word by word. ``base``: a plain phrase, wanted at every place."""

    label: str
    text: str
    key: str
    base: bool = False


def _notice(label: str, name: str, key: str) -> tuple[Template, ...]:
    """The usual short notices that name a licence."""
    forms = ("licensed under the {}", "released under the {}", "this work is licensed under a {}", "this project is licensed under the terms of the {}")
    return tuple(Template(label, form.format(name), key) for form in forms)


#: Labels, licence texts and mandatory key phrases.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so", "without restriction including without limitation"),
    Template("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "copies or substantial portions of the software"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "with or without fee is hereby granted"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived from this software"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at http www.apache.org licenses LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied", "apache license version 2 0"),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or at your option any later version", "either version 2"),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or at your option any later version", "either version 3"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gnu lesser general public license"),
    Template("agpl", "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "gnu affero general public license"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, you can obtain one at", "mozilla public license"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "free and unencumbered software"),
    Template("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software", "without any express or implied warranty"),
    Template("boost", "Distributed under the Boost Software License, Version 1.0. See accompanying file", "boost software license"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "copyright and related or neighboring rights"),
    Template("no-warranty", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement", "without warranty of any kind"),
    *_notice("mit", "MIT License", "mit license"),
    *_notice("apache-2", "Apache License Version 2.0", "apache license version 2 0"),
    *_notice("gpl-2", "GNU General Public License Version 2", "general public license version 2"),
    *_notice("gpl-3", "GNU General Public License Version 3", "general public license version 3"),
    *_notice("lgpl", "GNU Lesser General Public License", "gnu lesser general public license"),
    *_notice("agpl", "GNU Affero General Public License", "gnu affero general public license"),
    *_notice("cc-by-4", "Creative Commons Attribution 4.0 International License", "creative commons attribution 4 0"),
    *_notice("cc-by-sa", "Creative Commons Attribution ShareAlike 4.0 International License", "creative commons attribution sharealike"),
    *_notice("cc-by-nc", "Creative Commons Attribution NonCommercial 4.0 International License", "creative commons attribution noncommercial"),
    *_notice("cc-by-nd", "Creative Commons Attribution NoDerivatives 4.0 International License", "creative commons attribution noderivatives"),
    *_notice("cc-by-sa", "CC BY SA 4.0", "cc by sa"),
    *_notice("cc-by-nc", "CC BY NC 4.0", "cc by nc"),
    *_notice("cc-by-nd", "CC BY ND 4.0", "cc by nd"),
)
#: Rarest words of a template that are posted, and the share of them that must agree on a place.
ANCHORS = 8
AGREE = 0.5
#: Words that may be missing or inserted: places may differ by a quarter of the template's length, this many at most.
MOST_DRIFT = 8
#: Share of a template's pairs of neighbouring words outside the key phrase that must be held near their places.
LEAST_COVERAGE = 0.6

_SEPARATED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
_MATCH = "label string, base boolean, start bigint, n_words bigint, coverage double"
_TYPE = f"n_words bigint, matches array<struct<{_MATCH.replace(' ', ':').replace(',:', ',')}>>"


def licence_words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8").translate(_SEPARATED).split()


class Posted:
    """A template as the index holds it: its rarest words with their places, its key phrase, and its pairs of words."""

    def __init__(self, template: Template, idf: dict[bytes, float]):
        self.label, self.base = template.label, template.base
        self.words, self.key = licence_words(template.text), licence_words(template.key)
        length = len(self.key)
        self.key_at = next(i for i in range(len(self.words)) if self.words[i : i + length] == self.key)
        rarity = sorted(range(len(self.words)), key=lambda i: (-idf[self.words[i]], self.words[i], i))
        #: Places, rarest word first. All words of a plain phrase must agree, at their exact places.
        self.places = rarity if self.base else rarity[: min(ANCHORS, -(-len(rarity) // 2))]
        self.need = len(self.places) if self.base else math.ceil(AGREE * len(self.places))
        self.drift = 0 if self.base else min(MOST_DRIFT, len(self.words) // 4)
        #: Of all places that agree, ``need`` or more, one is among these.
        self.leading = self.places[: len(self.places) - self.need + 1]
        inside = range(self.key_at, self.key_at + length - 1)
        self.pairs = [q for q in range(len(self.words) - 1) if q not in inside]

    def agree(self, words: list[bytes], start: int) -> bool:
        """Whether enough of the rarest words stand near their places."""
        held = 0
        for p in self.places:
            from_ = max(0, start + p - self.drift)
            held += self.words[p] in words[from_ : max(0, start + p + self.drift + 1)]
        return held >= self.need

    def coverage(self, words: list[bytes], start: int) -> float:
        """Share of the pairs of neighbouring words, outside the key phrase, that stand near their places."""
        if not self.pairs:
            return 1.0
        held = 0
        for q in self.pairs:
            a, b = self.words[q], self.words[q + 1]
            from_, to = max(0, start + q - self.drift), min(len(words) - 1, start + q + self.drift + 1)
            held += any(words[i] == a and words[i + 1] == b for i in range(from_, to))
        return held / len(self.pairs)


class PositionalIndex:
    """Postings (template, place) of the rarest words of licence texts."""

    def __init__(self, idf: dict[bytes, float], templates: tuple[Template, ...] = TEMPLATES):
        words = {w for t in templates for w in licence_words(t.text)}
        self.idf = {w: idf.get(w, math.inf) for w in words}
        self.templates = [Posted(t, self.idf) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for k, posted in enumerate(self.templates):
            for p in posted.places:
                self.postings.setdefault(posted.words[p], []).append((k, p))
        self.anchors = frozenset(self.postings)

    def find(self, words: list[bytes]) -> list[tuple[str, bool, int, int, float]]:
        """All places of all templates, ordered by start and label: (label, base, start, n_words, coverage).

        The posted words that the file holds are looked up, which leaves the templates of which enough are held. Each
        place of a leading word puts the template at a start; there the other posted words must agree by relative
        place, then the key phrase is verified word by word, and then coverage asks for the rest of the text, so that a
        mere mention does not do. ``start`` is the key phrase's.
        """
        present = self.anchors.intersection(words)
        if not present:
            return []
        held = Counter(k for w in present for k, _ in self.postings[w])
        likely = [self.templates[k] for k, n in held.items() if n >= self.templates[k].need]
        places: dict[bytes, list[int]] = {t.words[p]: [] for t in likely for p in t.leading if t.words[p] in present}
        if not places:
            return []
        for i, w in enumerate(words):
            if w in places:
                places[w].append(i)
        found = set()
        for t in likely:
            votes = {i - p for p in t.leading for i in places.get(t.words[p], ())}
            for start in {v + d for v in votes for d in range(-t.drift, t.drift + 1)}:
                at = start + t.key_at
                if at < 0 or not t.agree(words, start) or words[at : at + len(t.key)] != t.key:
                    continue
                coverage = t.coverage(words, start)
                if coverage >= LEAST_COVERAGE:
                    found.add((t.label, t.base, at, len(t.key), coverage))
        return sorted(found, key=lambda m: (m[2], m[0], m[3], m[4]))


def word_idf(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[bytes, float]:
    """IDF of every licence word over all of ``docs``; the result has one entry per word of the templates."""
    wanted = frozenset(w for t in templates for w in licence_words(t.text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for text in texts_of(batch.column(0)):
                held.update(wanted.intersection(licence_words(text)))
        names = [w.decode() for w in held]
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([*names, None], pa.string()), "n": pa.array([*held.values(), rows], pa.int64())}
        )

    rows = docs.select("text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    held = {r["word"]: r["n"] for r in rows}
    total = held.pop(None, 0)
    return {w: math.log((total + 1) / (held.get(w.decode(), 0) + 1)) for w in wanted}


def licence_matches(text: Column | str, index: PositionalIndex) -> Column:
    """A struct of n_words and matches (label, base, start, n_words, coverage) of a text.

    ``start`` counts words from 0 and is that of the key phrase. Null and empty texts have no words
    and no matches. Each row depends on its own text alone; the whole text is scanned.
    """

    @F.arrow_udf(_TYPE)
    def scan(column: pa.Array) -> pa.Array:
        counts, matches = [], []
        for value in texts_of(column):
            words = licence_words(value)
            counts.append(len(words))
            matches.append([dict(zip(_NAMES, m, strict=True)) for m in index.find(words)])
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(matches, _MATCHES)], ["n_words", "matches"]
        )

    return scan(text)


_NAMES = ["label", "base", "start", "n_words", "coverage"]
_MATCHES = pa.list_(pa.struct([
    ("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64()),
]))


def scan_licences(docs: DataFrame, into: str = "licences", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``docs`` and a struct column ``into`` (replaced if there is one) of ``licence_matches``.

    The corpus is read twice: for the IDF of licence words, and for the scan. An empty table gives an
    empty table; repeated rows are scanned alike.
    """
    return docs.withColumn(into, licence_matches("text", PositionalIndex(word_idf(docs, templates), templates)))
