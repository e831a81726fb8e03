"""License notices found by MinHash of overlapping text windows.

Templates are grouped by length class ``c`` (a power of two of their words). A text is
read in windows of ``2 c`` words that start every ``c`` words, so each notice lies
whole inside a window, of whose three-word shingles it holds a fifth or more.
With one register per band, a window and a template of Jaccard similarity ``J`` meet
in at least one of 48 bands with probability ``1 - (1 - J)^48``, 0.99998 at a
fifth; the templates of a band are found in a sorted table of their values. Exact
containment of the template's shingles in the window then decides, together with the
telling words of its license, which the window must hold in full. A notice whose
shingles all stand inside better held notices of other licenses is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.llm.tables import column
from duelboard.llm.wordkeys import in_blocks, mix, shingle_keys, word_keys

SHINGLE_WORDS = 3
BANDS = 48
#: Share of a template's shingles that a window must hold.
CONTAINMENT = 0.8

#: Notices looked for: fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("ISC", "Licensed under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
]

#: Words that tell a license from its relatives, each run of them needed in full: fixed values.
TELLING = {
    "BSD-3-Clause": ["neither the name"],
    "GPL-2.0": ["gnu general public license", "version 2"],
    "GPL-3.0": ["gnu general public license", "version 3"],
    "LGPL-2.1": ["lesser general public license", "version 2 1"],
    "LGPL-3.0": ["lesser general public license", "version 3"],
    "AGPL-3.0": ["affero general public license", "version 3"],
    "MPL-2.0": ["mozilla public license", "2 0"],
}

#: ASCII punctuation ends a word.
_PUNCTUATION = str.maketrans({c: " " for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"})
_SALTS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return word_keys([(t or "").translate(_PUNCTUATION) for t in texts])


def _holds(words: np.ndarray, run: np.ndarray) -> bool:
    """Whether a run of words stands in ``words``."""
    n = len(words) - len(run) + 1
    return n > 0 and bool(np.logical_and.reduce([words[k : k + n] == key for k, key in enumerate(run)]).any())


class Scanner:
    """Templates by length class, their band values, shingle sets and telling words."""

    def __init__(self, templates: list[tuple[str, str]], telling: dict[str, list[str]]):
        self.names = [name for name, _ in templates]
        keys, offsets = shingle_keys(*_words([text for _, text in templates]), SHINGLE_WORDS)
        self.shingles = [np.unique(keys[offsets[i] : offsets[i + 1]]) for i in range(len(templates))]
        self.telling = {name: [_words([run])[0] for run in runs] for name, runs in telling.items()}
        classes: dict[int, list[int]] = {}
        for i, own in enumerate(self.shingles):
            if len(own):
                classes.setdefault(max(4, 1 << int(np.ceil(np.log2(len(own) + SHINGLE_WORDS)))), []).append(i)
        # band table of a class: its templates in the order of their values in each band
        self.classes = {}
        for size, own in classes.items():
            lows = np.array([[(self.shingles[i] * salt >> np.uint64(16)).min() for i in own] for salt in _SALTS])
            order = np.argsort(lows, axis=1, kind="stable")
            self.classes[size] = (np.take_along_axis(lows, order, 1), np.array(own)[order])

    def find(self, texts: list[str | None]) -> list[dict[str, float]]:
        """For each text: license name to the largest containment of one of its notices."""
        words, word_offsets = _words(texts)
        keys, offsets = shingle_keys(words, word_offsets, SHINGLE_WORDS)
        hits: dict[int, list[tuple[np.ndarray, int, float]]] = {}
        lengths = np.diff(offsets)
        for size, (table, owners) in self.classes.items():
            blocks = -(-lengths // size)
            total = int(blocks.sum())
            if not total:
                continue
            first = np.cumsum(blocks) - blocks
            text_of = np.repeat(np.arange(len(texts)), blocks)
            starts = offsets[text_of] + (np.arange(total) - first[text_of]) * size
            last = np.zeros(total, bool)
            last[(first + blocks - 1)[blocks > 0]] = True
            for block, template in sorted(self._meetings(keys, starts, last, table, owners)):
                text = int(text_of[block])
                stop = int(min(starts[block] + 2 * size, offsets[text + 1]))
                hit = self._held(template, keys, int(starts[block]), stop, words, int(word_offsets[text] - offsets[text]), int(word_offsets[text + 1]))
                if hit:
                    hits.setdefault(text, []).append((hit[0], template, hit[1]))
        return [self._best(hits.get(i, [])) for i in range(len(texts))]

    @staticmethod
    def _meetings(keys: np.ndarray, starts: np.ndarray, last: np.ndarray, table: np.ndarray, owners: np.ndarray) -> set[tuple[int, int]]:
        """(window, template) pairs with the same value in some band."""
        met: set[tuple[int, int]] = set()
        for salt, values, own in zip(_SALTS, table, owners):
            low = np.minimum.reduceat(keys * salt >> np.uint64(16), starts)
            window = low.copy()
            window[:-1] = np.where(last[:-1], low[:-1], np.minimum(low[:-1], low[1:]))
            at, end = np.searchsorted(values, window), np.searchsorted(values, window, "right")
            for block in np.flatnonzero(end > at).tolist():
                met.update((block, int(t)) for t in own[at[block] : end[block]])
        return met

    def _held(self, template: int, keys: np.ndarray, start: int, stop: int, words: np.ndarray, to_words: int, end: int) -> tuple[np.ndarray, float] | None:
        """(places of the template's shingles in the window, containment), if the window holds the template."""
        wanted, held = self.shingles[template], keys[start:stop]
        share = float(np.isin(wanted, held).mean())
        if share < CONTAINMENT:
            return None
        own = words[start + to_words : min(stop + to_words + SHINGLE_WORDS - 1, end)]
        if not all(_holds(own, run) for run in self.telling.get(self.names[template], ())):
            return None
        return start + np.flatnonzero(np.isin(held, wanted)), share

    def _best(self, hits: list[tuple[np.ndarray, int, float]]) -> dict[str, float]:
        """Licenses of a text's hits, without those whose places lie inside kept hits of other licenses with more places."""
        out: dict[str, float] = {}
        covers: dict[int, set[str]] = {}
        hits = sorted(hits, key=lambda h: -len(h[0]))
        for n in sorted({len(places) for places, _, _ in hits}, reverse=True):
            kept = []
            for places, template, share in (h for h in hits if len(h[0]) == n):
                name = self.names[template]
                if not all(covers.get(p, set()) - {name} for p in places.tolist()):
                    kept.append((places, name))
                    out[name] = max(share, out.get(name, 0.0))
            for places, name in kept:
                for p in places.tolist():
                    covers.setdefault(p, set()).add(name)
        return out


def licenses_of(text: Column, templates: list[tuple[str, str]] = TEMPLATES, telling: dict[str, list[str]] = TELLING) -> Column:
    """Array of (license, containment) of each whole text, by license; empty for null and empty texts."""

    @F.pandas_udf("array<struct<license: string, containment: double>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, telling)
        for texts in batches:
            texts = texts.tolist()
            rows = [r for a, b in in_blocks(texts) for r in scanner.find(texts[a:b])]
            yield pd.Series([[{"license": k, "containment": v} for k, v in sorted(r.items())] for r in rows], dtype="object")

    return scan(text)


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, telling: dict[str, list[str]] = TELLING) -> DataFrame:
    """doc_id, license, containment: a row for every license whose notice a document holds.

    Case, white space and ASCII punctuation do not count. Of several notices or windows
    of a license the largest containment is given. Null and empty texts hold none; long
    texts are scanned whole, in time proportional to their length; repeated rows are
    scanned alike. ``telling`` names the words that a license's notices must hold in full.
    """
    found = F.explode(licenses_of(column(docs, "text"), templates, telling)).alias("found")
    return docs.select(column(docs, "doc_id").alias("doc_id"), found).select("doc_id", "found.license", "found.containment")
