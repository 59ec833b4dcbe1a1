"""License scan: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

A text is its runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased. For every
template length the text is cut into overlapping windows of that many words; a window's shingles (five
words; a shorter template is one shingle of its own length) give ``BANDS`` bands of ``ROWS`` MinHash values,
and a template is retrieved when a band equals its own. ``collision_probability`` gives the odds: a window
that holds three quarters of a template has a similarity of 0.6 at least and is retrieved with probability
0.999 or more. A retrieved template counts if the window, widened by a quarter of its length on either side
for added words, contains at least ``CONTAINMENT`` of its shingles. Of overlapping matches the one with the
most shingles found stays, so a sentence that several licenses share yields to the notice that holds it; of as
many the one with the highest containment.

Only windows with at least one template shingle are hashed: no other window can equal a band, since a
template's MinHash values all come from its own shingles.

Defined results: null or empty texts have no matches; null ids and repeated rows are kept row by row; an
empty table gives an empty result; other columns are ignored. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 5
BANDS, ROWS = 16, 2
CONTAINMENT = 0.75
MEMO = 100_000  # word hashes that a task remembers
SEED = 42

# --- fixed values: license notices by their usual wording
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
        "the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met")
_BSD_1_2 = (_BSD + ": {}Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer. {}Redistributions in binary form must reproduce the above copyright notice, this list of "
            "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_NUMBERS, _BULLETS = ("1. ", "2. "), ("* ", "* ")
_BSD_NAME = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission. ")
_BSD_END = "This software is provided by the"
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-1.0", _GNU.format("General Public License", "1")),
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("LGPL-2.0", _GNU.format("Library General Public License", "2")),
    ("LGPL-2.0", _GNU.format("Lesser General Public License", "2")),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", _BSD),  # common to all of them
    ("BSD-2-Clause", _BSD_1_2.format(*_NUMBERS) + _BSD_END),
    ("BSD-2-Clause", _BSD_1_2.format(*_BULLETS) + _BSD_END),
    ("BSD-3-Clause", _BSD_1_2.format(*_NUMBERS) + "3. " + _BSD_NAME + _BSD_END),
    ("BSD-3-Clause", _BSD_1_2.format(*_BULLETS) + _BSD_NAME + _BSD_END),
    ("BSD-4-Clause", _BSD_1_2.format(*_NUMBERS) + "3. All advertising materials mentioning features or use of this software must display the "
                     "following acknowledgement: This product includes software developed by the organization. 4. "
                     + _BSD_NAME + _BSD_END),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved."),
)

_TO_SPACE = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256))
TOKEN = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")
_MIX, _MUL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def collision_probability(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Odds that two sets of a Jaccard similarity share a band."""
    return 1 - (1 - similarity ** rows) ** bands


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: str, memo: dict) -> np.ndarray:
    w = text.encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()
    return np.fromiter(map(memo.__getitem__, w), np.uint64, len(w))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles, by position."""
    n = max(0, len(h) - k + 1)
    x = np.full(n, k, np.uint64)
    for i in range(k):
        x = (x * _MIX) ^ (h[i:i + n] * _MUL)
        x ^= x >> np.uint64(29)
    return x


@dataclass
class _Template:
    name: str
    length: int  # words
    k: int
    own: np.ndarray  # sorted distinct shingles


class LicenseIndex:
    """The templates' shingles and bands."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        memo = _WordHash()
        rng = np.random.Generator(np.random.PCG64(seed))
        self.factors = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands, self.rows = bands, rows
        self.templates, self.table = [], {}
        for name, text in templates:
            h = word_hashes(text, memo)
            if not len(h):
                continue
            k = min(WORDS, len(h))
            t = _Template(name, len(h), k, np.unique(shingles(h, k)))
            for b, key in enumerate(self.band_keys(t.own[None])[0].tolist()):
                self.table.setdefault((t.length, b, key), []).append(len(self.templates))
            self.templates.append(t)
        self.lengths = sorted({(t.length, t.k) for t in self.templates})
        self.known = {k: np.unique(np.concatenate([t.own for t in self.templates if t.k == k])) for _, k in self.lengths}

    def band_keys(self, windows: np.ndarray) -> np.ndarray:
        """(windows, bands) keys of rows of shingles."""
        low = []
        for f in self.factors:
            x = windows * f
            low.append((x ^ (x >> np.uint64(32))).min(axis=1))
        out = []
        for b in range(self.bands):
            key = np.full(len(windows), b + 1, np.uint64)
            for r in range(self.rows):
                key = (key ^ low[b * self.rows + r]) * _MUL
                key ^= key >> np.uint64(31)
            out.append(key)
        return np.array(out).T

    def candidates(self, h: np.ndarray, at: dict[int, np.ndarray], sh: dict[int, np.ndarray]) -> set[tuple[int, int]]:
        """(template, first word) of the windows that share a band with a template."""
        found = set()
        for length, k in self.lengths:
            hits, s = at.get(k), sh.get(k)
            if hits is None or not len(hits):
                continue
            n, stride = length - k + 1, max(1, length // 8)
            n = min(n, len(s))
            # windows on the grid that hold a hit; a text shorter than the window is one window
            most = len(s) - n
            first = (hits[:, None] - np.arange(n)[None, :])
            first = np.unique(np.concatenate([np.clip(first, 0, most).ravel() // stride * stride, [most]]))
            for a in range(0, len(first), 4096):
                start = first[a:a + 4096]
                keys = self.band_keys(s[start[:, None] + np.arange(n)[None, :]])
                for i, row in zip(start.tolist(), keys.tolist(), strict=True):
                    for b, key in enumerate(row):
                        for t in self.table.get((length, b, key), ()):
                            found.add((t, i))
        return found

    def scan(self, text: str | None, memo: dict) -> list[tuple[str, int, int, float]]:
        """(name, start, end, containment) of the licenses found, by start."""
        if not text:
            return []
        h = word_hashes(text, memo)
        sh, at = {}, {}
        for k, own in self.known.items():
            s = shingles(h, k)
            if not len(s):
                continue
            i = np.minimum(np.searchsorted(own, s), len(own) - 1)
            hits = np.flatnonzero(own[i] == s)
            if len(hits):
                sh[k], at[k] = s, hits
        if not at:
            return []
        matches = []
        for t, first in self.candidates(h, at, sh):
            tpl = self.templates[t]
            s, margin = sh[tpl.k], -(-tpl.length // 4) if tpl.length > tpl.k else 0
            a, b = max(0, first - margin), min(len(s), first + tpl.length - tpl.k + 1 + margin)
            i = np.minimum(np.searchsorted(tpl.own, s[a:b]), len(tpl.own) - 1)
            hit = np.flatnonzero(tpl.own[i] == s[a:b])
            share = len(np.unique(i[hit])) / len(tpl.own) if len(hit) else 0.0
            if share >= CONTAINMENT:
                matches.append((share, len(tpl.own), a + int(hit[0]), a + int(hit[-1]) + tpl.k, tpl.name))
        kept: list[tuple] = []
        for m in sorted(matches, key=lambda m: (-round(m[0] * m[1]), -m[0], m[2], m[3], m[4])):
            if all(m[3] <= x[2] or x[3] <= m[2] for x in kept):
                kept.append(m)
        if not kept:
            return []
        spans = [m.span() for m in TOKEN.finditer(text)]
        return sorted((m[4], spans[m[2]][0], spans[m[3] - 1][1], m[0]) for m in kept)


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Per row: doc_id and the matches, an array of (license, start, end, containment) by start."""
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = LicenseIndex(templates), _WordHash()
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())]))
        for b in batches:
            found = [[{"license": n, "start": s, "end": e, "containment": c}
                      for n, s, e, c in sorted(index.scan(t, memo), key=lambda m: (m[1], m[0]))]
                     for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "matches"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, "
                             "matches array<struct<license:string,start:int,end:int,containment:double>>")


def license_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_matches, licenses (distinct names, sorted), spans (license:start:end, by start)."""
    m = F.col("matches")
    return scan_licenses(docs).select(
        "doc_id", F.size(m).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["license"]))), ",").alias("licenses"),
        F.array_join(F.transform(m, lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string"))),
                     ",").alias("spans"))
