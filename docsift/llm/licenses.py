"""License scan: MinHash bands over overlapping text windows, exact check.

The templates are ``TEMPLATES`` and the rows of ``license_templates.jsonl``
beside this file (license, kind, keys, text): whole license texts, usual
headers and one row for each name a notice may give a license.  Several
templates may share a name; keys are phrases that must stand unchanged in a
match, such as a license's name and version.

Words are lower-cased runs of letters and digits (``2.0`` is one).  Words that
say nothing about the license (``NOISE``) are left out and a version is read
without its ``v`` and ``.0``, so one row meets "under the terms of the GNU
General Public License, version 2.0" and "under GNU General Public License v2".

All templates go one way.  A template of ``n`` words is a set of ``m`` shingles of five words, or
of two where one changed word would cost more than ``1 - containment`` of the
five-word ones (``width``).  It is found where at least ``containment`` of its
distinct shingles, and its keys, stand within a span of ``n / containment``
words.  Retrieval: the document's shingles are read as windows of ``2 * half``
that overlap by half, ``half`` being the power of two that holds a span, so
each span lies inside some window.  A window and a template share a band (``BANDS`` bands of
one MinHash value each) with probability ``1 - (1 - J)^BANDS``; for any span
that is a match ``J`` is at least 0.15 where the template's shingles are
distinct, so a match is missed with a probability under 0.0005
(``least_similarity`` gives the bound of any template).
Verification: every span that begins in or near a retrieved window is
checked on its full shingles.  Touching spans of one name are one match; its
containment is the largest.

Templates are few and short (at most ``MAX_TEMPLATES``, checked) and are sent
to every task; documents are scanned where they are read, nothing is shuffled.
``first_word`` and ``last_word`` count all words of the text, from 0.
Defined results: null and empty texts match nothing; rows that repeat are each
scanned; null ids are kept; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, K_SHORT = 5, 2                          # words of a shingle; of templates that one changed word would break
BANDS = 48
CHUNK = 1 << 16                            # shingles hashed at a time; a multiple of every ``half``
MAX_TEMPLATES = 10_000
SCHEMA = "doc_id long, license string, containment double, first_word long, last_word long"
# fixed values: opening terms of common licenses; words that a notice may hold or leave out
TEMPLATES = {
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                         "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                    "conditions are met:",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                      "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                 "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
}
KEYS = {"GPL-3.0-header": ["GNU General Public License", "version 3 of the License"]}
NOISE = frozenset(["a", "an", "the", "terms", "of", "version", "v"])
TABLE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_templates.jsonl")
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_ZEROS = re.compile(r"(?<=\d)(?:\.0)+$")
_V = re.compile(r"^v(?=\d)")
_rng = np.random.default_rng(31)
_A = (_rng.integers(0, 1 << 32, BANDS, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_B = _rng.integers(0, 1 << 32, BANDS, dtype=np.uint64).astype(np.uint32)[:, None]
_C = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """word -> hash (0: a word that is left out)."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        bare = _V.sub("", _ZEROS.sub("", word)) if word[-1].isdigit() else word
        h = self[word] = 0 if word in NOISE else xxhash.xxh3_64_intdigest(bare) | 1
        return h


def words_of(text: str, cache: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that count and their places among all words."""
    raw = _WORD.findall(text.lower())
    h = np.fromiter(map(cache.__getitem__, raw), np.uint64, len(raw))
    at = np.flatnonzero(h)
    return h[at], at


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in order."""
    if len(h) < width:
        return h[:0]
    acc = h[:len(h) - width + 1].copy()
    for j in range(1, width):
        acc = acc * _C + h[j:len(h) - width + 1 + j]
    acc = (acc ^ (acc >> np.uint64(31))) * _C
    return acc ^ (acc >> np.uint64(29))


def width(n: int, containment: float) -> int:
    """Words of a shingle of a template of ``n`` words."""
    return K if n >= K and K <= (n - K + 1) * (1 - containment) + 1e-9 else min(n, K_SHORT)


def reach(n: int, containment: float) -> int:
    """Shingles of the longest span in which a template of ``n`` words is looked for."""
    return int(np.ceil(n / containment - 1e-9)) - width(n, containment) + 1


def half_window(n: int, containment: float) -> int:
    return 1 << (reach(n, containment) - 1).bit_length()


def least_similarity(n: int, m: int, containment: float) -> float:
    """Least Jaccard similarity of a matching window and a template of ``n`` words and ``m`` distinct shingles."""
    need = int(np.ceil(m * containment - 1e-9))
    return need / (2 * half_window(n, containment) + m - need)


def library() -> list[tuple[str, str, list[str]]]:
    """(name, text, keys) of all registered templates; read on the driver."""
    with open(TABLE, encoding="utf-8") as f:
        rows = [json.loads(line) for line in f]
    return [(name, text, KEYS.get(name, [])) for name, text in TEMPLATES.items()] + [(r["license"], r["text"], r["keys"]) for r in rows]


class Templates:
    def __init__(self, texts: dict[str, str] | list[tuple[str, str, list[str]]], containment: float):
        if len(texts) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        cache = _Words()
        self.names, self.sets, self.keys, self.need, self.reach = [], [], [], [], []
        # words of a shingle -> half window -> (band, value) -> templates
        self.bands: dict[int, dict[int, dict[tuple[int, int], list[int]]]] = {}
        rows = [(name, text, []) for name, text in texts.items()] if isinstance(texts, dict) else texts
        for name, text, keys in sorted(rows):
            h, _ = words_of(text or "", cache)
            n = len(h)
            if not n:
                continue
            t, w = len(self.names), width(n, containment)
            s = np.unique(shingles(h, w))
            self.names.append(name), self.sets.append(s), self.keys.append([words_of(key, cache)[0] for key in keys])
            self.need.append(int(np.ceil(len(s) * containment - 1e-9))), self.reach.append(reach(n, containment))
            values = self.bands.setdefault(w, {}).setdefault(half_window(n, containment), {})
            for k, v in enumerate((_A * (s >> np.uint64(32)).astype(np.uint32) + _B).min(axis=1).tolist()):
                values.setdefault((k, v), []).append(t)
        # which low 18 bits a template's band values have: skips almost every window at once
        self.maybe = {(w, half): np.zeros(1 << 18, bool) for w, halves in self.bands.items() for half in halves}
        for (w, half), seen in self.maybe.items():
            seen[[v & 0x3FFFF for _, v in self.bands[w][half]]] = True

    def _candidates(self, s: np.ndarray, w: int) -> dict[int, list[list[int]]]:
        """template -> ranges of shingles around the windows that share a band with it, in order."""
        found: set[tuple[int, int, int]] = set()
        halves = sorted(self.bands[w])
        for c in range(0, len(s), CHUNK):
            x = (s[c:c + CHUNK + 2 * halves[-1]] >> np.uint64(32)).astype(np.uint32)
            low, size = _A * x + _B, 1
            for half in halves:
                while size < half:                       # minima of blocks of ``half`` shingles
                    odd = low[:, -1:] if low.shape[1] % 2 else low[:, :0]
                    low = np.concatenate([np.minimum(low[:, :-1:2], low[:, 1::2]), odd], axis=1)
                    size *= 2
                window = np.minimum(low[:, :-1], low[:, 1:]) if low.shape[1] > 1 else low
                band, at = np.nonzero(self.maybe[w, half][window & np.uint32(0x3FFFF)])
                values = self.bands[w][half]
                for k, i, v in zip(band.tolist(), at.tolist(), window[band, at].tolist()):
                    for t in values.get((k, v), ()):
                        found.add((t, c + i * half, c + (i + 2) * half))
        near: dict[int, list[list[int]]] = {}
        for t, lo, hi in sorted(found):
            lo, hi, ranges = max(0, lo - self.reach[t]), hi + self.reach[t], near.setdefault(t, [])
            if ranges and lo <= ranges[-1][1]:
                ranges[-1][1] = max(ranges[-1][1], hi)
            else:
                ranges.append([lo, hi])
        return near

    def _spans(self, t: int, w: int, h: np.ndarray, s: np.ndarray, lo: int) -> list[tuple[int, int, float]]:
        """(first word, word after the last, containment) of the spans of template ``t`` among shingles ``s``, the first at word ``lo``."""
        own, need = self.sets[t], self.need[t]
        which = np.searchsorted(own, s)
        which[which == len(own)] = 0
        at = np.flatnonzero(own[which] == s)
        if len(at) < need:
            return []
        keys = [(lo + np.flatnonzero(_starts(h[lo:lo + len(s) + w - 1], key)), len(key)) for key in self.keys[t]]
        place, which, out = at.tolist(), which[at].tolist(), []
        counts: dict[int, int] = {}
        end = 0
        for i, p in enumerate(place):                    # the span that begins with this shingle
            while end < len(place) and place[end] < p + self.reach[t]:
                counts[which[end]] = counts.get(which[end], 0) + 1
                end += 1
            if len(counts) >= need:
                begin, after = lo + p, lo + place[end - 1] + w
                if all((k := bisect_left(starts, begin)) < len(starts) and starts[k] + size <= after for starts, size in keys):
                    out.append((begin, after, len(counts) / len(own)))
            if counts[which[i]] == 1:
                del counts[which[i]]
            else:
                counts[which[i]] -= 1
        return out

    def find(self, text: str, cache: _Words) -> list[tuple[str, float, int, int]]:
        """(license, containment, first and last word), by name and place."""
        h, place = words_of(text, cache)
        spans: dict[str, list[tuple[int, int, float]]] = {}
        for w in self.bands:
            s = shingles(h, w)
            for t, ranges in self._candidates(s, w).items():
                for lo, hi in ranges:
                    spans.setdefault(self.names[t], []).extend(self._spans(t, w, h, s[lo:hi], lo))
        out = []
        for t in sorted(spans):
            merged: list[list] = []
            for lo, hi, share in sorted(spans[t]):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1], merged[-1][2] = max(merged[-1][1], hi), max(merged[-1][2], share)
                else:
                    merged.append([lo, hi, share])
            out += [(t, share, int(place[lo]), int(place[hi - 1])) for lo, hi, share in merged]
        return out


def _starts(h: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where ``key`` begins in ``h``, as booleans."""
    if len(h) < len(key):
        return np.zeros(0, bool)
    hit = np.ones(len(h) - len(key) + 1, bool)
    for j, x in enumerate(key):
        hit &= h[j:j + len(hit)] == x
    return hit


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = 0.8) -> DataFrame:
    """One row per match: document, license, containment and word range."""
    shared = docs.sparkSession.sparkContext.broadcast(Templates(library() if templates is None else templates, containment))

    def run(batches):
        find, cache = shared.value.find, _Words()
        for b in batches:
            cols = [[], [], [], [], []]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for found in find(text.as_py() or "", cache):
                    for c, v in zip(cols, (doc_id, *found)):
                        c.append(v)
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "license", "containment", "first_word", "last_word"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).mapInArrow(run, SCHEMA)
