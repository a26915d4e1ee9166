"""License texts inside documents: MinHash bands over text windows, then exact containment.

Templates of about the same number of shingles form a class. A class has windows longer
than its templates by the words that may be inserted into one, a fraction of a template's
length apart, so every occurrence lies wholly in a window and the window's Jaccard similarity to the
template has a known floor. Each class has as many bands as let a pair at its floor
collide with the wanted probability. Windows that share a band with a template are joined
where they overlap and compared exactly: the share of the template's shingles that a
stretch of the allowed length holds, wherever it starts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import slices

WORD = re.compile(r"[^\W_]+")
SHINGLE = 5  # words
GROWTH = 1.25  # template sizes in a class differ by this factor at most
STEPS = 4  # windows of a class overlap in all but one of this many steps
ROWS = 1  # in a band: few bands reach a low floor, and the exact comparison is cheap
SLACK = 0.5  # shingles that may be inserted into a template, as a share of its own
MOST_CHARS = 1 << 24  # of all templates of a table
KNOWN = 400_000
U = np.uint64

# Notices by which well-known licenses are applied.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                      "software and associated documentation files (the \"Software\"), to deal in the Software "
                      "without restriction, including without limitation the rights to use, copy, modify, merge, "
                      "publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of "
                  "the GNU General Public License as published by the Free Software Foundation",
    "Apache-2.0-notice": "You may not use this file except in compliance with the License. You may obtain a copy "
                         "of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bands_for(similarity: float, certainty: float = 0.999) -> int:
    """Bands of ROWS hashes so that a pair of this similarity collides with that probability."""
    if similarity >= 1:
        return 1
    return math.ceil(math.log(1 - certainty) / math.log(1 - similarity ** ROWS))


class _Hashes(dict):
    """64-bit hash by word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 11)
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h
        return h


def shingles_of(texts: list[str], known: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' shingles in a row, number of shingles of each text).

    A text with fewer words than a shingle has one shingle of them all, one without words none.
    """
    words = [WORD.findall(t.lower()) for t in texts]
    lens = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(known.__getitem__, w)), np.uint64, int(lens.sum()))
    sizes = np.where(lens > 0, np.maximum(lens - SHINGLE + 1, 1), 0)
    start = np.repeat(np.cumsum(lens) - lens, sizes) + np.arange(sizes.sum()) - np.repeat(
        np.cumsum(sizes) - sizes, sizes)
    end = np.repeat(np.cumsum(lens), sizes)
    out = np.full(len(start), 7, np.uint64)
    for k in range(SHINGLE):
        inside = start + k < end
        h = flat[np.minimum(start + k, max(0, len(flat) - 1))] if len(flat) else out
        mixed = (out * U(0x9E3779B97F4A7C15)) ^ h
        out = np.where(inside, mixed ^ (mixed >> U(32)), out)
    return out, sizes


@dataclass
class TemplateClass:
    """Templates whose sizes fit one window length."""

    size: int  # shingles of the longest
    slack: float
    names: list[str] = field(default_factory=list)
    shingles: list[np.ndarray] = field(default_factory=list)  # distinct ones, sorted
    lengths: list[int] = field(default_factory=list)  # with repeats
    keys: np.ndarray = field(default_factory=lambda: np.empty((0, 0), np.uint64))  # template x band
    bands: int = 1

    @property
    def step(self) -> int:
        return max(1, self.size // STEPS)

    def stretch(self, length: int) -> int:
        """Shingles over which a template of this length may spread."""
        return length + int(length * self.slack)

    @property
    def blocks(self) -> int:
        """Steps in a window: wherever a stretch starts in the first, it ends in the last."""
        return -(-(self.stretch(self.size) + self.step - 1) // self.step)

    def floor(self, containment: float) -> float:
        """Least similarity of a window that holds enough of a template to the template."""
        def least(n: int) -> float:
            held = math.ceil(containment * n - 1e-9)
            return held / (self.blocks * self.step + n - held)

        return min(least(len(s)) for s in self.shingles)


class Library:
    """Templates by class, with their MinHash bands."""

    def __init__(self, templates: dict[str, str], containment: float, certainty: float, slack: float = SLACK,
                 seed: int = 1):
        sized = sorted(((len(s), name, np.unique(s)) for name, text in templates.items()
                        for s in [shingles_of([text], _Hashes())[0]] if len(s)), key=lambda t: t[:2])
        self.classes: list[TemplateClass] = []
        for n, name, shingles in sized:
            last = self.classes[-1] if self.classes else None
            if last is None or n > GROWTH * last.lengths[0]:
                last = TemplateClass(n, slack)
                self.classes.append(last)
            last.size = max(last.size, n)
            last.names.append(name)
            last.shingles.append(shingles)
            last.lengths.append(n)
        for c in self.classes:
            c.bands = bands_for(c.floor(containment), certainty)
        self.bands = max((c.bands for c in self.classes), default=0)
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(1, 1 << 63, (self.bands * ROWS, 2), dtype=np.uint64) * U(2) + U(1)
        for c in self.classes:
            c.keys = np.stack([self.keys(np.array([self.hashed(s, k).min() for k in range(c.bands * ROWS)]
                                                  ).reshape(-1, 1))[:, 0] for s in c.shingles])

    def hashed(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """The k-th hash of each shingle, 32 bits."""
        a, b = self.factors[k]
        return ((shingles * a + b) >> U(32)).astype(np.uint32)

    def keys(self, least: np.ndarray) -> np.ndarray:
        """Band keys from minima (hashes x windows): ROWS minima joined, two at most."""
        rows = least.astype(np.uint64).reshape(-1, ROWS, *least.shape[1:])
        return rows[:, 0] if ROWS == 1 else (rows[:, 0] << U(32)) | rows[:, 1]


def windows(sizes: np.ndarray, step: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first shingle of each step, window's last step + 1, text) for all texts' shingles in a row."""
    steps = -(-sizes // step)
    text = np.repeat(np.arange(len(sizes)), steps)
    within = np.arange(len(text)) - np.repeat(np.cumsum(steps) - steps, steps)
    first = (np.cumsum(sizes) - sizes)[text] + within * step
    last = np.minimum(np.arange(len(text)) + blocks, np.cumsum(steps)[text])
    return first, last, text


def find(library: Library, shingles: np.ndarray, sizes: np.ndarray, containment: float
         ) -> list[tuple[int, str, int, int, float]]:
    """(text, template, first shingle, last shingle, share) of each occurrence."""
    found = []
    if not len(shingles):
        return found
    ends = np.cumsum(sizes)
    plans = [(c, *windows(sizes, c.step, c.blocks)) for c in library.classes]
    hits = [np.zeros((len(c.names), len(first)), bool) for c, first, _, _ in plans]
    for band in range(library.bands):
        hashed = [library.hashed(shingles, band * ROWS + r) for r in range(ROWS)]
        for (c, first, last, _), hit in zip(plans, hits):
            if band >= c.bands:
                continue
            least = []
            for h in hashed:
                block = np.minimum.reduceat(h, first) if c.step > 1 else h
                whole = block
                if c.blocks > 1:
                    whole, at = block.copy(), np.arange(len(block))
                    for k in range(1, c.blocks):
                        np.minimum(whole, block[np.minimum(at + k, last - 1)], out=whole)
                least.append(whole)
            keys = library.keys(np.stack(least))[0]
            near = np.flatnonzero(np.isin(keys, c.keys[:, band]))
            if len(near):
                for t, key in enumerate(c.keys[:, band]):
                    hit[t][near] |= keys[near] == key
    for (c, first, last, text), hit in zip(plans, hits):
        for t, name in enumerate(c.names):
            need, stretch = math.ceil(containment * len(c.shingles[t]) - 1e-9), c.stretch(c.lengths[t])
            for low, high, owner in _joined(np.flatnonzero(hit[t]), first, text, c.blocks * c.step, ends):
                base = int(ends[owner] - sizes[owner])
                for a, b, held in occurrences(shingles[low:high], c.shingles[t], need, stretch):
                    found.append((owner, name, low + a - base, low + b - base, held / len(c.shingles[t])))
    return found


def _joined(hits: np.ndarray, first: np.ndarray, text: np.ndarray, length: int, ends: np.ndarray
            ) -> Iterator[tuple[int, int, int]]:
    """(first shingle, last + 1, text) of the ranges that overlapping windows cover."""
    low = high = owner = -1
    for w in hits:
        start, mine = int(first[w]), int(text[w])
        if mine != owner or start > high:
            if owner >= 0:
                yield low, high, owner
            low, owner = start, mine
        high = min(start + length, int(ends[mine]))
    if owner >= 0:
        yield low, high, owner


def occurrences(shingles: np.ndarray, template: np.ndarray, need: int, stretch: int
                ) -> list[tuple[int, int, int]]:
    """(first, last, held) where some ``stretch`` shingles in a row hold ``need`` distinct ones of the template.

    Stretches that overlap are one occurrence; ``held`` is the most that one of them holds.
    """
    which = np.searchsorted(template, shingles)
    places = np.flatnonzero(template[np.minimum(which, len(template) - 1)] == shingles)
    found: list[tuple[int, int, int]] = []
    counts: dict[int, int] = {}
    start = 0
    at, codes = places.tolist(), which[places].tolist()
    for place, code in zip(at, codes):
        counts[code] = counts.get(code, 0) + 1
        while place - at[start] >= stretch:
            old = codes[start]
            counts[old] -= 1
            if not counts[old]:
                del counts[old]
            start += 1
        if len(counts) >= need:
            if found and at[start] <= found[-1][1]:
                found[-1] = (found[-1][0], place, max(found[-1][2], len(counts)))
            else:
                found.append((at[start], place, len(counts)))
    return found


def templates_of(table: DataFrame, name_col: str = "template", text_col: str = "text",
                 most_chars: int = MOST_CHARS) -> dict[str, str]:
    """A table of whole license texts as templates; it goes to every task, so its size is checked.

    Rows without name or text are left out. Several texts of one name are variants: a text
    after the first (in text order) has its number at the name.
    """
    rows = table.where(F.col(name_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(name_col).cast("string").alias("name"), F.col(text_col).alias("text")).distinct()
    chars = rows.agg(F.sum(F.length("text") + F.length("name") + 1)).first()[0] or 0
    if chars > most_chars:
        raise ValueError(f"templates of {chars} characters; {most_chars} can go to every task")
    out: dict[str, str] = {}
    seen: dict[str, int] = {}
    for name, text in sorted(tuple(r) for r in rows.collect()):
        seen[name] = seen.get(name, 0) + 1
        out[name if seen[name] == 1 else f"{name}#{seen[name]}"] = text
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, containment: float = 0.8,
                  certainty: float = 0.999, id_col: str = "doc_id", text_col: str = "text",
                  slack: float = SLACK) -> DataFrame:
    """(doc_id, template, start, end, containment) of each license text in each document.

    ``start`` and ``end`` are character offsets of the words that matched. Words are
    runs of letters and digits, lower-cased; shingles are five words. An occurrence
    counts if a stretch of the document holds ``containment`` of the template's distinct
    shingles; it may be longer than the template by ``slack`` of its length, for words that
    were put in. ``templates`` is a mapping or a table (template, text); without it, the
    notices above.

    Defined cases: NULL and empty texts, and texts without words, hold nothing; no
    templates find nothing. Repeated rows repeat their results; rows without id are
    reported without id. Stretches that overlap are one occurrence. Templates are judged one
    by one, so a text may hold several at one place. Very long texts are scanned whole.
    Other columns are ignored.
    """
    if isinstance(templates, DataFrame):
        templates = templates_of(templates)
    library = Library(TEMPLATES if templates is None else templates, containment, certainty, slack)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(library)  # as large as the templates given

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, known = shared.value, _Hashes()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                shingles, sizes = shingles_of(texts, known)
                out, ids = [], part.column("doc_id").to_pylist()
                places: dict[int, list[re.Match]] = {}
                for text, name, a, b, share in find(library, shingles, sizes, containment):
                    words = places.setdefault(text, _places(texts[text]))
                    end = min(b + SHINGLE, len(words)) - 1
                    out.append((ids[text], name, words[a][0], words[end][1], share))
                if out:
                    yield pa.RecordBatch.from_pydict(
                        {n: [o[k] for o in out] for k, n in enumerate(
                            ["doc_id", "template", "start", "end", "containment"])},
                        pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("containment", pa.float64())]))

    return rows.mapInArrow(
        run, "doc_id bigint, template string, start bigint, end bigint, containment double")


def _places(text: str) -> list[tuple[int, int]]:
    """Character offsets of the words, in the text as given."""
    return [m.span() for m in WORD.finditer(text)]
