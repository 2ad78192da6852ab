"""License scans: winnowed fingerprints pick candidates, banded alignment decides.

Templates (short license notices and headers) are cut into words; the hashes of
every ``GRAM`` words in a row are winnowed (the least of each ``WINDOW`` in a row
is kept) into an inverted index ``fingerprint -> (template, place)``, which is
small, bounded by the templates, and travels inside the scan. A text's words
are winnowed alike; a shared fingerprint proposes a template at a diagonal
(place in the text less place in the template). Any run of ``GRAM + WINDOW - 1``
or more words that a text shares with a template shares a fingerprint.
Proposals of neighbouring diagonals are one; around each the template is aligned
with the text in a band of ``BAND`` words on either side (words match or not,
skipping costs one), and where at least ``COVERAGE`` of the template's words
match in order the finding is reported: template, matched share, and the span in
code points from the first to the last matched word.

Defined cases: null, empty and word-less texts have no findings; overlapping
findings of one template are reported once, the better covered first; findings
of different templates may overlap, as notices contain each other; equal texts
get equal findings; texts are scanned whole; an empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import small_batches

GRAM, WINDOW = 3, 2
BAND = 4
COVERAGE = 0.8
WORD = re.compile(r"[^\W_]+")

#: fixed values: the notices that are sought
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met:",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free-software": "This program is free software: you can redistribute it and/or modify it under the terms of "
                         "the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files (the \"Software\"), to deal in the Software without "
                      "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                      "distribute, sublicense, and/or sell copies of the Software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


@dataclass(frozen=True)
class Index:
    names: tuple[str, ...]
    words: tuple[tuple[int, ...], ...]  # of each template, as numbers
    vocabulary: dict[str, int]  # word -> number, from 1
    postings: dict[int, tuple[tuple[int, int], ...]]  # fingerprint -> (template, place)


def gram_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of every GRAM words in a row; the largest number where a word is in no
    template, so that it is kept only if all of a window's are such."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, foreign = np.zeros(n, np.uint64), np.zeros(n, bool)
    for j in range(GRAM):
        h = (h ^ ids[j:j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        foreign |= ids[j:j + n] == 0
    return np.where(foreign, np.iinfo(np.uint64).max, h >> np.uint64(1))


def winnow(h: np.ndarray) -> np.ndarray:
    """Places that are the least (the last of equal ones) of some WINDOW in a row."""
    if len(h) <= WINDOW:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.empty(0, np.int64)
    v = np.lib.stride_tricks.sliding_window_view(h, WINDOW)[:, ::-1]
    return np.unique(np.arange(len(v)) + WINDOW - 1 - v.argmin(1))


def build(templates: dict[str, str] = TEMPLATES) -> Index:
    names = tuple(sorted(templates))
    split = [WORD.findall(templates[n].lower()) for n in names]
    vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}
    words = tuple(tuple(vocabulary[w] for w in ws) for ws in split)
    postings: dict[int, list] = {}
    for t, ids in enumerate(words):
        h = gram_hashes(np.array(ids))
        for p in winnow(h).tolist():
            postings.setdefault(int(h[p]), []).append((t, p))
    return Index(names, words, vocabulary, {h: tuple(p) for h, p in postings.items()})


def align(template: tuple[int, ...], ids: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """Matched (template place, text place) pairs of the best alignment within BAND
    of the diagonal: a match gains two, a mismatch or a skipped word costs one;
    the text may begin and end anywhere."""
    m, width = len(template), 2 * BAND + 1
    score = np.zeros((m + 1, width + 2), np.int64)
    score[:, [0, -1]] = -1 << 30
    came = np.zeros((m + 1, width + 2), np.int8)
    for i in range(1, m + 1):
        for c in range(1, width + 1):
            j = i - 1 + diagonal + c - 1 - BAND  # the text word that stands against template word i
            inside = 0 <= j < len(ids)
            hit = inside and ids[j] == template[i - 1]
            options = (score[i - 1, c] + (2 if hit else -1) if inside else -1 << 30, score[i - 1, c + 1] - 1, score[i, c - 1] - 1)
            best = max(range(3), key=lambda o: (options[o], -o))
            score[i, c], came[i, c] = options[best], (1 if hit else 0) if best == 0 else best + 1
    c = 1 + int(np.argmax(score[m, 1:-1]))
    pairs, i = [], m
    while i > 0 and 1 <= c <= width:
        step = came[i, c]
        if step <= 1:
            if step == 1:
                pairs.append((i - 1, i - 1 + diagonal + c - 1 - BAND))
            i -= 1
        elif step == 2:
            i, c = i - 1, c + 1
        else:
            c -= 1
    return pairs[::-1]


def scan(text: str, index: Index) -> list[tuple[str, float, int, int]]:
    """(template, coverage, start, end) of every finding, by start."""
    words = WORD.findall(text.lower())
    ids = np.fromiter(map(index.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
    h = gram_hashes(ids)
    if not len(h):
        proposals = {(t, 0) for t in range(len(index.names))} if ids.any() else set()
    else:
        near = np.flatnonzero(h != np.iinfo(np.uint64).max)
        if not len(near):
            return []
        # windows reach WINDOW - 1 further; everything else keeps no fingerprint of a template
        kept = winnow(h)
        proposals = {(t, int(p) - q) for p in kept[np.isin(kept, near)] for t, q in index.postings.get(int(h[p]), ())}
    found, last = [], {}
    for t, d in sorted(proposals):
        if t in last and d - last[t] <= BAND // 2:
            continue
        last[t] = d
        pairs = align(index.words[t], ids, d)
        if pairs and len(pairs) >= COVERAGE * len(index.words[t]):
            found.append((len(pairs) / len(index.words[t]), t, pairs[0][1], pairs[-1][1]))
    if not found:
        return []
    # lower-casing may change lengths, so spans come from the text as it is
    spans = [m.span() for m in WORD.finditer(text)]
    if len(spans) != len(words):
        spans = lowered_spans(text)
    out = []
    for share, t, a, b in sorted(found, key=lambda f: (-f[0], f[1:])):
        if not any(t == u and a <= y and x <= b for _, u, x, y in out):
            out.append((share, t, a, b))
    return sorted(((index.names[t], share, spans[a][0], spans[b][1]) for share, t, a, b in out), key=lambda f: (f[2], f[3], f[0]))


def lowered_spans(text: str) -> list[tuple[int, int]]:
    """Spans in the text of the words of its lower-cased form."""
    low, back = [], []
    for i, c in enumerate(text):
        low.append(c.lower())
        back += [i] * len(low[-1])
    return [(back[m.start()], back[m.end() - 1] + 1) for m in WORD.finditer("".join(low))]


FOUND = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))


def findings(docs: DataFrame, index: Index | None = None, text_col: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with an array of ``(license, coverage, start, end)``."""
    built = index or build()

    @F.arrow_udf("array<struct<license:string,coverage:double,start:int,end:int>>")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("license", "coverage", "start", "end"), f)) for f in scan(t, built)]
                         for t in texts.to_pylist()], FOUND)

    return small_batches(docs).withColumn(name, found(F.coalesce(text_col, F.lit(""))))
