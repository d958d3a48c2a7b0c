"""Licence notices in texts: a paragraph classifier confirmed by templates.

A paragraph is a line with a word. Its features are the word 1-, 2- and 3-grams that it holds, of
words in lower case without punctuation. A softmax regression with an L1 penalty tells apart the
licence families, notices of any other licence (``unknown``), and everything else. It learns from
variants of the notices below, for ``unknown`` from the same notices under made-up names, for
everything else from sentences that only mention licences and from at most ``OTHER_LINES``
paragraphs, spread over the text, of each of ``OTHER_TEXTS`` texts. These are read whole; what
leaves the executors is which features they hold. A temperature fitted on variants that were left
out calibrates the probabilities of all classes; a paragraph whose best class stays below ``LEAST``
is not reported.

A prediction counts as confirmed if the paragraph holds at least ``CONFIRM`` of the word pairs of a
notice of that family and, where the notice names the family, one of the family's names: what
licences have in common confirms none of them. ``unknown`` is never confirmed, and reported only
where the paragraph holds one of the words ``SPOKEN``. Features without weight do not matter, so that a notice is also found in a long paragraph. The name of a licence
alone, as in a heading, counts only if the paragraph holds at most ``AROUND`` words besides it,
since prose names licences too.

A notice that is wrapped over lines is one paragraph too: within a block of lines that each hold a
word, templates are also compared over stretches of at most ``SPREAD`` times their length that run
across line ends. The lines of such a stretch are classified as one and replace the unconfirmed
predictions of its single lines; ``line`` is the first of them. Marks of comments are no words.

Defined results: NULL and empty texts have no paragraphs; repeated rows give repeated results; an
empty table gives no rows, and the classifier then learns from the notices alone. Very long texts
are read whole, one at a time; of two classes that are equally likely the first in the order of
``NOTICES`` counts. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.words import (
    Texts,
    sequence_hashes,
    slices,
    texts_of,
    unique_per_doc,
    windows_within,
    word_hashes,
    words_of,
)

#: Texts whose paragraphs stand for everything that is no licence, and paragraphs of each.
OTHER_TEXTS = 200
OTHER_LINES = 8
VARIANTS = 40
LEAST = 0.5
CONFIRM = 0.6
#: Words that a paragraph may hold besides the mere name of a licence.
AROUND = 4
PENALTY = 0.0005
SEED = 20_261
OTHER = "none"
UNKNOWN = "unknown"

#: Words over which a wrapped notice may be spread, as a multiple of those of its template.
SPREAD = 2

# The usual wording of notices by licence family.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "SPDX-License-Identifier: ISC",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This document is confidential and proprietary and may not be copied or distributed without permission.",
    ),
}
# Names that stand alone in a heading or a field.
NAMES = {
    "apache": ("Apache License 2.0", "Apache License, Version 2.0"),
    "mit": ("MIT License", "The MIT License (MIT)"),
    "gpl": ("GNU General Public License v3.0", "GNU General Public License, version 3"),
    "lgpl": ("GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1"),
    "agpl": ("GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3"),
    "bsd": ("BSD 3-Clause License", "BSD License"),
    "mpl": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    "epl": ("Eclipse Public License 2.0", "Eclipse Public License, version 2.0"),
    "isc": ("ISC License",),
    "cc0": ("CC0 1.0 Universal",),
    "unlicense": ("The Unlicense",),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    "proprietary": ("Proprietary and confidential",),
}
# The names of the families as plain words, digits as 0. Texts of notices that hold none need none.
CALLED = {
    "apache": ("apache license", "identifier apache"),
    "mit": ("mit license", "identifier mit"),
    "gpl": ("gnu general", "gpl"),
    "lgpl": ("gnu lesser", "lgpl"),
    "agpl": ("gnu affero", "agpl"),
    "bsd": ("bsd",),
    "mpl": ("mozilla public", "mpl"),
    "epl": ("eclipse public", "epl"),
    "isc": ("isc license", "identifier isc"),
    "cc0": ("cc0",),
    "unlicense": ("unlicense",),
    "cc-by": ("cc by", "creative commons attribution"),
    "cc-by-sa": ("cc by sa", "creative commons attribution sharealike"),
    "cc-by-nc": ("cc by nc", "creative commons attribution noncommercial"),
    "proprietary": (),
}
# Words after a name that make it the name of another licence.
CONTINUED = ("nc", "nd", "sa", "noncommercial", "noderivatives", "sharealike")
# Words of which a notice of an unknown licence holds one.
SPOKEN = ("license", "licence", "licensed", "licenced", "licenses", "licences", "copyright", "copyrighted", "copyleft")
# Sentences that speak of licences and grant none.
MENTIONS = (
    "The driver renewed a licence last year.",
    "A fishing license is required in this state.",
    "The public library is open to the general public.",
    "Permission to enter the building was granted.",
    "The software was released under pressure in version 2.0.",
    "This work is the result of many years of free software development.",
    "The committee discussed the terms of the agreement under which copies are distributed.",
    "Students learn about copyright law and the conditions of use.",
    "The band released a new album under the label.",
    "An Apache helicopter landed near the general hospital.",
    "Researchers at MIT published the results.",
    "The eclipse was visible from the public square.",
    "Creative people work in common spaces.",
)

_SPOKEN = {w.encode() for w in SPOKEN}
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[48:58] = 48
for _k in range(128):
    if not chr(_k).isalnum() and _k != 10:
        _PLAIN[_k] = 32


def paragraphs(texts: Texts) -> tuple[Texts, np.ndarray]:
    """Every line of every text as a text of plain words, and the text that it belongs to."""
    breaks = np.flatnonzero(texts.data == 10)
    inner = breaks[breaks + 1 < texts.offsets[np.searchsorted(texts.offsets, breaks, "right")]] + 1
    starts = np.sort(np.concatenate([texts.offsets[:-1][texts.sizes > 0], inner]))
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    return Texts(_PLAIN[texts.data], np.append(starts, len(texts.data)).astype(np.int64)), owner


def grams(lines: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all 1-, 2- and 3-grams, the line of each, and the number of words of the lines."""
    words = words_of(lines)
    hashes, doc = word_hashes(lines, words), words.doc
    values, of = [], []
    for k in (1, 2, 3):
        inside = np.flatnonzero(windows_within(words, k))
        values.append(sequence_hashes(hashes, k)[inside] + np.uint64(k))
        of.append(doc[inside])
    return np.concatenate(values), np.concatenate(of), words.counts


def _plain_words(paragraph: str) -> list[bytes]:
    return _PLAIN[np.frombuffer(paragraph.encode(), np.uint8)].tobytes().split()


def _pairs(words: list[bytes]) -> set[tuple]:
    return set(zip(words, words[1:], strict=False)) or {tuple(words)}


def _names_at(words: list[bytes], family: str) -> list[tuple[int, int]]:
    """Where the names of a family stand, as first and last place; not as part of another licence's name."""
    out = []
    for called in CALLED[family]:
        name = called.encode().split()
        for i in range(len(words) - len(name) + 1):
            after = words[i + len(name) : i + len(name) + 1]
            if words[i : i + len(name)] == name and not (after and after[0].decode("latin-1") in CONTINUED):
                out.append((i, i + len(name) - 1))
    return out


@dataclass
class Template:
    """Pairs of words, whether the family has to be named, and the most words that a paragraph may have."""

    family: str
    pairs: set
    named: bool
    most: int | None

    def holds(self, words: list[bytes]) -> bool:
        if self.most is not None and len(words) > self.most:
            return False
        if len(self.pairs & _pairs(words)) < CONFIRM * len(self.pairs):
            return False
        return not self.named or bool(_names_at(words, self.family))


def _templates(families: list[str]) -> dict[str, list[Template]]:
    out: dict[str, list[Template]] = {}
    for family in families:
        for text in NOTICES[family] + NAMES[family]:
            words = _plain_words(text)
            most = len(words) + AROUND if text in NAMES[family] else None
            out.setdefault(family, []).append(Template(family, _pairs(words), bool(_names_at(words, family)), most))
    return out


def _renamed(rng: np.random.Generator, family: str, notice: str) -> str | None:
    """The notice as plain words with a made-up name instead of the family's; None if it names no family."""
    words = _plain_words(notice)
    places = {i for first, last in _names_at(words, family) for i in range(first, last + 1)}
    own = [w for i, w in enumerate(words) if i in places and w not in (b"license", b"public", b"general", b"identifier")]
    if not own:
        return None
    letters = list("abcdefghijklmnopqrstuvwxyz")
    new = {w: "".join(rng.choice(letters, rng.integers(4, 11))) for w in own}
    return " ".join(new[w] if i in places and w in new else w.decode() for i, w in enumerate(words))


def _variants(rng: np.random.Generator, notice: str, count: int) -> list[str]:
    """The notice with words left out, before, after or between other words."""
    words, out = notice.split(), [notice]
    fill = "the this file project and see for details text data by author 2020 in it of".split()
    for _ in range(count - 1):
        kept = [w for w in words if rng.random() > 0.06] or words
        before = rng.choice(fill, rng.integers(0, 4)).tolist()
        after = rng.choice(fill, rng.integers(0, 4)).tolist()
        out.append(" ".join([*before, *kept, *after]))
    return out


def _pair_hashes(words: list[bytes]) -> np.ndarray:
    texts = texts_of(pa.array([b" ".join(words)], pa.binary()))
    return np.unique(sequence_hashes(word_hashes(texts, words_of(texts)), 2))


@dataclass
class Wording:
    """A template as the hashes of its pairs, for the search across line ends."""

    family: str
    pairs: np.ndarray
    need: int
    span: int
    named: bool
    most: int | None


def _wordings(families: list[str]) -> list[Wording]:
    out = []
    for family in families:
        for text in NOTICES[family] + NAMES[family]:
            words = _plain_words(text)
            pairs = _pair_hashes(words)
            if len(pairs):
                need = int(np.ceil(CONFIRM * len(pairs)))
                most = len(words) + AROUND if text in NAMES[family] else None
                out.append(Wording(family, pairs, need, SPREAD * len(words), bool(_names_at(words, family)), most))
    return out


def _windows(at: np.ndarray, pair: np.ndarray, block: np.ndarray, need: int, span: int) -> list[tuple[int, int]]:
    """Disjoint stretches, as first and last pair, that hold ``need`` different pairs; fullest first, then shortest.

    ``at`` are the ascending places of a template's pairs, ``pair`` and ``block`` their kinds and blocks.
    """
    stop = np.minimum(np.searchsorted(at, at + span), np.searchsorted(block, block, "right"))
    found = []
    for i in np.flatnonzero(stop - np.arange(len(at)) >= need).tolist():
        kinds, where = np.unique(pair[i : stop[i]], return_index=True)
        if len(kinds) >= need:
            found.append((-len(kinds), int(at[i + where.max()] - at[i]), int(at[i])))
    out: list[tuple[int, int]] = []
    taken = np.zeros(int(at[-1] - at[0]) + 1 if found else 0, bool)
    for _, length, first in sorted(found):
        inside = slice(first - int(at[0]), first - int(at[0]) + length + 1)
        if not taken[inside].any():
            taken[inside] = True
            out.append((first, first + length))
    return out


@dataclass
class Classifier:
    """Sorted feature hashes, their weights per class, and how scores become probabilities."""

    classes: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    present: np.ndarray
    templates: dict[str, list[Template]]
    wordings: list[Wording]

    def probabilities(self, lines: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lines that hold a feature, their class probabilities, and the number of words of all lines."""
        values, of, counts = grams(lines)
        near = np.flatnonzero(self.present[(values & np.uint64(len(self.present) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.features, values[near]), len(self.features) - 1)
        known = self.features[at] == values[near]
        pairs = np.unique(of[near[known]].astype(np.int64) * len(self.features) + at[known])
        line, feature = pairs // len(self.features), pairs % len(self.features)
        lines_hit, begin = np.unique(line, return_index=True)
        if not len(lines_hit):
            return lines_hit, np.zeros((0, len(self.classes))), counts
        scores = np.add.reduceat(self.weights[feature], begin, axis=0) + self.bias
        scores = scores / self.temperature
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return lines_hit, scores / scores.sum(axis=1, keepdims=True), counts

    def confirmed(self, family: str, paragraph: bytes) -> bool:
        words = paragraph.split()
        return any(t.holds(words) for t in self.templates.get(family, ()))

    def wrapped(self, lines: Texts, owner: np.ndarray) -> list[tuple[int, int, str, float]]:
        """Notices that run across line ends: first and last line, family, probability."""
        words = words_of(lines)
        hashes, line, counts = sequence_hashes(word_hashes(lines, words), 2), words.doc, words.counts
        new = np.ones(len(lines), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (counts[1:] == 0) | (counts[:-1] == 0)
        block = np.cumsum(new)[line]
        known = np.unique(np.concatenate([w.pairs for w in self.wordings]))
        at = np.flatnonzero(block[:-1] == block[1:])
        where = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        hit = known[where] == hashes[at]
        at, where = at[hit], where[hit]
        families: dict[tuple[int, int], set[str]] = {}
        for w in self.wordings:
            own = np.isin(known, w.pairs)[where]
            places = at[own]
            for a, b in _windows(places, where[own], block[places], w.need, w.span):
                first, last = int(line[a]), int(line[b + 1])
                size = int(words.first[last + 1] - words.first[first])
                if first == last or (w.most is not None and size > w.most):
                    continue
                stretch = lines.data[lines.offsets[first] : lines.offsets[last + 1]].tobytes()
                if not w.named or _names_at(stretch.split(), w.family):
                    families.setdefault((first, last), set()).add(w.family)
        ranges = sorted(families)
        if not ranges:
            return []
        parts = [lines.data[lines.offsets[a] : lines.offsets[b + 1]] for a, b in ranges]
        joined = Texts(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64))
        hits, probabilities, _ = self.probabilities(joined)
        out: list[tuple[int, int, str, float]] = []
        for k, p in zip(hits.tolist(), probabilities, strict=True):
            (first, last), family, sure = ranges[k], self.classes[int(p.argmax())], float(p.max())
            # Templates of one family may find the same notice.
            again = any(f == family and a <= last and first <= b for a, b, f, _ in out[-len(self.wordings) :])
            if family in families[ranges[k]] and sure >= LEAST and not again:
                out.append((first, last, family, sure))
        return out


def _softmax(x: np.ndarray, y: np.ndarray, classes: int, weight: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """L1-penalised softmax regression by accelerated proximal steps."""
    n = weight.sum()
    target = np.zeros((len(y), classes), np.float32)
    target[np.arange(len(y)), y] = 1
    rate = 2 * n / (float((x * x).sum(axis=1).max()) * n + n)
    w, b = np.zeros((x.shape[1], classes), np.float32), np.zeros(classes, np.float32)
    w_at, b_at, t = w, b, 1.0
    for _ in range(steps):
        s = x @ w_at + b_at
        p = np.exp(s - s.max(axis=1, keepdims=True))
        off = (p / p.sum(axis=1, keepdims=True) - target) * (weight / n)[:, None]
        w_new = w_at - 8 * rate * (x.T @ off)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - 8 * rate * PENALTY, 0)
        b_new = b_at - 8 * rate * off.sum(axis=0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_at, b_at = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, b


def _matrix(held: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    """A row for each array of feature hashes."""
    x = np.zeros((len(held), len(features)), np.float32)
    for row, values in zip(x, held, strict=True):
        at = np.minimum(np.searchsorted(features, values), len(features) - 1)
        row[at[features[at] == values]] = 1
    return x


def _held(lines: Texts) -> list[np.ndarray]:
    """The hashes of the grams of every line."""
    values, of, _ = grams(lines)
    values, first = unique_per_doc(of, values, len(lines))
    return np.split(values, first[1:-1])


@dataclass
class Lessons:
    """Classes, the grams and the class of every sentence to learn from, and the grams that count."""

    classes: list[str]
    held: list[np.ndarray]
    y: np.ndarray
    features: np.ndarray


def lessons(left_out: tuple[str, ...] = ()) -> Lessons:
    """Variants of the notices, of the same under made-up names, and of the mentions."""
    rng = np.random.default_rng(SEED)
    families = [c for c in NOTICES if c not in left_out]
    classes = [OTHER, *families, UNKNOWN]
    samples = []
    for k, family in enumerate(families, 1):
        for notice in NOTICES[family] + NAMES[family]:
            samples += [(v, k) for v in _variants(rng, notice, VARIANTS)]
            renamed = [_renamed(rng, family, notice) for _ in range(VARIANTS // 4)]
            samples += [(_variants(rng, r, 2)[-1], len(classes) - 1) for r in renamed if r]
    samples += [(v, 0) for m in MENTIONS for v in _variants(rng, m, VARIANTS)]
    held = _held(paragraphs(texts_of(pa.array([" ".join(v.split()) for v, _ in samples])))[0])
    y = np.array([k for _, k in samples])
    features, counts = np.unique(np.concatenate([h for h, k in zip(held, y, strict=True) if k]), return_counts=True)
    return Lessons(classes, held, y, features[counts >= VARIANTS // 4])


def train(others: list[np.ndarray], left_out: tuple[str, ...] = ()) -> Classifier:
    """Learn from the notices, the mentions and ``others``, the features of paragraphs that are taken to be no licence.

    ``left_out`` names families to do without; their notices are of unknown licence then.
    """
    taught = lessons(left_out)
    classes, features = taught.classes, taught.features
    y = np.concatenate([taught.y, np.zeros(len(others), np.int64)])
    rng = np.random.default_rng(SEED + 1)
    x = _matrix([*taught.held, *others], features)
    weight = 1.0 / np.bincount(y, minlength=len(classes))[y]
    learn = rng.random(len(y)) < 0.8
    w, b = _softmax(x[learn], y[learn], len(classes), weight[learn].astype(np.float32))
    scores = x[~learn] @ w + b

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(axis=1, keepdims=True)
        own = s[np.arange(len(s)), y[~learn]] - np.log(np.exp(s).sum(axis=1))
        return float(-(own * weight[~learn]).sum())

    temperature = min(np.geomspace(0.05, 5, 60).tolist(), key=loss)
    used = np.abs(w).sum(axis=1) > 0
    features, w = features[used], w[used]
    present = np.zeros(1 << 20, bool)
    present[(features & np.uint64(len(present) - 1)).astype(np.int64)] = True
    return Classifier(classes, features, w, b, temperature, present, _templates(classes[1:-1]), _wordings(classes[1:-1]))


def other_paragraphs(docs: DataFrame) -> list[np.ndarray]:
    """The features of at most ``OTHER_LINES`` paragraphs of each of the ``OTHER_TEXTS`` texts with the smallest hash.

    The hash is of id and text; the paragraphs lie evenly over the text. Those that hold a notice are left out, since
    they must not be learnt as none.
    """
    rows = docs.where("text is not null").select(F.xxhash64("doc_id", "text").alias("h"), "text")
    bound = rows.select("h").orderBy("h").limit(OTHER_TEXTS).agg(F.max("h").alias("h")).first()["h"]
    if bound is None:
        return []
    known = docs.sparkSession.sparkContext.broadcast(lessons().features)

    def reduce(batches):
        features, templates = known.value, [t for group in _templates(list(NOTICES)).values() for t in group]
        for rows, texts in slices(batches):
            lines, owner = paragraphs(texts)
            spoken = np.flatnonzero(words_of(lines).counts)
            h, held = [], []
            for k in range(len(texts)):
                own = spoken[owner[spoken] == k]
                for i in own[np.unique(np.linspace(0, len(own) - 1, OTHER_LINES).astype(int))] if len(own) else ():
                    line = texts_of(pa.array([lines.bytes_of(i)], pa.binary()))
                    if not any(t.holds(lines.bytes_of(i).split()) for t in templates):
                        h.append(rows.column("h")[k].as_py())
                        held.append(np.intersect1d(_held(line)[0], features).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(held, pa.list_(pa.int64()))], ["h", "held"])

    # Equal rows teach once.
    found = rows.where(F.col("h") <= bound).dropDuplicates(["h"]).mapInArrow(reduce, "h bigint, held array<bigint>")
    listed = sorted((r["h"], r["held"]) for r in found.collect())
    return [np.array(held, np.int64).view(np.uint64) for _, held in listed]


def scan(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """``doc_id``, ``n_paragraphs`` and ``notices`` per row of ``docs``.

    ``notices`` lists the paragraphs with a licence family or ``unknown``: ``line`` (from 0), ``family``,
    ``probability`` and ``confirmed``.
    """
    model = train(other_paragraphs(docs)) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches):
        found = shared.value
        for rows, texts in slices(batches):
            lines, owner = paragraphs(texts)
            hit, probabilities, counts = found.probabilities(lines)
            by_line: dict[int, list[dict]] = {}
            if len(hit):
                best = probabilities.argmax(axis=1)
                sure = probabilities[np.arange(len(hit)), best]
                for k in np.flatnonzero((best > 0) & (sure >= LEAST)).tolist():
                    line, family = int(hit[k]), found.classes[best[k]]
                    if family == UNKNOWN and not _SPOKEN.intersection(lines.bytes_of(line).split()):
                        continue
                    sound = found.confirmed(family, lines.bytes_of(line))
                    by_line[line] = [{"family": family, "probability": float(sure[k]), "confirmed": sound}]
            for first, last, family, p in found.wrapped(lines, owner):
                inside = [n for line in range(first, last + 1) for n in by_line.get(line, [])]
                if any(n["family"] == family and n["confirmed"] for n in inside):
                    continue
                for line in range(first, last + 1):
                    by_line[line] = [n for n in by_line.get(line, []) if n["confirmed"]]
                by_line[first].append({"family": family, "probability": p, "confirmed": True})
            notices: list[list[dict]] = [[] for _ in range(len(texts))]
            for line in sorted(by_line):
                of = int(owner[line])
                at = line - int(np.searchsorted(owner, of))
                notices[of] += [{"line": at, **n} for n in by_line[line]]
            n = np.bincount(owner[counts > 0], minlength=len(texts))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(notices, _NOTICES)],
                ["doc_id", "n_paragraphs", "notices"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        search,
        f"doc_id {kind}, n_paragraphs bigint, "
        "notices array<struct<line: bigint, family: string, probability: double, confirmed: boolean>>",
    )


_NOTICES = pa.list_(
    pa.struct([("line", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("confirmed", pa.bool_())])
)
