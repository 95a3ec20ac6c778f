"""Licence families named in documents: a trained paragraph classifier, confirmed by comparison with templates.

Lines (long ones in overlapping windows, so that a notice inside a long line is not diluted), and then the lines of a
paragraph that name no family by themselves, joined, so that a wrapped notice is seen whole, are scored by a sparse logistic regression over hashed word one- and two-grams, with a class for each licence family, one for
licence talk of no known family, and one for everything else. Its probabilities are calibrated by temperature on templates
that it was not trained on; what is no family with enough confidence is `unknown`. A family counts only if the window
holds enough of the words of one of its templates, and of those words that no other licence has, and nothing that
makes it another licence: a clause, a version, another SPDX identifier, a "not" before it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.batches import pieces, sliced
from strataflow.llm.words import _STEP, mix, word_hashes

# Notices by which public licences are named, by family.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Released under the Apache 2.0 license.",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Released under the 2-clause BSD license.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under CC BY 3.0 unless otherwise noted.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under the GPL version 2.",
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT license.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Licence talk that names none of the families.
UNKNOWN_TALK = [
    "All rights reserved.",
    "Licensed under the terms of the agreement you accepted.",
    "Released under a proprietary license; see the enclosed terms.",
    "No part of this work may be reproduced without the written permission of the copyright holder.",
    "This software is licensed, not sold, and may be used only as the vendor permits.",
    "Published under an open licence chosen by the author.",
    "Use of this material is subject to the license of its publisher.",
    "Copyright by the authors, reprinted with permission.",
]
# Notices of licences that are no family here. They teach the class of unknown licences, and tell which words
# several licences share.
OTHERS = [
    "Licensed under the GNU Lesser General Public License, version 2.1.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "SPDX-License-Identifier: LGPL-2.1-or-later",
    "Licensed under the GNU Affero General Public License version 3.",
    "SPDX-License-Identifier: AGPL-3.0-only",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "Licensed under the Eclipse Public License.",
    "Licensed under CC BY-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "To the extent possible under law, the author has dedicated this work to the public domain under CC0 1.0 Universal.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Released under the ISC License.",
    "SPDX-License-Identifier: ISC",
    "This is free and unencumbered software released into the public domain.",
    "Released under the Unlicense.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Licensed under the EUPL, Version 1.2 or later.",
    "Licensed under the Common Development and Distribution License, Version 1.0.",
    "This software is provided 'as-is', without any express or implied warranty; see the zlib license.",
]
# What makes a notice of a family one of another licence.
CLAUSES = {"nc": "nc", "noncommercial": "nc", "sa": "sa", "sharealike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd"}
CLAUSES_OF = {"CC-BY": set(), "CC-BY-NC": {"nc"}, "CC-BY-SA": {"sa"}}
KIN = {"GPL": {"lesser", "library", "affero", "lgpl", "agpl"}}
VERSIONS = {"Apache-2.0": r"\bapache(?: software)?(?: license)?(?: version| v)? (\d+)", "MPL-2.0": r"\b(?:mozilla public license|mpl)(?: version| v)? (\d+)"}
NEGATED = re.compile(r"\b(?:not|never|nor|neither|no longer)(?: \w+)? (?:licensed|released|available|distributed|covered|published)\b")
SPDX = re.compile(r"(?i)(spdx-license-identifier:?\s*[a-z0-9.+-]+)")
# Stands behind an SPDX identifier, whose parts are words like others.
END = "endofid"
# Words that keep a paragraph out of the negative sample.
CUE = r"(?i)licen[cs]|copyright|rights reserved|creative commons|public domain|spdx|permission|redistribut|free software"

DIMS = 1 << 16
#: The bounded sample of paragraphs without a cue that the classifier is fitted on, and the variants of each template.
NEGATIVES, VARIANTS = 3000, 40
# So many times the sample's documents are looked at, as some have a cue.
OVERSAMPLE = 8
WINDOW, STRIDE = 24, 12
# Least probability of a family, and shares of a template's words and of its own words that a window has to hold.
CONFIDENT, AGREEMENT, KEYED = 0.6, 0.55, 0.5
NONE, UNKNOWN = "none", "unknown"


@dataclass
class Classifier:
    classes: list[str]
    weights: np.ndarray  # (DIMS, classes)
    bias: np.ndarray
    temperature: float
    templates: dict[str, list[Template]]


def grams(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each word and of each word with its follower; -1 for the last word of a text."""
    one = (hashes & np.uint64(DIMS - 1)).astype(np.int64)
    two = np.full(len(hashes), -1, np.int64)
    if len(hashes) > 1:
        pair = mix(hashes[:-1] * _STEP[20] + hashes[1:] * _STEP[21])
        two[:-1] = (pair & np.uint64(DIMS - 1)).astype(np.int64)
        last = bounds[1:] - 1
        two[last[(last >= 0) & (bounds[1:] > bounds[:-1])]] = -1
    return one, two


def plain(text: str) -> str:
    """Letters, digits and single spaces, so that signs around words don't matter; the end of an SPDX identifier is marked."""
    if "spdx" in text or "SPDX" in text:
        text = SPDX.sub(rf"\1 {END} ", text)
    return re.sub(r"[^0-9a-z]+", " ", text.lower()).strip()


def group(family: str) -> str:
    return family.partition("-")[0]


def words_of_groups() -> dict[str, set[str]]:
    """The words of the notices of each group of families, and of the other licences."""
    found: dict[str, set[str]] = {"": {w for t in (*OTHERS, *UNKNOWN_TALK) for w in plain(t).split()}}
    for family, templates in TEMPLATES.items():
        found.setdefault(group(family), set()).update(w for t in templates for w in plain(t).split())
    return found


@dataclass(frozen=True)
class Template:
    """A notice: its words, those that no other group of licences has, and its SPDX identifier if it is one."""

    words: frozenset[str]
    keys: frozenset[str]
    spdx: tuple[str, ...] | None

    @staticmethod
    def of(family: str, text: str, groups: dict[str, set[str]]) -> Template:
        words = plain(text).split()
        elsewhere = set().union(*(own for g, own in groups.items() if g != group(family)))
        keys = frozenset(w for w in words if w not in elsewhere and not w.isdigit())
        return Template(frozenset(words), keys, identifier(words))


def identifier(words: Sequence[str]) -> tuple[str, ...] | None:
    """The parts of the first SPDX identifier among the words, without `or later` and `only`."""
    if END not in words or "identifier" not in words[: words.index(END)]:
        return None
    end = words.index(END)
    start = end - 1 - list(words[:end])[::-1].index("identifier") + 1
    parts = list(words[start:end])
    for tail in (["or", "later"], ["only"], ["plus"]):
        if parts[-len(tail) :] == tail:
            parts = parts[: -len(tail)]
    return tuple(parts)


def same_identifier(own: tuple[str, ...], known: tuple[str, ...], family: str) -> bool:
    """Alike but for numbers, and with these too where the family is one version."""
    alike = lambda a, b: a == b or (a.isdigit() and b.isdigit() and family not in VERSIONS)
    return len(own) == len(known) and all(map(alike, own, known))


def window_scores(model: Classifier, lines: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, first word and class scores (mean weight of the features, plus bias) of every window of the lines' words."""
    hashes, bounds = word_hashes(lines)
    one, two = grams(hashes, bounds)
    each = model.weights[one] + np.where(two[:, None] >= 0, model.weights[two], 0)
    sums = np.concatenate([np.zeros((1, len(model.classes))), np.cumsum(each, axis=0, dtype=np.float64)])
    lengths = np.diff(bounds)
    n = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    line = np.repeat(np.arange(len(lengths)), n)
    start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    lo = bounds[line] + start
    hi = np.minimum(lo + WINDOW, bounds[line + 1])
    return line, start, (sums[hi] - sums[lo]) / np.sqrt(hi - lo)[:, None] + model.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def examples(negatives: Sequence[str], classes: Sequence[str], variants: int, seed: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Templates and their variants (cut, or with words of the negatives around), other licences, licence talk, and
    negatives; their classes; and which are held out for the temperature."""
    draw = np.random.default_rng(seed)
    filler = " ".join(negatives[:500]).split() or ["the"]
    texts, labels = [], []
    sources = [(c, i, t) for c in classes for i, t in enumerate(TEMPLATES.get(c, [*UNKNOWN_TALK, *OTHERS] if c == UNKNOWN else []))]
    held: list[bool] = []  # every third notice of a class, with all its variants, and every third negative
    for label, i, template in sources:
        words = plain(template).split()
        held += [i % 3 == 2] * variants
        for v in range(variants):
            before, after = (draw.choice(filler, draw.integers(0, 7)).tolist() if v else [] for _ in range(2))
            texts.append(" ".join([*before, *words[:WINDOW], *after]))
            labels.append(classes.index(label))
    texts += [plain(" ".join(t.split()[:WINDOW])) for t in negatives]
    labels += [classes.index(NONE)] * len(negatives)
    held += [i % 3 == 2 for i in range(len(negatives))]
    return texts, np.array(labels), np.array(held)


def train(negatives: Sequence[str], variants: int = VARIANTS, rounds: int = 300, seed: int = 3) -> Classifier:
    """Fit the regression without the held-out notices to find its temperature, and then on all of them."""
    classes, groups = [NONE, UNKNOWN, *sorted(TEMPLATES)], words_of_groups()
    templates = {c: [Template.of(c, t, groups) for t in own] for c, own in TEMPLATES.items()}
    texts, labels, held = examples(list(negatives), classes, variants, seed)
    hashes, bounds = word_hashes(texts)
    one, two = grams(hashes, bounds)
    lengths = np.diff(bounds)
    row = np.repeat(np.arange(len(texts)), lengths)
    at = np.concatenate([one, two[two >= 0]])
    of = np.concatenate([row, row[two >= 0]])
    value = 1 / np.sqrt(np.maximum(lengths, 1))[of]
    used, place = np.unique(at, return_inverse=True)
    target = np.eye(len(classes))[labels]

    def fitted(learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        per_class = np.bincount(labels[learned], minlength=len(classes)).clip(1)
        importance = (learned.sum() / len(classes) / per_class[labels])[:, None] * learned[:, None]
        w, b = np.zeros((len(used), len(classes))), np.zeros(len(classes))
        step_w, step_b = np.full(w.shape, 1e-8), np.full(b.shape, 1e-8)

        def scores() -> np.ndarray:
            out = np.tile(b, (len(texts), 1))
            for c in range(len(classes)):
                out[:, c] += np.bincount(of, w[place, c] * value, len(texts))
            return out

        for _ in range(rounds):  # gradient steps, scaled by the gradients so far
            error = (softmax(scores()) - target) * importance / max(1, learned.sum())
            gradient = np.stack([np.bincount(place, error[of, c] * value, len(used)) for c in range(len(classes))], axis=1) + 1e-5 * w
            step_w += gradient**2
            step_b += error.sum(axis=0) ** 2
            w -= 0.3 * gradient / np.sqrt(step_w)
            b -= 0.3 * error.sum(axis=0) / np.sqrt(step_b)
        return w, b, scores()

    final, tries = fitted(~held)[2][held], np.geomspace(0.25, 8, 41)
    losses = [-np.log(softmax(final / t)[np.arange(len(final)), labels[held]].clip(1e-12)).mean() for t in tries]
    w, b, _ = fitted(np.ones(len(texts), bool))
    weights = np.zeros((DIMS, len(classes)), np.float32)
    weights[used] = w
    return Classifier(classes, weights, b, float(tries[int(np.argmin(losses))]), templates)


def confirmed(words: Sequence[str], family: str, templates: Sequence[Template]) -> bool:
    """Whether a window of words is a notice of the family, as one of its templates says, and of no other licence."""
    own, text = set(words), " ".join(words)
    spdx = identifier(words)
    if spdx is not None:
        return any(t.spdx and same_identifier(spdx, t.spdx, family) for t in templates)
    number = re.search(VERSIONS[family], text) if family in VERSIONS else None
    if NEGATED.search(text) or (number and number[1] != "2"):
        return False
    if family in CLAUSES_OF and {CLAUSES[w] for w in own if w in CLAUSES} != CLAUSES_OF[family]:
        return False
    for t in templates:
        share = min(1.0, WINDOW / len(t.words))  # of a longer template a window has a part
        enough = len(own & t.words) >= AGREEMENT * share * len(t.words)
        if not enough or len(own & t.keys) < max(bool(t.keys), KEYED * share * len(t.keys)):
            continue
        places = [i for i, w in enumerate(words) if w in t.words]
        if not KIN.get(family, set()) & set(words[places[0] : places[-1] + 1]):
            return True
    return False


def held_by(line: str, templates: Sequence[Template]) -> bool:
    """Whether a template holds most of the words of a line."""
    own = set(line.split())
    return any(len(own & t.words) >= AGREEMENT * len(own) for t in templates)


def hits(model: Classifier, lines: Sequence[str]) -> Iterator[tuple[int, int, str]]:
    """Line, first word and family (or `unknown`) of every window of the cleaned lines that has one."""
    line, start, scores = window_scores(model, lines)
    for i in np.flatnonzero(scores.argmax(axis=1) != model.classes.index(NONE)):
        p = softmax(scores[i : i + 1] / model.temperature)[0]
        best = int(p.argmax())
        words = lines[line[i]].split()[start[i] : start[i] + WINDOW]
        family = model.classes[best]
        if family != UNKNOWN and p[best] >= CONFIDENT and confirmed(words, family, model.templates[family]):
            yield int(line[i]), int(start[i]), family
        elif 1 - p[model.classes.index(NONE)] >= CONFIDENT and re.search(CUE, " ".join(words)):
            yield int(line[i]), int(start[i]), UNKNOWN


def scan_lines(model: Classifier, lines: Sequence[str]) -> dict[int, set[str]]:
    """Families (or `unknown`) of the lines that have any."""
    found: dict[int, set[str]] = {}
    for line, _, family in hits(model, [plain(x) for x in lines]):
        found.setdefault(line, set()).add(family)
    for own in found.values():  # a neighbouring window that sees half a notice adds nothing
        if len(own) > 1:
            own.discard(UNKNOWN)
    return found


def paragraphs_of(text: str) -> list[list[str]]:
    """The lines of each paragraph; a line without a word ends one."""
    found: list[list[str]] = [[]]
    for line in re.split(r"\r\n|\r|\n", text):
        if re.search(r"\w", line):
            found[-1].append(line)
        elif found[-1]:
            found.append([])
    return [p for p in found if p]


def scan_paragraphs(model: Classifier, paragraphs: Sequence[Sequence[str]]) -> list[tuple[set[str], int]]:
    """Families (or `unknown`) of each paragraph, and the number of its notices.

    A line that names a family is a notice. Neighbouring lines that name none are joined: what windows over several of
    them name is a notice too. The `unknown` of a line that is part of a notice goes.
    """
    lines = [line for p in paragraphs for line in p]
    of = np.repeat(np.arange(len(paragraphs)), [len(p) for p in paragraphs])
    found = scan_lines(model, lines)
    runs: list[list[int]] = []
    for i in range(len(lines)):
        if not found.get(i, set()) - {UNKNOWN}:
            if runs and runs[-1][-1] == i - 1 and of[i] == of[i - 1]:
                runs[-1].append(i)
            else:
                runs.append([i])
    runs = [r for r in runs if len(r) > 1]
    cleaned = {i: plain(lines[i]) for r in runs for i in r}
    ends = [np.cumsum([len(cleaned[i].split()) for i in r]) for r in runs]
    families: list[set[str]] = [set() for _ in paragraphs]
    notices: Counter[int] = Counter()
    taken: set[int] = set()
    last: dict[tuple[int, str], int] = {}
    joined = [" ".join(cleaned[i] for i in r if cleaned[i]) for r in runs]
    for run, start, family in sorted(hits(model, joined), key=lambda h: h[2] == UNKNOWN):
        past = min(start + WINDOW, ends[run][-1])
        first, end = (int(np.searchsorted(ends[run], x, side="right")) for x in (start, past - 1))
        covered = runs[run][first : end + 1]
        if first == end or (family == UNKNOWN and any(i in taken or i in found for i in covered)):
            continue
        if start - last.get((run, family), -WINDOW) >= WINDOW:  # else it is the same notice
            notices[of[covered[0]]] += 1
        last[(run, family)] = start
        families[of[covered[0]]].add(family)
        if family != UNKNOWN:
            taken.update(covered)
            for i in covered:
                if i in found and held_by(cleaned[i], model.templates[family]):
                    del found[i]
    for i in [i for i, names in found.items() if names == {UNKNOWN}]:  # the rest of a notice that a line beside it names
        beside = [j for j in (i - 1, i + 1) if 0 <= j < len(lines) and of[j] == of[i]]
        if any(held_by(plain(lines[i]), model.templates[f]) for j in beside for f in found.get(j, set()) - {UNKNOWN}):
            del found[i]
    for i, names in found.items():
        families[of[i]] |= names
        notices[of[i]] += 1
    return [(f, notices[i]) for i, f in enumerate(families)]


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", negatives: int = NEGATIVES) -> Classifier:
    """Train on the templates and on `negatives` paragraphs without a licence cue, the first of the lowest-hashed documents."""
    clean = df.select(F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("t")).filter(F.col(key).isNotNull() & F.col("t").isNotNull())
    # So few rows are looked at that each task brings a handful, however many tasks there are.
    share = min(1.0, OVERSAMPLE * negatives / max(1, df.count()))
    clean = clean.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)))
    line = F.regexp_extract("t", r"([^\r\n]*\S[^\r\n]*)", 1)
    # `negatives` rows of one line come back, the first 400 characters of each, which are more than a window.
    first = clean.select("h", F.substring(line, 1, 400).alias("line")).filter(~F.col("line").rlike(CUE) & (F.col("line") != ""))
    return train([r[1] for r in first.orderBy("h", "line").limit(negatives).collect()])


def scan(df: DataFrame, model: Classifier, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add `licenses` (families found in the whole text, in order, `unknown` among them) and `n_notices` (lines with one,
    and notices over several lines).

    There is no shuffle. Null, empty and wordless texts have none; repeated rows have the same; an empty table gives an
    empty one. Input columns that clash with the added ones, in any case, are replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("licenses", "n_notices")]
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    shared = df.sparkSession.sparkContext.broadcast(model)  # DIMS * classes numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in sliced(batches):
            texts = batch.column(len(kept)).to_pylist()
            families: list[set[str]] = [set() for _ in texts]
            notices = [0] * len(texts)
            for lo, hi in pieces(texts):
                paragraphs, of = [], []
                for i in range(lo, hi):
                    own_paragraphs = paragraphs_of(texts[i] or "")
                    paragraphs += own_paragraphs
                    of += [i] * len(own_paragraphs)
                for i, (names, n) in zip(of, scan_paragraphs(own, paragraphs) if paragraphs else (), strict=True):
                    families[i] |= names
                    notices[i] += n
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [pa.array([sorted(f) for f in families], pa.list_(pa.string())), pa.array(notices, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "licenses", "n_notices"])

    return source.mapInArrow(run, (schema + ", " if schema else "") + "licenses array<string>, n_notices long")
