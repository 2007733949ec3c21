"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Neighbouring lines that are not blank are one paragraph, so a notice may be wrapped and stand behind comment marks. A softmax
regression on sparse hashed word 1- to 3-grams gives each window of a paragraph, about as long as a template, a licence family
or the unknown class. It is fitted on templates of the families, altered at random (words dropped, swapped, added around them),
and, for the unknown class, on invented sentences with licence words and on lines of at most about ``sample_rows`` documents,
chosen by a hash of their id; lines of the sample that a template would confirm, or that are a part of one, are left out of it.
A part of both is held back: on it a temperature is set (least log loss), and the least probability at which at most one in a
thousand of the unknown lines still gets a family. A prediction counts as confirmed if a template of the same family shares at
least ``least_similarity`` of its word pairs with the window. As windows that share fewer with every template cannot be
confirmed, they are passed over before the classifier. Headings such as "MIT License" count where they are a whole line.

Defined results: a row for each notice that gets a family and is confirmed, with its first and last line. Of overlapping windows of
different families the most similar stays, then the longest, then the most probable; those of one family are one row. The
sentence that BSD licences of two and three clauses share counts as BSD-3-Clause. NULL and empty texts have no rows; repeated
rows give rows each. Without documents to learn from, the invented sentences alone make up the unknown class.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import arrow_map, batch_of
from rollbook.llm.hashing import Words, extend

UNKNOWN = "unknown"
#: Notices by which works name their licence, short and long; fixed values. Each is one paragraph or a part of one.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License.",
                   "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE "
                   "file distributed with this work for additional information regarding copyright ownership. The ASF licenses this "
                   "file to You under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License.",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
                   "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
                   "specific language governing permissions and limitations under the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 3 as published by the Free Software Foundation."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3.",
                 "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License"],
    "LGPL-2.1": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation; either version 2.1 of the License"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.",
                 "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met",
                     "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work (CC0 1.0)."],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved."],
}
#: Headings, which count only where they are a whole line.
HEADINGS = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache License Version 2.0, January 2004"],
    "GPL-3.0": ["GNU General Public License v3.0", "GNU General Public License, version 3"],
    "GPL-2.0": ["GNU General Public License v2.0", "GNU General Public License, version 2"],
    "LGPL-3.0": ["GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1"],
    "AGPL-3.0": ["GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License Version 2.0"],
    "ISC": ["ISC License", "The ISC License"],
    "Unlicense": ["The Unlicense"],
}
FAMILIES = [*TEMPLATES, UNKNOWN]
#: Parts of invented sentences of the unknown class.
_OPEN = ["the", "this", "our", "a", "all", "no", "licensed", "released", "under", "terms", "of", "work", "software", "public", "general",
         "rights", "reserved", "version", "license", "driving", "fishing", "permission", "free", "copy", "reader", "was", "is", "by", "in", "house"]
BUCKETS = 1 << 15
_WORD = regex.compile(rb"[^\x00-\x20\x21-\x2c\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(line: bytes) -> list[bytes]:
    """Lowered words; '-' and '.' stay inside them (version numbers, BY-NC)."""
    return [w for w in (x.strip(b"-.") for x in _WORD.findall(line.lower())) if w]


def features(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the word 1-, 2- and 3-grams of a paragraph."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    two = extend(hashes, 1, 2)
    three = extend(two, 2, 3)
    return (np.concatenate([hashes, two, three]) >> np.uint64(49)).astype(np.int64)


def similarity(paragraph: list[bytes], template: list[bytes]) -> float:
    """Share of the template's word pairs (words, if it has one) in the window of its length where most occur."""
    if len(template) < 2:
        return float(template[0] in paragraph) if template else 0.0
    wanted = {(a, b) for a, b in zip(template, template[1:])}
    found = [(a, b) if (a, b) in wanted else None for a, b in zip(paragraph, paragraph[1:])]
    if not any(found):
        return 0.0
    best = 0
    for i in range(max(1, len(found) - len(template) + 2)):
        best = max(best, len({p for p in found[i:i + len(template)] if p}))
    return best / len(wanted)


_PARSED = {f: [words_of(t.encode()) for t in texts] for f, texts in TEMPLATES.items()}
_PAIRS = {f: [set(zip(t, t[1:])) for t in parsed] for f, parsed in _PARSED.items()}
_HEADS = {tuple(words_of(t.encode())): f for f, texts in HEADINGS.items() for t in texts}


def nearest(paragraph: list[bytes], family: str) -> float:
    """The greatest similarity to a template of the family; a heading of the family has 1."""
    if _HEADS.get(tuple(paragraph)) == family:
        return 1.0
    return max((similarity(paragraph, t) for t in _PARSED.get(family, [])), default=0.0)


def part_of(line: list[bytes], family: str) -> bool:
    """Half of the word pairs of a line of four or more words are those of one template, as in a wrapped notice."""
    pairs = list(zip(line, line[1:]))
    return len(line) >= 4 and any(2 * sum(p in t for p in pairs) >= len(pairs) for t in _PAIRS[family])



class Seeker:
    """Finds the places of a text at which some template can be confirmed, by the word pairs it shares with them.

    Nothing else could be confirmed, so these windows are all that need be classified.
    """

    def __init__(self, least_similarity: float):
        self.templates = [t for parsed in _PARSED.values() for t in parsed]
        sets = [sorted(set(zip(t, t[1:]))) for t in self.templates]
        heads = [p for h in _HEADS for p in zip(h, h[1:])]
        self.number = {w: i for i, w in enumerate(sorted({w for p in sum(sets, heads) for w in p}), 1)}
        self.base = len(self.number) + 1
        pairs = {p: i for i, p in enumerate(sorted({p for x in sets for p in x}))}
        self.pair = np.full(self.base ** 2, -1, np.int32)
        self.member = np.zeros((len(pairs), len(sets)), bool)
        for p, i in pairs.items():
            self.pair[self.number[p[0]] * self.base + self.number[p[1]]] = i
        for t, x in enumerate(sets):
            self.member[[pairs[p] for p in x], t] = True
        self.need = np.array([next((c for c in range(1, len(x) + 1) if c / len(x) >= least_similarity), len(x) + 1) for x in sets])

    def windows(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, word after the last): for each template its best windows that do not overlap. b"" parts paragraphs."""
        number = self.number
        ids = np.fromiter((number.get(w, 0) for w in words), np.int64, len(words))
        found = self.pair[ids[:-1] * self.base + ids[1:]] if len(words) > 1 else np.zeros(0, np.int32)
        places = np.flatnonzero(found >= 0)
        if not len(places):
            return []
        kinds, breaks = found[places], np.flatnonzero([w == b"" for w in words])
        paragraph = np.searchsorted(breaks, places)
        out = set()
        member = self.member[kinds]
        for t in np.flatnonzero(member.sum(axis=0) >= self.need):
            own = member[:, t]
            at, kind, part, need, length = places[own], kinds[own].tolist(), paragraph[own].tolist(), int(self.need[t]), len(self.templates[t])
            enough = np.flatnonzero(at[need - 1:] - at[:len(at) - need + 1] < length)
            at, possible = at.tolist(), []
            for i in enough.tolist():
                seen, last, j = set(), i, i
                while j < len(at) and at[j] < at[i] + length and part[j] == part[i]:
                    if kind[j] not in seen:
                        seen.add(kind[j])
                        last = j
                    j += 1
                if len(seen) >= need:
                    possible.append((-len(seen), at[last] - at[i], at[i], at[last] + 2))
            taken = bytearray(len(words))
            for _, _, start, end in sorted(possible):
                if not any(taken[start:end - 1]):
                    taken[start:end - 1] = b"\1" * (end - 1 - start)
                    out.add((start, end))
        return sorted(out)


@dataclass
class Model:
    weights: np.ndarray      # buckets x classes
    bias: np.ndarray
    temperature: float
    least_probability: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(rows), len(self.bias)))
        for i, r in enumerate(rows):
            out[i] = self.weights[r].sum(axis=0) / np.sqrt(max(len(r), 1)) + self.bias
        return out


def _altered(template: list[bytes], rng: np.random.Generator, around: list[bytes]) -> list[bytes]:
    line = [w for w in template if len(template) <= 3 or rng.random() > 0.08]
    pick = lambda n: [around[i] for i in rng.integers(len(around), size=rng.integers(n))] if around else []
    return [*pick(5), *line, *pick(9)] if rng.random() < 0.6 else line


def _examples(corpus: list[list[bytes]], seed: int = 5) -> tuple[list[list[bytes]], np.ndarray]:
    rng = np.random.default_rng(seed)
    around = [w for line in corpus[:400] for w in line[:8]] + [w.encode() for w in _OPEN]
    lines, labels = [], []
    for i, family in enumerate(TEMPLATES):
        for template in [*_PARSED[family], *(list(h) for h, f in _HEADS.items() if f == family)]:
            for _ in range(120 if len(template) < 40 else 40):
                lines.append(_altered(template, rng, around))
                labels.append(i)
    invented = [[_OPEN[i].encode() for i in rng.integers(len(_OPEN), size=rng.integers(1, 14))] for _ in range(1500)]
    for n, line in enumerate(corpus + invented):
        if all(nearest(line, f) < 0.5 and not (n < len(corpus) and part_of(line, f)) for f in TEMPLATES):
            lines.append(line)
            labels.append(len(FAMILIES) - 1)
    return lines, np.array(labels)


def train(corpus: list[list[bytes]], epochs: int = 30) -> Model:
    """Full-batch training with adaptive steps on two thirds of the examples, calibration on the rest."""
    lines, labels = _examples(corpus)
    words = Words()
    rows = [features(words.array(x)) for x in lines]
    held = np.random.default_rng(9).random(len(rows)) < 1 / 3
    n = len(FAMILIES)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    bucket = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    value = 1 / np.sqrt(np.maximum([len(r) for r in rows], 1))
    used = ~held[owner]
    own, buck, val = owner[used], bucket[used], value[owner[used]]
    weights, bias, speed = np.zeros((BUCKETS, n)), np.zeros(n), np.full((BUCKETS, n), 1e-6)
    share = np.bincount(labels[~held], minlength=n).astype(float)
    cost = np.where(share > 0, share.sum() / np.maximum(share, 1) / n, 0)[labels] * ~held
    target = np.eye(n)[labels]
    order = np.argsort(buck, kind="stable")
    cuts = np.flatnonzero(np.diff(buck[order], prepend=-1))
    for _ in range(epochs):
        logits = np.zeros((len(rows), n))
        np.add.at(logits, own, weights[buck] * val[:, None])
        z = logits + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - target) * cost[:, None]
        steps = np.add.reduceat((error[own] * val[:, None])[order], cuts, axis=0) if len(cuts) else np.zeros((0, n))
        at = buck[order][cuts]
        steps += 1e-3 * weights[at]
        speed[at] += steps ** 2
        weights[at] -= 0.8 * steps / np.sqrt(speed[at])
        bias -= 0.1 * error.sum(axis=0) / max(1, (~held).sum())
    model = Model(weights.astype(np.float32), bias, 1.0, 0.5)
    tested = [r for r, h in zip(rows, held) if h]
    logits, truth = model.logits(tested), labels[held]
    losses = {}
    for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0):
        model.temperature = t
        losses[t] = -np.log(model.probabilities(logits)[np.arange(len(truth)), truth] + 1e-12).mean() if len(truth) else 0
    model.temperature = min(losses, key=losses.get)
    p = model.probabilities(logits)
    stray = np.sort(p[truth == n - 1, :-1].max(axis=1)) if (truth == n - 1).any() else np.zeros(1)
    model.least_probability = float(max(0.5, stray[min(len(stray) - 1, int(np.ceil(0.999 * len(stray))))]))
    return model


def sample_lines(docs: DataFrame, id_col: str, text_col: str, sample_rows: int, lines: int = 3) -> list[list[bytes]]:
    """A few paragraphs, chosen by hash, of each of at most about ``sample_rows`` documents."""
    n = docs.count()
    if not n:
        return []
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("licence")), F.lit(1 << 24)) / F.lit(float(1 << 24))
    each = F.slice(F.sort_array(F.transform(F.split(F.coalesce(text_col, F.lit("")), "\n"), lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x")))), 1, lines)
    rows = docs.where(draw < min(1.0, sample_rows / n)).select(F.explode(F.transform(each, lambda s: s["x"])).alias("x")).orderBy("x").collect()
    return [w for w in (words_of(r[0].encode("utf-8", "replace")) for r in rows) if w]


def paragraphs_of(text: bytes) -> tuple[list[bytes], list[int], list[tuple[int, int]]]:
    """(words, line of each, windows that are headings): neighbouring lines that are not blank are one paragraph; b"" parts two."""
    words, lines, heads = [], [], []
    for at, line in enumerate(text.split(b"\n")):
        parts = words_of(line)
        if parts:
            if len(parts) <= 8 and tuple(parts) in _HEADS:
                heads.append((len(words), len(words) + len(parts)))
            words += parts
            lines += [at] * len(parts)
        elif words and words[-1] and not line.strip():
            words.append(b"")
            lines.append(at)
    return words, lines, heads


def notices(text: bytes, model: Model, seeker: Seeker, known: Words, least_similarity: float) -> list[tuple[int, int, str, float, float]]:
    """(first line, last line, family, probability, similarity) of the confirmed windows of a text, none overlapping another."""
    words, lines, heads = paragraphs_of(text)
    found = []
    for start, end in dict.fromkeys(seeker.windows(words) + heads):
        parts = words[start:end]
        p = model.probabilities(model.logits([features(known.array(parts))]))[0]
        best = int(p.argmax())
        if best == len(FAMILIES) - 1 or p[best] < model.least_probability:
            continue
        near = nearest(parts, FAMILIES[best])
        if near >= least_similarity:
            found.append((-near, start - end, -float(p[best]), start, end, FAMILIES[best]))
    kept: list[list] = []
    owner: dict[int, int] = {}  # word -> row that holds it
    for near, _, p, start, end, family in sorted(found):
        over = {owner[w] for w in range(start, end) if w in owner}
        if not over:
            kept.append([start, end, family, -p, -near])
            over = {len(kept) - 1}
        if len(over) == 1 and kept[row := over.pop()][2] == family:
            kept[row][:2] = min(kept[row][0], start), max(kept[row][1], end)
            owner.update(dict.fromkeys(range(start, end), row))
    return [(lines[a], lines[b - 1], family, p, near) for a, b, family, p, near in sorted(kept)]


def scan(docs: DataFrame, model: Model, least_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, last_line, family, probability, similarity) of the confirmed notices: ``paragraph`` is the line on which
    the notice begins, ``last_line`` the one on which it ends, both counted from 0."""
    def work(batches):
        known, seeker = Words(), Seeker(least_similarity)
        for batch in batches:
            found = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found += [(i, *x) for x in notices((text or "").encode("utf-8", "replace"), model, seeker, known, least_similarity)]
            columns = list(zip(*found)) if found else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64())
            yield batch_of(**{n: pa.array(c, t) for n, c, t in zip("abcdef", columns, types)})
    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), work,
                     "a long, b long, c long, d string, e double, f double").toDF(
                         id_col, "paragraph", "last_line", "family", "probability", "similarity")
