"""Operator 2 -- license scan with a trained paragraph classifier.

Each paragraph (a line, or a run of neighbouring lines joined with a space) is classified by a multinomial logistic regression over hashed word 1- to 3-grams into a license
family or ``unknown``.  It is trained on variations of the notices in ``TEMPLATES`` (words left out, text around
them, every version number replaced by one placeholder) against ordinary lines of the corpus (at most ``MAX_UNKNOWN`` from whole texts, in the
order of a hash, of at most ``MAX_LINE`` characters each) and sentences that only sound like a license.  A held-out part sets the temperature, so that the
probabilities are calibrated; a family needs a probability of ``MIN_PROBABILITY``.  A prediction counts if the paragraph also
holds, in one sentence, ``MIN_CONTAINED`` of the word pairs of one of the family's notices, and no word in or beside them denies it
(``NEGATIONS``, up to ``BEFORE`` words before) or makes another license of it (``MODIFIERS``: NC, SA, ND, Affero, Lesser).

Wrapped notices: of a text that holds so many word pairs of a notice (pairs across a line break count), each shortest run of
two or more lines that holds them is classified and confirmed like a line, whatever its length; a line without words
ends a run.  A run that holds another counted one, or shares a line with a notice of the same family, is not counted again.  ``n_paragraphs`` counts
lines; ``paragraph`` is a notice's first line.

Plan: weights (2^BITS x families floats, fixed) are broadcast; a narrow ``mapInArrow`` scans whole texts, no shuffle.

Edge cases: null and empty texts have no paragraphs; several notices of a family count once in ``families``, each in
``n_notices``; ties between families go to the first by name; repeated rows are scanned each; an empty table gives an
empty result (and the classifier is trained without ordinary paragraphs); other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import byte_texts, map_text, mix64
from peerscope.llm.features import Hashed

BITS = 14
N = 3
MAX_UNKNOWN = 1500
MAX_LINE = 2000
SHORT = 12
VARIATIONS = 40
MIN_PROBABILITY, MIN_CONTAINED = 0.5, 0.75
ROUNDS, RATE, PENALTY, SEED = 150, 4.0, 1e-5, 3
CHUNK_BYTES = 1 << 20
UNKNOWN = "unknown"
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else (b if b == 10 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20) for b in range(256))

# Short public notices of license families.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
             "Licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License Version 3, 19 November 2007",
             "SPDX-License-Identifier: AGPL-3.0"),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "Distributed under the Apache 2.0 license.", "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Use of this source code is governed by a BSD-style license.", "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
              "SPDX-License-Identifier: CC-BY-4.0"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc-by-nc-nd": ("Licensed under CC BY-NC-ND 4.0.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
                    "SPDX-License-Identifier: CC-BY-NC-ND-4.0"),
    "cc-by-nc-sa": ("Licensed under CC BY-NC-SA 4.0.",
                    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
                    "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "SPDX-License-Identifier: CC-BY-ND-4.0"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "Released under the GNU General Public License, version 2 or later.", "GNU General Public License Version 3, 29 June 2007",
            "SPDX-License-Identifier: GPL-3.0"),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 3.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
             "GNU Lesser General Public License Version 3, 29 June 2007", "SPDX-License-Identifier: LGPL-3.0"),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
            "SPDX-License-Identifier: MIT"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0.",
            "SPDX-License-Identifier: MPL-2.0"),
}
#: Words that make another license of a notice, by what they add, and words that deny it.
MODIFIERS = {b"nc": "nc", b"noncommercial": "nc", b"commercial": "nc", b"sa": "sa", b"sharealike": "sa", b"alike": "sa", b"nd": "nd",
             b"noderivatives": "nd", b"noderivs": "nd", b"derivatives": "nd", b"affero": "affero", b"agpl": "affero", b"lesser": "lesser", b"lgpl": "lesser"}
MODIFIED = {"cc": ("nc", "sa", "nd"), "gpl": ("affero", "lesser"), "agpl": ("affero", "lesser"), "lgpl": ("affero", "lesser")}
NEGATIONS = frozenset((b"not", b"never", b"no", b"neither", b"nor", b"cannot", b"isn", b"aren", b"wasn", b"weren"))
BESIDE, BEFORE = 2, 4
FAMILIES = (UNKNOWN, *sorted(TEMPLATES))
LOOKALIKES = (
    "All rights reserved.", "You need a license to drive here.", "Released under the old bridge last summer.", "Licensed under the new rules.",
    "The work is under way and free of charge.", "Version 2.0 of the general terms was published.", "The foundation is public and free.",
    "This work is copyrighted by its authors.", "Use of this file is governed by the terms of service.", "A creative and common attribution.",
)


_VERSION = re.compile(rb"\d+(?:\.\d+)*")


def _plain(text: bytes) -> bytes:
    """Version numbers as one placeholder."""
    return _VERSION.sub(b"0", text)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, bucket) of every word n-gram, lines numbered over all texts; and each text's number of lines."""
    lines = [x for t in texts for x in (_plain(t).split(b"\n") if t else ())]
    per_text = np.array([t.count(b"\n") + 1 if t else 0 for t in texts], dtype=np.int64)
    if not lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), per_text
    h = Hashed(lines, _TABLE, BITS)
    owner = h.owners(h.starts)
    at, bucket = [owner], [h.word_hash]
    rolling = h.word_hash
    for k in range(1, N):
        if h.word_hash.size <= k:
            break
        rolling = mix64(rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + h.word_hash[k:])
        same = owner[k:] == owner[:-k]
        at.append(owner[:-k][same])
        bucket.append(rolling[same])
    return np.concatenate(at), (np.concatenate(bucket) >> np.uint64(64 - BITS)).astype(np.int64), per_text


def _pairs(line: bytes) -> set[tuple[bytes, bytes]]:
    words = _plain(line).translate(_TABLE).split()
    return set(zip(words, words[1:]))


@dataclass
class Model:
    weights: np.ndarray         # buckets x families
    bias: np.ndarray
    temperature: float

    def probabilities(self, at: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """(lines x families); sums over a line's n-grams are scaled by the root of their number."""
        z = np.zeros((n, self.bias.size))
        for k in range(self.bias.size):
            z[:, k] = np.bincount(at, weights=self.weights[bucket, k], minlength=n)
        count = np.bincount(at, minlength=n)
        z = (z / np.sqrt(np.maximum(1, count))[:, None] + self.bias) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def _words(text: str) -> set[bytes]:
    return set(_plain(text.encode()).translate(_TABLE).split())


def _others(family: str) -> set[bytes]:
    """Words of the notices of other families."""
    return {w for f, own in TEMPLATES.items() if f != family for t in own for w in _words(t)}


def variations(ordinary: list[str], seed: int = SEED) -> list[tuple[str, int]]:
    """Training lines with the number of their family."""
    rng = np.random.default_rng(seed)
    out = [(t, 0) for t in (*ordinary, *LOOKALIKES)]
    filler = [w for t in ordinary[:200] for w in t.split()[:20]] or ["the", "of", "and"]
    for number, family in enumerate(FAMILIES[1:], 1):
        for template in TEMPLATES[family]:
            words = template.split()
            # a word without which the notice would be another family's, or nobody's, stays
            stays = {w for w in words if _adds(_words(w), family) or (len(words) <= SHORT and not _words(w) <= _others(family))}
            for v in range(VARIATIONS):
                keep = [w for w in words if v < 5 or rng.random() > 0.08 or w in stays]
                around = [str(rng.choice(filler)) for _ in range(int(rng.integers(0, 5)) if v >= 10 else 0)]
                cut = int(rng.integers(0, len(around) + 1))
                out.append((" ".join([*around[:cut], *keep, *around[cut:]]), number))
    for t in LOOKALIKES:
        out += [(f"{t} {rng.choice(filler)}", 0) for _ in range(VARIATIONS // 2)]
    return out


def train(ordinary: list[str], seed: int = SEED) -> Model:
    rows = variations(ordinary, seed)
    y = np.array([k for _, k in rows])
    n, classes = len(rows), len(FAMILIES)
    line, bucket, _ = _grams([t.replace("\n", " ").encode() or b" " for t, _ in rows])
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(line, minlength=n)))
    held = np.random.default_rng(seed + 1).random(n) < 0.2
    target = np.eye(classes)[y]
    share = np.where(held, 0, 1 / np.bincount(y, minlength=classes)[y])       # families weigh the same
    share /= share.sum()
    weights, bias = np.zeros((1 << BITS, classes)), np.zeros(classes)
    mw, mb = np.zeros_like(weights), np.zeros_like(bias)

    def logits():
        return np.stack([np.bincount(line, weights=weights[bucket, k], minlength=n) for k in range(classes)], 1) * scale[:, None] + bias

    for _ in range(ROUNDS):
        z = logits()
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - target) * share[:, None]
        gw = np.stack([np.bincount(bucket, weights=(g[:, k] * scale)[line], minlength=1 << BITS) for k in range(classes)], 1)
        mw = 0.9 * mw - RATE * (gw + PENALTY * weights)
        mb = 0.9 * mb - RATE * g.sum(0)
        weights, bias = weights + mw, bias + mb
    z, own = logits()[held], y[held]
    best = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 4.0), key=lambda t: _log_loss(z / t, own)) if own.size else 1.0
    return Model(weights.astype(np.float32), bias, best)


def _log_loss(z: np.ndarray, y: np.ndarray) -> float:
    z = z - z.max(1, keepdims=True)
    return float((np.log(np.exp(z).sum(1)) - z[np.arange(y.size), y]).mean())


_SENTENCE = re.compile(rb"[.!?]\s+(?=[A-Z\"(])")


def _sentences(line: bytes) -> list[list[bytes]]:
    return [x for x in (_plain(part).translate(_TABLE).split() for part in _SENTENCE.split(line)) if x]


def _span(words: list[bytes], pairs: set, share: float) -> tuple[int, int]:
    """First and last word of the shortest stretches that hold ``share`` of ``pairs``, all together."""
    held: Counter = Counter()
    left, out = 0, (0, 0)
    at = [k for k in range(len(words) - 1) if (words[k], words[k + 1]) in pairs]
    for k in at:
        held[words[k], words[k + 1]] += 1
        while len(held) >= share * len(pairs):
            first = at[left]
            gone = (words[first], words[first + 1])
            if held[gone] == 1 and len(held) - 1 < share * len(pairs):
                out = (min(out[0], first) if out[1] else first, k + 1)
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            left += 1
    return out


def _adds(words, family: str) -> set[str]:
    own = MODIFIED.get("cc" if family.startswith("cc-") else family, ())
    return {MODIFIERS[w] for w in words if MODIFIERS.get(w) in own}


def _refuted(words: list[bytes], family: str, notice: list[bytes], pairs: set, share: float) -> bool:
    """Whether words in or beside the notice deny it or make another license of it (a word of the notice itself does not)."""
    a, b = _span(words, pairs, share)
    if _adds(words[max(0, a - BESIDE):b + 1 + BESIDE], family) != _adds(notice, family):
        return True
    return sum(w in NEGATIONS for w in words[max(0, a - BEFORE):b + 1]) > sum(w in NEGATIONS for w in notice)


def contained(line: bytes, family: str) -> float:
    """Largest share of a notice's word pairs that the line holds."""
    own = _pairs(line)
    return max(len(own & p) / len(p) for _, p in _FAMILY[family])


def confirm(line: bytes, family: str, min_contained: float = MIN_CONTAINED) -> float:
    """Largest share of a notice's word pairs that a sentence of the line holds; notices that its words refute are left out."""
    best = 0.0
    for words in _sentences(line):
        own = set(zip(words, words[1:]))
        for notice, p in _FAMILY[family]:
            share = len(own & p) / len(p)
            if share > best and not (share >= min_contained and _refuted(words, family, notice, p, min_contained)):
                best = share
    return best


_FAMILY = {f: [(_plain(t.encode()).translate(_TABLE).split(), _pairs(t.encode())) for t in own] for f, own in TEMPLATES.items()}
_NOTICES = [(family, _pairs(t.encode())) for family, own in sorted(TEMPLATES.items()) for t in own]
_KNOWN = frozenset().union(*(p for _, p in _NOTICES))


def runs(text: bytes, min_contained: float = MIN_CONTAINED) -> list[tuple[int, int]]:
    """(first, last) of each notice's shortest runs of two or more lines that hold ``min_contained`` of its word pairs,
    short ones first."""
    words = _plain(text).translate(_TABLE)
    have = set(words.split())
    near = [p for _, p in _NOTICES if sum(a in have and b in have for a, b in p) >= min_contained * len(p)]
    if not near:
        return []
    found: list[tuple[tuple[bytes, bytes], int, int]] = []      # known pairs: first line, last line
    cuts, before = [], None
    for k, line in enumerate(words.split(b"\n")):
        own = line.split()
        if not own:
            before = None
            cuts.append(len(found))
            continue
        if before is not None and (before, own[0]) in _KNOWN:
            found.append(((before, own[0]), k - 1, k))
        found += [(pair, k, k) for pair in zip(own, own[1:]) if pair in _KNOWN]
        before = own[-1]
    out = set()
    for a, b in zip([0, *cuts], [*cuts, len(found)]):
        for pairs in near:
            block = [x for x in found[a:b] if x[0] in pairs]
            held: Counter = Counter()
            left = 0
            for pair, _, last in block:
                held[pair] += 1
                while len(held) >= min_contained * len(pairs):
                    gone, first, _ = block[left]
                    if held[gone] == 1 and len(held) - 1 < min_contained * len(pairs):
                        if last > first:
                            out.add((first, last))
                    held[gone] -= 1
                    if not held[gone]:
                        del held[gone]
                    left += 1
    return sorted(out, key=lambda x: (x[1] - x[0], x))


def _wrapped(text: bytes, single: list[dict], model: Model, min_probability: float, min_contained: float) -> list[dict]:
    """The notices that are runs of lines; ``single``: the ones on one line."""
    found = runs(text, min_contained)
    if not found:
        return []
    lines = text.split(b"\n")
    covered = {(n["paragraph"], n["family"]) for n in single}
    counted: list[tuple[int, int]] = []     # sorted, none holds another
    out = []
    for a, b in found:
        at = bisect_left(counted, (a, -1))
        if at < len(counted) and counted[at][1] <= b:
            continue
        whole = b" ".join(lines[a:b + 1])
        line, bucket, _ = _grams([whole])
        p = model.probabilities(line, bucket, 1)[0]
        best = int(p[1:].argmax()) + 1
        family = FAMILIES[best]
        if p[best] < min_probability or any((x, family) in covered for x in range(a, b + 1)):
            continue
        share = confirm(whole, family, min_contained)
        if share >= min_contained:
            covered |= {(x, family) for x in range(a, b + 1)}
            counted.insert(at, (a, b))
            out.append({"paragraph": a, "family": family, "probability": float(p[best]), "contained": share})
    return out


def ordinary_lines(docs: DataFrame, text: str = "text", k: int = MAX_UNKNOWN) -> list[str]:
    """The ``k`` distinct lines of at most ``MAX_LINE`` characters with the smallest hash, from anywhere in the whole texts.
    Lines are cut to some by their hash before they are made distinct, so the texts are not shuffled; where copies
    leave too few, eight times as many compete."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line")).where(F.length("line").between(1, MAX_LINE))
    h = F.pmod(F.xxhash64("line"), F.lit(1 << 40))
    share = 4 * k / max(1, lines.count())
    while True:
        some = lines.where(h < F.lit(int((1 << 40) * share))) if share < 1 else lines
        got = some.distinct().orderBy(h, "line").limit(k).collect()
        if len(got) == k or share >= 1:
            return sorted(r["line"] for r in got)
        share *= 8


def fit(docs: DataFrame, text: str = "text", max_unknown: int = MAX_UNKNOWN) -> Model:
    """Trained against at most ``max_unknown`` ordinary lines; those that hold a notice are left out."""
    return train([t for t in ordinary_lines(docs, text, max_unknown) if max(contained(t.encode(), f) for f in TEMPLATES) < 0.3])


SCHEMA = ("n_paragraphs long, n_notices long, families array<string>, "
          "notices array<struct<paragraph:int,family:string,probability:double,contained:double>>")


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", min_probability: float = MIN_PROBABILITY,
         min_contained: float = MIN_CONTAINED) -> DataFrame:
    """Every row of ``docs``: doc_id, n_paragraphs, n_notices, families (sorted) and the confirmed notices."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def step(chunk: pa.RecordBatch) -> dict:
        texts = byte_texts(chunk)
        line, bucket, per_text = _grams(texts)
        total = int(per_text.sum())
        p = held.value.probabilities(line, bucket, total) if total else np.zeros((0, len(FAMILIES)))
        p[np.bincount(line, minlength=total) == 0, 1:] = 0      # a line without words is nothing
        best = p[:, 1:].argmax(1) + 1 if total else np.zeros(0, int)
        hits = np.flatnonzero(p[np.arange(total), best] >= min_probability) if total else []
        first = np.cumsum(per_text) - per_text
        notices: list[list[dict]] = [[] for _ in texts]
        for k in hits:
            own = int(np.searchsorted(first, k, side="right")) - 1
            while not per_text[own]:
                own -= 1
            number, family = int(k - first[own]), FAMILIES[best[k]]
            share = confirm(texts[own].split(b"\n", number + 1)[number], family, min_contained)
            if share >= min_contained:
                notices[own].append({"paragraph": number, "family": family, "probability": float(p[k, best[k]]), "contained": share})
        for t, own in zip(texts, notices):
            if b"\n" in t:
                own += _wrapped(t, own, held.value, min_probability, min_contained)
                own.sort(key=lambda n: (n["paragraph"], n["family"]))
        return {"doc_id": chunk.column("doc_id"), "n_paragraphs": per_text, "n_notices": [len(x) for x in notices],
                "families": [sorted({n["family"] for n in x}) for x in notices], "notices": notices}

    return map_text(rows, step, f"doc_id {kind}, {SCHEMA}", max_bytes=CHUNK_BYTES)
