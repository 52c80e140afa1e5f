"""Licence families of paragraphs: sparse word n-gram logistic regression with an unknown class,
calibrated, and a comparison with templates that confirms each prediction."""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auricle.llm.common import stage

#: Notices of public licences, fixed values; several wordings for each family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ],
    "bsd": [
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "either version 2 of the GNU General Public License, or any later version",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "either version 3 of the GNU General Public License, or any later version",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 "
        "Universal.",
    ],
}
#: Paragraphs that speak of licences without granting one.
OTHERS = [
    "All rights reserved.",
    "Please bring your driving license and a permission slip.",
    "The license fee is due each year.",
    "Copyright by the author, all rights reserved worldwide.",
    "The general public was admitted to the software fair, version 3 of the event.",
]
FAMILIES = [*TEMPLATES, "unknown"]
FEATURES = 1 << 15
#: Paragraphs of the corpus that stand for the unknown class in training; the rest of the training
#: rows is made of the templates.
SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 4000
ROUNDS, RATE, PENALTY = 200, 2.0, 1e-4
VARIANTS = 24
#: A prediction needs this calibrated probability, and this share of a template's words in order.
ACCEPT, CONFIRM = 0.6, 0.7
#: Notices inside a paragraph are looked for in windows of so many times a template's words.
WINDOW = 1.5
_BLANKS = bytes(32 if chr(k) in string.punctuation or k < 32 else k for k in range(256))


def words_of(paragraph: bytes) -> np.ndarray:
    words = paragraph.lower().translate(_BLANKS).split()
    return np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))


def features(ids: np.ndarray) -> np.ndarray:
    """Hashed single words and pairs."""
    pairs = ids[:-1] * np.uint32(0x9E3779B1) + ids[1:] * np.uint32(0x85EBCA77)
    return (np.concatenate([ids, pairs ^ (pairs >> np.uint32(15))]) % FEATURES).astype(np.int64)


@dataclass
class Classifier:
    weight: np.ndarray  # (FEATURES, classes)
    bias: np.ndarray
    temperature: float

    def logits(self, paragraphs: list[np.ndarray]) -> np.ndarray:
        parts = [features(p) for p in paragraphs]
        sizes = np.array([len(p) for p in parts])
        out = np.tile(self.bias, (len(parts), 1))
        there = np.flatnonzero(sizes)
        if len(there):
            flat = np.concatenate([parts[k] for k in there])
            starts = np.cumsum([0, *sizes[there][:-1]])
            summed = np.add.reduceat(self.weight[flat], starts, axis=0)
            out[there] += summed / np.sqrt(sizes[there])[:, None]
        return out

    def probabilities(self, paragraphs: list[np.ndarray]) -> np.ndarray:
        return _softmax(self.logits(paragraphs) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _variants(rng: np.random.Generator) -> tuple[list[np.ndarray], list[int]]:
    """Templates, and copies with a few words lost or foreign words around them."""
    rows, kinds = [], []
    noise = rng.integers(0, 1 << 32, 4096, dtype=np.uint32)
    for k, family in enumerate(FAMILIES):
        for text in TEMPLATES.get(family, OTHERS):
            ids = words_of(text.encode())
            for turn in range(VARIANTS):
                kept = ids[rng.random(len(ids)) >= 0.08 * (turn % 3)]
                sides = [rng.choice(noise, rng.integers(0, 1 + 6 * (turn % 2))) for _ in "ab"]
                rows.append(np.concatenate([sides[0], kept, sides[1]]))
                kinds.append(k)
    return rows, kinds


def fit(docs: DataFrame, seed: int = 4) -> Classifier:
    """Trains on the templates and on a bounded sample of the corpus's own paragraphs.

    Of the sampled paragraphs those that hold most of a template teach nothing. Three quarters of
    the rows fit the weights; the others set the temperature that makes probabilities honest.
    """
    rng = np.random.default_rng(seed)
    total = docs.count()
    limit = int((1 << 40) * min(1.0, SAMPLE_DOCS / max(1, total)))
    text = F.col("text").cast("string")
    drawn = (
        docs.select(text.alias("text"))
        .where(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < limit)
        .select(F.explode(F.split("text", "\n")).alias("p"))
        .where("trim(p) <> ''")
        .select(F.substring("p", 1, 2000).alias("p"))
        .distinct()
        .orderBy(F.xxhash64("p"))
        .limit(SAMPLE_PARAGRAPHS)
        .collect()
    )
    rows, kinds = _variants(rng)
    templates = Templates()
    for row in drawn:
        ids = words_of(row["p"].encode())
        if len(ids) and max(templates.share(ids, f) for f in TEMPLATES) < CONFIRM:
            rows.append(ids)
            kinds.append(len(FAMILIES) - 1)
    order = rng.permutation(len(rows))
    rows, kind = [rows[k] for k in order], np.array(kinds)[order]
    held = np.arange(len(rows)) % 4 == 3
    model = Classifier(np.zeros((FEATURES, len(FAMILIES))), np.zeros(len(FAMILIES)), 1.0)
    fitted = [r for r, h in zip(rows, held) if not h]
    goal = np.eye(len(FAMILIES))[kind[~held]]
    # both sides count alike: the unknown class has many more rows
    share = 1 / np.maximum(1, goal.sum(axis=0))
    importance = goal @ share / len(FAMILIES)
    parts = [features(r) for r in fitted]
    sizes = np.array([max(1, len(p)) for p in parts])
    flat = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    scale = 1 / np.sqrt(sizes)
    for _ in range(ROUNDS):
        error = (_softmax(model.logits(fitted)) - goal) * importance[:, None]
        slope = PENALTY * model.weight
        back = error * scale[:, None]
        for c in range(len(FAMILIES)):
            slope[:, c] += np.bincount(flat, weights=back[owner, c], minlength=FEATURES)
        model.weight -= RATE * slope
        model.bias -= RATE * error.sum(axis=0)
    logits = model.logits([r for r, h in zip(rows, held) if h])
    best = None
    for temperature in np.geomspace(0.05, 4, 40):
        p = _softmax(logits / temperature)
        loss = -np.log(np.maximum(p[np.arange(len(p)), kind[held]], 1e-9)).mean()
        if best is None or loss < best:
            best, model.temperature = loss, float(temperature)
    return model


def _pair_codes(ids: np.ndarray) -> np.ndarray:
    return ids[:-1].astype(np.uint64) << np.uint64(32) | ids[1:].astype(np.uint64)


class Templates:
    """Compares a paragraph with the templates of a family, and finds them inside long ones."""

    def __init__(self) -> None:
        self._ids = {f: [words_of(t.encode()) for t in ts] for f, ts in TEMPLATES.items()}
        every = [ids for ts in self._ids.values() for ids in ts]
        codes = [np.unique(_pair_codes(ids)) for ids in every]
        self._known = np.unique(np.concatenate(codes))
        self._of_code: dict[int, list[int]] = {}
        for k, part in enumerate(codes):
            for code in part.tolist():
                self._of_code.setdefault(code, []).append(k)
        self._pairs = [len(part) for part in codes]
        self._reach = [int(WINDOW * len(ids)) for ids in every]

    def regions(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(begin, end) of the windows that hold enough word pairs of a template, best ones first,
        each from the first of its template's pairs to the last."""
        if len(ids) < 2:
            return []
        codes = _pair_codes(ids)
        at = np.searchsorted(self._known, codes)
        hits = np.flatnonzero(self._known[np.minimum(at, len(self._known) - 1)] == codes)
        places: dict[int, list[tuple[int, int]]] = {}
        for place, code in zip(hits.tolist(), codes[hits].tolist()):
            for k in self._of_code[code]:
                places.setdefault(k, []).append((place, code))
        found = set()
        for k, met in places.items():
            need = CONFIRM * self._pairs[k]
            if len(met) < need:
                continue
            inside: dict[int, int] = {}
            low = 0
            for place, code in met:
                inside[code] = inside.get(code, 0) + 1
                # out of reach, or held again further on
                while place + 2 - met[low][0] > self._reach[k] or inside[met[low][1]] > 1:
                    inside[met[low][1]] -= 1
                    if not inside[met[low][1]]:
                        del inside[met[low][1]]
                    low += 1
                if len(inside) >= need:
                    found.add((len(inside) / self._pairs[k], len(inside), met[low][0], place + 2))
        best = sorted(found, key=lambda r: (-r[0], -r[1], r[2], r[3]))
        return list(dict.fromkeys((begin, end) for _, _, begin, end in best))

    def share(self, paragraph: np.ndarray, family: str) -> float:
        """Largest share of a template's word pairs that the paragraph holds."""
        have = set(zip(paragraph.tolist(), paragraph[1:].tolist()))
        shares = []
        for ids in self._ids[family]:
            pairs = set(zip(ids.tolist(), ids[1:].tolist()))
            shares.append(len(pairs & have) / len(pairs))
        return max(shares)


def notices(
    lines: list[np.ndarray], model: Classifier, templates: Templates
) -> list[tuple[int, str, float, float]]:
    """(line, family, probability, similarity) of each notice in the word ids of a text's lines.

    Each line is classified by itself. Lines up to a blank one are also joined, and windows that hold
    enough of a template are classified, best ones first; each word belongs to one notice at most.
    Those that begin in a line that has the family already are not reported again.
    """
    found: dict[tuple[int, str], tuple[float, float]] = {}

    def add(first: list[int], paragraphs: list[np.ndarray]) -> list[bool]:
        p = model.probabilities(paragraphs)
        best = p.argmax(axis=1)
        taken = [False] * len(paragraphs)
        for k in np.flatnonzero((best < len(TEMPLATES)) & (p.max(axis=1) >= ACCEPT)).tolist():
            family = FAMILIES[best[k]]
            alike = templates.share(paragraphs[k], family)
            if alike >= CONFIRM:
                found.setdefault((first[k], family), (float(p[k, best[k]]), alike))
                taken[k] = True
        return taken

    add(list(range(len(lines))), lines)
    blank = [-1, *(k for k, line in enumerate(lines) if not len(line)), len(lines)]
    for before, after in zip(blank, blank[1:]):
        if after - before < 2:
            continue
        part = lines[before + 1 : after]
        ids = np.concatenate(part)
        regions = templates.regions(ids)
        if not regions:
            continue
        owner = np.repeat(np.arange(before + 1, after), [len(line) for line in part])
        taken: list[tuple[int, int]] = []
        for begin, end in regions:
            if any(begin < e and b < end for b, e in taken):
                continue
            if add([int(owner[begin])], [ids[begin:end]])[0]:
                taken.append((begin, end))
    return [(k, family, *found[k, family]) for k, family in sorted(found)]


def licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity): a row for each licence paragraph.

    Every line of every whole text of docs(doc_id, text, …) is classified, and notices that are wrapped
    over lines or stand inside longer ones are looked for in windows; those of a licence family with
    enough probability that a template of the family confirms are returned, with the number from 0 of
    the line they begin in. Null and blank texts have none; equal rows are reported apart; a null id
    stays null; extra columns are ignored; an empty table gives no rows.
    """
    model = fit(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            found = []
            for doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                lines = (cell.as_py() or b"").split(b"\n")
                met = notices([words_of(line) for line in lines], sent.value, templates)
                found += [(doc_id, *notice) for notice in met]
            columns = list(zip(*found)) if found else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)],
                names=["doc_id", "paragraph", "family", "probability", "similarity"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return stage(
        narrow.mapInArrow(
            run, "doc_id long, paragraph int, family string, probability double, similarity double"
        ),
        "licenses",
    )
