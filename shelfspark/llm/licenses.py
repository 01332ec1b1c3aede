"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

A template of m shingles is looked for in windows of three blocks of at least m / 2 shingles, one window from each block
on, so that a copy of the template lies inside some window as a whole. From the window's size follows the least Jaccard
similarity of a window that holds the wanted share of a template, and from that the number of bands: a window is missed
with a probability of at most ``miss``. What is retrieved is verified by counting the template's shingles in the window.

Words are compared without punctuation and comment marks at their edges, and marks that stand alone are no words, so that
copies in code, in other punctuation or reflowed match. Rows that hold too few of a plan's shingles to reach the wanted
share of any of its templates are left out before the bands: these could not be verified.

Templates are a fixed small list sent to all tasks; documents are scanned where they are, without a shuffle.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import words
from shelfspark.llm.storage import text_batches

# License notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}

MORE_NOTICES = {
    "agpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "agpl-3.0-preamble": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-terms": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions "
        'of this Creative Commons Attribution 4.0 International Public License ("Public License").'
    ),
    "cc-by-nc-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-sa-3.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-sa-4.0-terms": (
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions "
        'of this Creative Commons Attribution-ShareAlike 4.0 International Public License ("Public License").'
    ),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."
    ),
    "lgpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}
# Too short for a shingle of five words: looked for in shingles of their own length.
SHORT_NOTICES = {"all-rights-reserved": "All rights reserved."}
SHORT_WORDS = 3
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
# Notices that share most of their words or begin another one. One of which only words are found that another of its
# family, of which more is found, has too is no finding of its own.
FAMILIES = (
    ("apache-2.0", "apache-2.0-notice"),
    ("agpl-3.0-notice", "gpl-2.0-notice", "gpl-3.0-notice", "lgpl-2.1-notice", "lgpl-3.0-notice"),
    ("cc-by-4.0-terms", "cc-by-sa-4.0-terms"),
    ("cc-by-4.0-notice", "cc-by-nc-4.0-notice", "cc-by-sa-3.0-notice", "cc-by-sa-4.0-notice"),
    ("bsd-2-clause-text", "bsd-3-clause-text"),
    ("gpl-1.0-text", "gpl-2.0-text", "gpl-3.0-text", "lgpl-2.0-text", "lgpl-2.1-text", "lgpl-3.0-text"),
    ("mpl-1.1-text", "mpl-2.0-text"),
)
FAMILY = {name: i for i, names in enumerate(FAMILIES) for name in names}


def full_texts() -> dict[str, str]:
    """Whole licences, without the appendices on how to apply them."""
    out = {}
    for file in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, file), encoding="utf-8") as text:
            out[f"{file.removesuffix('.txt')}-text"] = text.read()
    return out


@dataclass(frozen=True)
class Settings:
    n_words: int = 5
    containment: float = 0.8
    miss: float = 1e-4


@dataclass(frozen=True)
class Plan:
    """Templates that share a shingle length and a block size, and their bands."""

    n_words: int
    block: int
    rows: int
    bands: int
    names: tuple[str, ...]
    sets: tuple[np.ndarray, ...]


def least_jaccard(m: int, block: int, containment: float) -> float:
    """Of a window of three blocks that holds the wanted share of a template of m shingles."""
    shared = math.ceil(containment * m)
    return shared / (3 * block + m - shared)


def bands_for(jaccard: float, miss: float) -> tuple[int, int]:
    """Rows a band and bands, so that a pair of this similarity shares no band with probability ``miss`` at most."""
    rows = 1 if jaccard < 0.4 else 2
    return rows, math.ceil(math.log(miss) / math.log1p(-(jaccard**rows)))


_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARKS = words.word_hashes(np.frombuffer(b"dnl rem", np.uint8), np.array([0, 4]), np.array([3, 7]))


def bare_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, places, first words of the rows) of words in lower case without punctuation at their edges.

    Words of punctuation alone and the comment words dnl and rem are left out. Places are those among all words of the chunk.
    """
    starts, ends, bounds = words.spans(data, offsets)
    inner = _INNER[data]
    if len(data) > 2:
        # General punctuation (quotes, dashes, dots), signs of Latin-1, and the mark that files begin with.
        wide = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) | (data[:-2] == 0xEF) & (data[1:-1] == 0xBB) & (data[2:] == 0xBF))
        inner[wide] = inner[wide + 1] = inner[wide + 2] = False
    if len(data) > 1:
        signs = np.flatnonzero((data[:-1] == 0xC2) & (data[1:] >= 0xA0) & (data[1:] < 0xC0))
        inner[signs] = inner[signs + 1] = False
    at = np.flatnonzero(inner)
    lo, hi = np.searchsorted(at, starts), np.searchsorted(at, ends)
    place = np.flatnonzero(lo < hi)
    hashes = words.word_hashes(data, at[lo[place]], at[hi[place] - 1] + 1, lower=True)
    word = ~np.isin(hashes, _MARKS)
    place = place[word]
    return hashes[word], place, np.searchsorted(place, bounds)


def plans(templates: dict[str, str], how: Settings) -> list[Plan]:
    by_block: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted(templates.items()):
        hashes = bare_words(*next(words.chunks(pa.array([text])))[1:])[0]
        if len(hashes) < how.n_words:
            raise ValueError(f"template {name} has fewer than {how.n_words} words")
        shingles = words.shingle_set(hashes, how.n_words)
        by_block.setdefault(1 << max(0, math.ceil(math.log2(len(shingles) / 2))), []).append((name, shingles))
    out = []
    for block, group in sorted(by_block.items()):
        least = min(least_jaccard(len(s), block, how.containment) for _, s in group)
        rows, bands = bands_for(least, how.miss)
        out.append(Plan(how.n_words, block, rows, bands, tuple(n for n, _ in group), tuple(s for _, s in group)))
    return out


def _hashed(shingles: np.ndarray, k: int) -> np.ndarray:
    """The k-th MinHash function."""
    a, b = (int(x) for x in words.mixed(np.array([2 * k, 2 * k + 1], np.uint64), 17))
    return (shingles ^ np.uint64(a)) * np.uint64(b | 1)


def _windows(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block starts, the last block of the window that begins with each block, and the row of each block.

    ``counts`` are shingles a row. A window ends with its row.
    """
    blocks = -(-counts // block)
    row = np.repeat(np.arange(len(counts)), blocks)
    first = np.cumsum(blocks) - blocks
    within = np.arange(len(row)) - first[row]
    start = (np.cumsum(counts) - counts)[row] + within * block
    last = np.minimum(np.arange(len(row)) + 2, (first + blocks - 1)[row])
    return start, last, row


def retrieved(shingles: np.ndarray, counts: np.ndarray, plan: Plan) -> Iterator[tuple[int, int, int, int]]:
    """(row, template, first shingle, end) of the windows that share a band with a template."""
    start, last, row = _windows(counts, plan.block)
    if not len(start):
        return
    hit = np.zeros((len(start), len(plan.sets)), bool)
    for band in range(plan.bands):
        same = np.ones((len(start), len(plan.sets)), bool)
        for k in range(band * plan.rows, (band + 1) * plan.rows):
            least = np.minimum.reduceat(_hashed(shingles, k), start)
            window = np.minimum(np.minimum(least, least[np.minimum(np.arange(len(least)) + 1, last)]), least[last])
            for t, own in enumerate(plan.sets):
                same[:, t] &= window == _hashed(own, k).min()
        hit |= same
    end = np.append(start[1:], len(shingles))[last]
    for b, t in zip(*np.nonzero(hit)):
        yield int(row[b]), int(t), int(start[b]), int(end[b])


MATCH = pa.schema([("doc_id", pa.int64()), ("template", pa.string()), ("containment", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
MATCH_SQL = "doc_id long, template string, containment double, first_word long, last_word long"


def _shingles(hashes: np.ndarray, bounds: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, how many each row has, and the word that each begins with. Those that would run over a row's end are left out."""
    counts = np.maximum(np.diff(bounds) - n_words + 1, 0)
    first = np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return words.runs_of(hashes, n_words)[first], counts, first


def able_rows(shingles: np.ndarray, counts: np.ndarray, plan: Plan, containment: float) -> np.ndarray:
    """Rows with at least as many shingles of the plan as the template that needs fewest; all others can hold none."""
    held = np.concatenate(([0], np.cumsum(np.isin(shingles, np.concatenate(plan.sets)))))
    ends = np.cumsum(counts)
    return held[ends] - held[ends - counts] >= min(math.ceil(containment * len(s)) for s in plan.sets)


def _own(found: dict[str, tuple[float, int, int, np.ndarray]]) -> dict[str, tuple[float, int, int, np.ndarray]]:
    """Without templates of a family of which nothing is found that is not found of another one, of which more is."""

    def hidden(name: str) -> bool:
        mine = found[name]
        for other, its in found.items():
            if other != name and name in FAMILY and FAMILY.get(other) == FAMILY[name] and np.isin(mine[3], its[3]).all():
                if len(its[3]) > len(mine[3]) or its[0] > mine[0]:
                    return True
        return False

    return {name: x for name, x in found.items() if not hidden(name)}


def _scan(how: Settings, all_plans: list[Plan]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            best: dict[int, dict[str, tuple[float, int, int, np.ndarray]]] = {}
            for first, data, offsets in words.chunks(batch.column("text")):
                hashes, place, bounds = bare_words(data, offsets)
                row_word = np.searchsorted(words.spans(data, offsets)[0], offsets)
                by_length = {n: _shingles(hashes, bounds, n) for n in {p.n_words for p in all_plans}}
                for plan in all_plans:
                    shingles, counts, begins = by_length[plan.n_words]
                    able = able_rows(shingles, counts, plan, how.containment)
                    if not able.any():
                        continue
                    of_able, rows = np.repeat(able, counts), np.flatnonzero(able)
                    shingles, begins = shingles[of_able], begins[of_able]
                    for r, t, lo, hi in retrieved(shingles, counts[able], plan):
                        held = np.isin(shingles[lo:hi], plan.sets[t])
                        own = np.unique(shingles[lo:hi][held])
                        share = len(own) / len(plan.sets[t])
                        if share < how.containment:
                            continue
                        at, row = np.flatnonzero(held), rows[r]
                        begin, end = begins[lo + at[0]], begins[lo + at[-1]] + plan.n_words - 1
                        found = share, -int(place[begin] - row_word[row]), int(place[end] - row_word[row]), own
                        known = best.setdefault(first + int(row), {})
                        if plan.names[t] not in known or found[:2] > known[plan.names[t]][:2]:
                            known[plan.names[t]] = found
            rows = [(docs[row], name, x[0], -x[1], x[2]) for row, found in sorted(best.items()) for name, x in sorted(_own(found).items())]
            columns = list(zip(*rows)) if rows else [[]] * len(MATCH)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MATCH)], schema=MATCH)

    return run


def licenses(df: DataFrame, templates: dict[str, str] | None = None, how: Settings = Settings()) -> DataFrame:
    """(doc_id, template, containment, first_word, last_word): each template found in each row of ``df`` (doc_id, text).

    The best window counts, the first of equals; words are counted from 0. Null, empty and short texts match nothing and
    give no row. A null doc_id stays null; repeated rows give repeated matches. Templates need ``how.n_words`` words. By
    default, all notices, the short ones in shingles of their own, and all whole licences are looked for.
    """
    if templates is None:
        wanted = plans(TEMPLATES | MORE_NOTICES | full_texts(), how) + plans(SHORT_NOTICES, replace(how, n_words=SHORT_WORDS))
    else:
        wanted = plans(templates, how)
    rows = text_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(how, wanted), MATCH_SQL)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All license notices and texts in all documents."""
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
