"""Licence scan: sparse TF-IDF cosine of sentences to licence templates, then inheritance from directories.

Every sentence of every text is a sparse vector of its words; document frequencies of the templates' words are counted
over all documents first, other words weigh as much as a word can. A sentence matches the template with the largest
cosine of at least ``SIMILAR``. A document's own licence is the best match of its sentences; a document that consists
mostly of matching sentences is a licence file. Documents without an own licence inherit from the licence file in the
nearest directory above them, found by joins of paths with directories.

Null and empty texts match nothing and may inherit. A null path inherits nothing. Ties go to the first licence by name.
Very long texts are read whole, sentence by sentence. Repeated rows are judged alike. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W
from tillcast.session import stage

SIMILAR = 0.6
#: Share of a document's words in matching sentences from which it is a licence file.
MOSTLY = 0.5

#: Notices by which licences are declared, one sentence each.
TEMPLATES = (
    ("AGPL-3.0", "licensed under the GNU Affero General Public License version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License version 2.1"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved"),
)

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[list(_MARKS)] = 0x20


def _plain(texts: pa.Array) -> W.Words:
    """Words with ASCII marks taken as spaces."""
    data, offsets = W.text_bytes(texts)
    swapped = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_TO_SPACE[data])
    )
    return W.split(swapped)


def _sentences(texts: pa.Array) -> np.ndarray:
    """Where sentences end: after a line end, after ``.!?`` before white space, and where a text ends."""
    data, offsets = W.text_bytes(texts)
    line = np.flatnonzero(data == 0x0A) + 1
    mark = np.flatnonzero(np.isin(data[:-1], list(b".!?")) & np.isin(data[1:], list(b" \t\n\r"))) + 1
    return np.unique(np.concatenate([line, mark, offsets[1:]]))


class Vectors(NamedTuple):
    """Template terms (sorted hashes), their weights, the weight of other words, and templates as unit columns."""

    terms: np.ndarray
    weight: np.ndarray
    other: float
    matrix: np.ndarray
    names: list[str]


def _template_words(templates) -> list[np.ndarray]:
    words = _plain(pa.array([text for _, text in templates], pa.large_string()))
    hashes = W.word_hashes(words)
    return [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def term_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[int, dict[int, int]]:
    """The number of documents, and in how many of them each template word occurs."""
    terms = np.unique(np.concatenate(_template_words(templates)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for _, part in W.slices(batch.column("text")):
                words = _plain(part)
                hashes = W.word_hashes(words)
                place = np.searchsorted(terms, hashes)
                place[place == len(terms)] = 0
                hit = terms[place] == hashes
                doc = np.repeat(np.arange(len(part)), np.diff(words.first))
                pairs = np.unique(doc[hit] * len(terms) + place[hit])
                counts += np.bincount(pairs % len(terms), minlength=len(terms))
            total += len(batch)
        # A row without a term has the number of documents.
        arrays = [pa.array([*range(len(terms)), -1], pa.int64()), pa.array([*counts.tolist(), total], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", "n"])

    rows = W.by_batch(docs.select(F.col("text").cast("string")), run, "term long, n long")
    got = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return got.pop(-1, 0), {int(terms[i]): n for i, n in got.items()}


def vectors(total: int, frequency: dict[int, int], templates=TEMPLATES) -> Vectors:
    own = _template_words(templates)
    terms = np.unique(np.concatenate(own))
    weight = np.array([math.log((total + 1) / (frequency.get(int(t), 0) + 1)) + 1 for t in terms])
    matrix = np.zeros((len(terms), len(own)))
    for column, hashes in enumerate(own):
        np.add.at(matrix[:, column], np.searchsorted(terms, hashes), 1)
    matrix *= weight[:, None]
    matrix /= np.linalg.norm(matrix, axis=0)
    return Vectors(terms, weight, math.log(total + 1) + 1, matrix, [name for name, _ in templates])


def _matches(texts: pa.Array, v: Vectors) -> tuple[np.ndarray, ...]:
    """Of the sentences that match: text, template and cosine, and the number of words; and the words of each text."""
    words = _plain(texts)
    hashes = W.word_hashes(words)
    sentence = np.searchsorted(_sentences(texts), words.start, "right")
    place = np.searchsorted(v.terms, hashes)
    place[place == len(v.terms)] = 0
    known = v.terms[place] == hashes
    total = np.diff(words.first)
    doc = np.repeat(np.arange(len(texts)), total)
    if not known.any():
        return (*(np.zeros(0, np.int64),) * 4, total)
    candidates = np.unique(sentence[known])
    within = np.isin(sentence, candidates)
    sentence, hashes, place, known, doc = (x[within] for x in (sentence, hashes, place, known, doc))
    order = np.lexsort((hashes, sentence))
    sentence, hashes, place, known, doc = (x[order] for x in (sentence, hashes, place, known, doc))
    new = np.ones(len(sentence), bool)
    new[1:] = (sentence[1:] != sentence[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(sentence)))
    sentence, place, known, doc = (x[first] for x in (sentence, place, known, doc))
    value = count * np.where(known, v.weight[place], v.other)
    number = np.searchsorted(candidates, sentence)
    norm = np.sqrt(np.bincount(number, value**2, len(candidates)))
    dots = np.zeros((len(candidates), v.matrix.shape[1]))
    np.add.at(dots, number[known], value[known, None] * v.matrix[place[known]])
    cosine = dots / norm[:, None]
    # Rounded, so that the order of summation decides no tie; the first template by name wins it.
    best = np.round(cosine, 12).argmax(axis=1)
    top = cosine[np.arange(len(candidates)), best]
    hit = top >= SIMILAR
    owner = np.zeros(len(candidates), np.int64)
    owner[number] = doc
    length = np.bincount(number, count, len(candidates)).astype(np.int64)
    return owner[hit], best[hit], top[hit], length[hit], total


def own_licences(docs: DataFrame, v: Vectors) -> DataFrame:
    """doc_id, path, own (licence or null), similarity and is_file for every row of ``docs`` (doc_id, path, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, similarity, is_file = [], [], []
            for _, part in W.slices(batch.column("text")):
                owner, template, cosine, length, total = _matches(part, v)
                best: dict[int, tuple[float, str]] = {}
                covered = np.bincount(owner, length, len(part)) if len(owner) else np.zeros(len(part))
                for doc, t, c in zip(owner.tolist(), template.tolist(), cosine.tolist(), strict=True):
                    found = (-round(c, 12), v.names[t])
                    best[doc] = min(best.get(doc, found), found)
                for doc in range(len(part)):
                    own.append(best[doc][1] if doc in best else None)
                    similarity.append(-best[doc][0] if doc in best else 0.0)
                    is_file.append(doc in best and covered[doc] >= MOSTLY * total[doc])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("path"), pa.array(own, pa.string()),
                 pa.array(similarity, pa.float64()), pa.array(is_file, pa.bool_())],
                names=["doc_id", "path", "own", "similarity", "is_file"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"))
    return W.by_batch(rows, run, "doc_id long, path string, own string, similarity double, is_file boolean")


def inherit(own: DataFrame) -> DataFrame:
    """``own`` with licence (own or inherited), origin (own, inherited or none) and directory (the licence file's).

    Directories, not files, are joined with the directories above them, so a directory with a third of all files is one
    row there; a directory with several licence files has the most similar one's licence, the first by name on a tie.
    """
    directory = F.regexp_replace("path", "/[^/]*$", "")
    rows = own.withColumn("here", F.when(F.col("path").contains("/"), directory))
    declared = rows.where("is_file AND here IS NOT NULL").groupBy("here")
    declared = declared.agg(F.min(F.struct((-F.col("similarity")).alias("s"), "own")).alias("best"))
    declared = declared.select(F.col("here").alias("above"), F.col("best.own").alias("inherited"))
    here = rows.where("here IS NOT NULL AND own IS NULL").select("here").distinct()
    parts = F.split("here", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    above = here.select("here", F.explode(ancestors).alias("above")).join(declared, "above")
    nearest = above.groupBy("here").agg(F.max(F.struct(F.length("above").alias("n"), "above", "inherited")).alias("x"))
    nearest = nearest.select("here", F.col("x.above").alias("above"), F.col("x.inherited").alias("inherited"))
    found = rows.join(nearest, "here", "left")
    mine = F.col("own").isNotNull()
    return found.select(
        "doc_id",
        "path",
        F.coalesce("own", "inherited").alias("licence"),
        "similarity",
        "is_file",
        F.when(mine, "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("above")).alias("directory"),
    )


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """The licence of every row of ``docs`` (doc_id, path, text): see ``inherit``."""
    own = own_licences(docs, vectors(*term_frequencies(docs, templates), templates))
    return inherit(stage(own, "licences"))
