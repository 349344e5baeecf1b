"""Licence scan with a positional index of rare words.

1. Document frequencies of all licence words are counted over every document.
2. For each template whose key words a file all holds, the one of highest IDF
   looks up its places in the file; each place names an alignment, the difference
   of the two positions.  Alignments are verified: the template's mandatory key
   phrase must stand at its place, several words must agree, and the IDF-weighted
   share of template words that match there is the score.  As the key phrase is
   mandatory, no alignment is missed.
3. Base phrases are found in every place where their words stand consecutively.

Words are maximal runs of ASCII letters, digits and non-ASCII characters after
lower-casing A-Z.  Null and empty texts have no words, no labels and score 0.
Rows are neither dropped nor merged.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import ALPHANUMERIC, Words, hash_words, word_batches

# Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Label, mandatory key phrase, and the notice or opening words of each licence.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "licensed under the mit license"),
    ("apache", "apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "gnu general public license", "licensed under the gnu general public license"),
    ("lgpl", "gnu lesser general public license", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "gnu affero general public license", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0", "released under cc0 1 0 universal"),
    ("proprietary", "all rights reserved", "copyright all rights reserved"),
)

_LEAST_SCORE = 0.5


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return hash_words(data, np.array([0, len(data)]), ALPHANUMERIC)[2]


@lru_cache(maxsize=4)
def _index(templates: tuple) -> tuple[np.ndarray, list]:
    """Sorted word hashes, and templates as (label, ids, key start, key ids)."""
    words = sorted({w for _, key, notice in templates for w in f"{key} {notice}".split()})
    codes = np.sort(_hashes(words))
    ids = {w: int(np.searchsorted(codes, c)) for w, c in zip(words, _hashes(words), strict=True)}
    out = []
    for label, key, notice in templates:
        body, own = [ids[w] for w in notice.split()], [ids[w] for w in key.split()]
        at = next(i for i in range(len(body) - len(own) + 1) if body[i : i + len(own)] == own)
        out.append((label, np.array(body), at, np.array(own)))
    return codes, out


def _known(words: Words, codes: np.ndarray) -> np.ndarray:
    """Id of each word in the index, or -1."""
    at = np.minimum(np.searchsorted(codes, words.hash), len(codes) - 1)
    return np.where(codes[at] == words.hash, at, -1)


def word_frequencies(docs: DataFrame, text: str, templates: tuple) -> tuple[np.ndarray, int]:
    """Documents that hold each indexed word, and the number of documents. As many rows as indexed words reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _index(templates)[0]
        seen, n = np.zeros(len(codes), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for words in word_batches(batch.column(0), ALPHANUMERIC):
                known = _known(words, codes)
                hit = known >= 0
                pairs = np.unique(words.owner[hit] * len(codes) + known[hit])
                seen += np.bincount(pairs % len(codes), minlength=len(codes))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(codes))), pa.array(np.concatenate([[n], seen]))], ["word", "n"])

    rows = docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    by = {r["word"]: r["n"] for r in rows}
    return np.array([by.get(w, 0) for w in range(len(_index(templates)[0]))]), by.get(-1, 0)


def _aligned(known: np.ndarray, idf: np.ndarray, templates: tuple) -> list[tuple[str, int, float]]:
    """Verified (label, start, score) of one file, given the index id of each of its words."""
    held = np.zeros(len(idf), bool)
    held[known[known >= 0]] = True
    found = []
    for label, body, at, key in _index(templates)[1]:
        if not held[key].all():
            continue
        rare = int(np.argmax(idf[key]))
        places = np.flatnonzero(known == key[rare]) - rare
        places = places[(places >= 0) & (places + len(key) <= len(known))]
        for i, w in enumerate(key.tolist()):
            places = places[known[places + i] == w]
        for start in (places - at).tolist():
            match = _matches(known, body, start)
            if match.sum() < min(2, held[np.unique(body)].sum()):
                continue
            score = float(idf[body[match]].sum() / max(idf[body].sum(), 1e-12))
            if score >= _LEAST_SCORE:
                found.append((label, start, round(min(score, 1.0), 6)))
    return sorted(found)


def _matches(known: np.ndarray, body: np.ndarray, start: int) -> np.ndarray:
    """Which words of a template stand at their place when it starts at ``start``."""
    there = np.arange(start, start + len(body))
    inside = (there >= 0) & (there < len(known))
    match = np.zeros(len(body), bool)
    match[inside] = known[there[inside]] == body[inside]
    return match


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score and ``matches``, the verified (label, start, score)."""
    seen, n = word_frequencies(docs, text, templates)
    idf = np.array([math.log((1 + n) / (1 + s)) + 1 for s in seen.tolist()])
    phrases = [(_hashes(p.split()), label) for p, label in BASE.items()]
    kind = docs.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, out = _index(templates)
        wanted = [np.unique(k) for _, _, _, k in out]
        for batch in batches:
            cols: dict[str, list] = defaultdict(list)
            for words in word_batches(batch.column(1), ALPHANUMERIC):
                owner, m = words.owner, len(words.first) - 1
                starts, labels = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for which, (phrase, _) in enumerate(phrases):
                    k = len(phrase)
                    if len(words.hash) >= k:
                        hit = np.logical_and.reduce([words.hash[i : len(words.hash) - k + 1 + i] == phrase[i] for i in range(k)])
                        hit = np.flatnonzero(hit & (owner[: len(owner) - k + 1] == owner[k - 1 :]))
                        starts.append(hit)
                        labels.append(np.full(len(hit), which))
                places, which = np.concatenate(starts), np.concatenate(labels)
                known = _known(words, codes)
                hold = np.zeros((m, len(codes)), bool)
                hit = known >= 0
                hold[owner[hit], known[hit]] = True
                likely = np.logical_or.reduce([hold[:, k].all(axis=1) for k in wanted])
                base: dict[int, list] = defaultdict(list)
                for p, w in zip(places.tolist(), which.tolist(), strict=True):
                    base[int(owner[p])].append((p - int(words.first[owner[p]]), phrases[w][1]))
                for d in range(m):
                    low, high = int(words.first[d]), int(words.first[d + 1])
                    found = _aligned(known[low:high], idf, templates) if likely[d] else []
                    own = base.get(d, [])
                    cols["n_words"].append(high - low)
                    cols["n_base"].append(len(own))
                    cols["first_word"].append(min(p for p, _ in own) if own else None)
                    cols["last_word"].append(max(p for p, _ in own) if own else None)
                    named = {x for _, x in own}
                    cols["base_labels"].append(",".join(sorted(named)))
                    cols["labels"].append(",".join(sorted(named | {x[0] for x in found})))
                    cols["score"].append(max((x[2] for x in found), default=0.0))
                    cols["matches"].append([{"label": a, "start": b, "score": c} for a, b, c in found])
            longs = ("n_words", "n_base", "first_word", "last_word")
            arrays = [batch.column(0), *[pa.array(cols[c], pa.int64()) for c in longs], pa.array(cols["base_labels"], pa.string()), pa.array(cols["labels"], pa.string()), pa.array(cols["score"], pa.float64())]
            arrays.append(pa.array(cols["matches"], pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(arrays, [key, *longs, "base_labels", "labels", "score", "matches"])

    schema = f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,start:long,score:double>>"
    return docs.select(key, text).mapInArrow(apply, schema)
