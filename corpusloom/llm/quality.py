"""Quality classifier from weak labels.

1. Heuristic labellers vote on every document: good (1), bad (0) or nothing (-).
2. The counts of the vote patterns over all documents (at most 3 to the number
   of labellers, whatever the input) go through expectation-maximisation, which
   estimates how often each labeller says what of good and bad documents.
3. The posteriors of a bounded sample (``sample_rows``, about that many rows by
   hash of the id) train a logistic scorer over hashed words, word shapes and
   repetitions; it scores every document, and documents under 0.5 are rejected,
   unless no labeller says anything about them.

Cases: a null or empty text gets no votes, score 0 and is rejected; a text of a few words
is too short for the labellers and stays.  Without a
vote for "bad" anywhere every other document is kept.  Equal texts, repeated
rows among them, get equal scores.  A very long text is read whole.  Columns
whose names clash with the output's are kept apart by :func:`good_documents`.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import Scratch
from corpusloom.llm.words import SPACED, WHITESPACE, Words, mix, word_batches

DIMENSIONS = 1 << 15
SAMPLE_ROWS = 8000
#: Bytes of features of that sample that reach the driver; rows beyond, in the order of the hash, do not train.
SAMPLE_BYTES = 64 << 20
#: Labellers are silent on texts with fewer words than this; the scorer alone judges them.
LEAST_WORDS = 5

_CLASS = np.full(256, 3, dtype=np.int64)  # byte classes: 0 letter, 1 digit, 2 sentence mark, 3 symbol, 4 space
_CLASS[97:123] = 0
_CLASS[65:91] = 0
_CLASS[128:] = 0
_CLASS[48:58] = 1
_CLASS[list(b".,;:?!'\"()-")] = 2
_CLASS[list(WHITESPACE)] = 4

#: Labellers: name, feature, bad from, good up to. Between the two a labeller is silent.
LABELLERS = (
    ("repeats", "repeats", 0.2, 0.02),
    ("capitals", "capitals", 0.4, 0.15),
    ("symbols", "symbols", 0.06, 0.02),
    ("odd words", "odd", 0.2, 0.05),
    ("symbol runs", "runs", 0.03, 0.005),
    ("marks", "marks", 0.25, 0.12),
    ("exclaims", "exclaims", 0.03, 0.005),
    ("cells", "cells", 0.08, 0.01),
    ("bars", "bars", 0.015, 0.002),
    ("few words", "sameness", 0.75, 0.45),
    ("copied lines", "copied", 0.5, 0.1),
)


def _shares(words: Words, raw: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: the shares that labellers look at. ``raw`` are the bytes before lower-casing."""
    m = len(words.first) - 1
    text = np.repeat(np.arange(m), np.diff(words.origin))
    count = lambda mask: np.bincount(text[mask], minlength=m).astype(float)
    kinds = _CLASS[raw]
    letters = np.maximum(count(kinds == 0), 1)
    solid = np.maximum(count(kinds != 4), 1)
    n = np.diff(words.first).astype(float)
    owner = words.owner
    equal = np.zeros(m)
    if len(owner) > 1:
        same = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
        equal = np.bincount(owner[1:][same], minlength=m).astype(float)
    # distinct words among windows of 100 words, so that length does not matter
    window = (np.arange(len(owner)) - words.first[owner]) // 100 if len(owner) else np.zeros(0, np.int64)
    distinct = np.zeros(m)
    if len(owner):
        order = np.lexsort((words.hash, window, owner))
        o, w, h = owner[order], window[order], words.hash[order]
        fresh = np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1]) | (h[1:] != h[:-1])])
        distinct = np.bincount(o[fresh], minlength=m).astype(float)
    lone = np.bincount(owner[words.end - words.start == 1][words.data[words.start[words.end - words.start == 1]] == 124], minlength=m) if len(owner) else np.zeros(m)
    return {
        "words": n,
        "odd": np.bincount(owner[_CLASS[raw[words.end - 1]] == 3], minlength=m) / np.maximum(n, 1) if len(owner) else np.zeros(m),
        "runs": count(np.concatenate([[False], (raw[1:] == raw[:-1]) & (kinds[1:] == 3)])) / solid if len(raw) else np.zeros(m),
        "bars": count(raw == 124) / solid,
        "repeats": equal / np.maximum(n - 1, 1),
        "capitals": count((raw >= 65) & (raw <= 90)) / letters,
        "symbols": count((kinds == 3) & (raw != 124)) / solid,
        "marks": count(kinds == 2) / solid,
        "exclaims": count(raw == 33) / solid,
        "cells": lone / np.maximum(n, 1),
        "sameness": np.where(n >= 20, 1 - distinct / np.maximum(n, 1), 0.0),
        "copied": _copied_lines(words, raw, m),
    }


def _copied_lines(words: Words, raw: np.ndarray, m: int) -> np.ndarray:
    """Share of a text's lines that an earlier line equals, by the hash of the line's words."""
    if not len(words.hash):
        return np.zeros(m)
    breaks = np.cumsum(raw == 10)
    line = breaks[words.start]
    owner = words.owner
    new = np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(new)
    step = np.arange(len(line)) - np.repeat(at, np.diff(np.append(at, len(line))))
    code = np.add.reduceat(mix(words.hash + step.astype(np.uint64)), at)
    who = owner[at]
    order = np.lexsort((code, who))
    again = (code[order][1:] == code[order][:-1]) & (who[order][1:] == who[order][:-1])
    return np.bincount(who[order][1:][again], minlength=m) / np.maximum(np.bincount(who, minlength=m), 1)


def _votes(shares: dict[str, np.ndarray]) -> np.ndarray:
    """Matrix of votes, a column per labeller: 1 good, 0 bad, -1 silent."""
    out = np.full((len(shares["words"]), len(LABELLERS)), -1, dtype=np.int8)
    for j, (_, name, bad, good) in enumerate(LABELLERS):
        out[shares[name] <= good, j] = 1
        out[shares[name] >= bad, j] = 0
    out[shares["words"] < LEAST_WORDS] = -1
    return out


def _pattern(votes: np.ndarray) -> list[str]:
    return ["".join("-01"[v + 1] for v in row) for row in votes.tolist()]


def fit_labellers(counts: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior probability of "good" for each vote pattern, by expectation-maximisation over the pattern counts."""
    if not counts:
        return {}
    patterns = sorted(counts)
    seen = np.array([[("-01".index(c)) for c in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], dtype=float)
    bad, good = (seen == 1).sum(axis=1), (seen == 2).sum(axis=1)
    posterior = np.where(bad > 0, 0.1, np.where(good > 0, 0.9, 0.5))
    for _ in range(rounds):
        prior = float(np.clip((weight * posterior).sum() / weight.sum(), 0.01, 0.99))
        logs = []
        for share in (weight * posterior, weight * (1 - posterior)):
            table = np.array([[share[seen[:, j] == v].sum() for v in range(3)] for j in range(seen.shape[1])]) + 0.5
            table /= table.sum(axis=1, keepdims=True)
            logs.append(np.log(table)[np.arange(seen.shape[1]), seen].sum(axis=1))
        odds = np.log(prior / (1 - prior)) + logs[0] - logs[1]
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done = np.abs(new - posterior).max() < 1e-9
        posterior = new
        if done:
            break
    return dict(zip(patterns, posterior.tolist(), strict=True))


def _features(words: Words, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, hashed features and their weights: each word, its shape, and whether it repeats the word before."""
    owner = words.owner
    if not len(owner):
        return owner, owner, owner.astype(np.float32)
    length = np.minimum(words.end - words.start, 15)
    first, last = raw[words.start], raw[words.end - 1]
    upper = ((first >= 65) & (first <= 90)).astype(np.int64) + 2 * ((last >= 65) & (last <= 90)) + 4 * ((raw[words.start + (words.end - words.start) // 2] >= 65) & (raw[words.start + (words.end - words.start) // 2] <= 90))
    shape = (((_CLASS[first] * 5 + _CLASS[last]) * 16 + length) * 8 + upper).astype(np.uint64)
    again = np.zeros(len(owner), np.uint64)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    third = DIMENSIONS // 2
    codes = [words.hash % np.uint64(third), np.uint64(third) + mix(shape + np.uint64(1)) % np.uint64(third // 2), np.uint64(third + third // 2) + mix(again * np.uint64(1 << 20) + length.astype(np.uint64)) % np.uint64(third // 2)]
    weight = (1.0 / np.diff(words.first))[owner]
    return np.tile(owner, 3), np.concatenate(codes).astype(np.int64), np.tile(weight, 3).astype(np.float32)


def _read(column: pa.Array) -> Iterator[tuple[Words, np.ndarray]]:
    """Batches of words with the bytes as they were before lower-casing."""
    from corpusloom.llm.words import texts_of

    data, offsets = texts_of(column)
    for words in word_batches(column, SPACED):
        yield words, data[offsets[words.low] : offsets[words.low] + len(words.data)]


def _train(rows: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, steps: int = 150, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer (Adam over all rows, class-balanced)."""
    weight, bias = np.zeros(DIMENSIONS), 0.0
    if not len(rows) or target.min() > 0.5 or target.max() < 0.5:
        return weight, 1.0 if not len(rows) or target.mean() >= 0.5 else -1.0
    of, x, v = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows), np.concatenate(values).astype(np.float64)
    balance = np.where(target >= 0.5, 0.5 / max((target >= 0.5).mean(), 1e-6), 0.5 / max((target < 0.5).mean(), 1e-6))
    m, s, mb, sb = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(of, weights=v * weight[x], minlength=len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * balance / len(rows)
        gradient, gb = np.bincount(x, weights=v * error[of], minlength=DIMENSIONS) + penalty * weight, float(error.sum())
        m, s, mb, sb = 0.9 * m + 0.1 * gradient, 0.999 * s + 0.001 * gradient**2, 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb**2
        weight -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        bias -= 0.3 * (mb / (1 - 0.9**t)) / (np.sqrt(sb / (1 - 0.999**t)) + 1e-8)
    return weight, bias


def score_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: key, votes, posterior, score and kept; ``extra`` columns pass through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in batches:
            for words, raw in _read(batch.column(0)):
                for p in _pattern(_votes(_shares(words, raw))):
                    seen[p] = seen.get(p, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["votes", "n"])

    rows = docs.select(text).mapInArrow(count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    counts = {r["votes"]: r["n"] for r in rows}
    silent = "-" * len(LABELLERS)
    total = sum(counts.values())
    posterior = fit_labellers({p: n for p, n in counts.items() if p != silent})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for words, raw in _read(batch.column(0)):
                patterns = _pattern(_votes(_shares(words, raw)))
                of, x, v = _features(words, raw)
                cell, at = np.unique(of * DIMENSIONS + x, return_inverse=True)
                sums = np.bincount(at, weights=v, minlength=len(cell)).astype(np.float32)
                cuts = np.searchsorted(cell, np.arange(len(patterns) + 1) * DIMENSIONS)
                for d, p in enumerate(patterns):
                    low, high = cuts[d], cuts[d + 1]
                    out.append((p, (cell[low:high] % DIMENSIONS).astype(np.uint16).tobytes(), sums[low:high].tobytes()))
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(1)], ["votes", "x", "v", "h"])

    share = min(1.0, sample_rows / max(total, 1))
    bound = int((share - 0.5) * 2**64) if share < 1 else 2**63 - 1
    order = F.xxhash64(F.col(key).cast("string"))
    sampled = docs.filter((order <= F.lit(max(bound, -(2**63)))) & (F.length(text) > 0)).select(text, order.alias("h"))
    training = []
    if posterior:
        described = Scratch(docs.sparkSession, "quality").table(sampled.mapInArrow(describe, "votes string, x binary, v binary, h long").filter(F.col("votes") != silent), "sample")
        sizes = sorted(map(tuple, described.select("h", F.octet_length("x") + F.octet_length("v")).collect()))
        fits = int(np.searchsorted(np.cumsum([n for _, n in sizes]), SAMPLE_BYTES, side="right"))
        described = described if fits == len(sizes) else described.filter(F.col("h") < sizes[fits][0])
        training = sorted(map(tuple, described.select("votes", "x", "v").collect()))
    weight, bias = _train(
        [np.frombuffer(r[1], np.uint16).astype(np.int64) for r in training],
        [np.frombuffer(r[2], np.float32) for r in training],
        np.array([posterior[r[0]] for r in training]),
    )
    weight = weight.astype(np.float32)
    names = (key, *extra)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, scores = [], []
            for words, raw in _read(batch.column(0)):
                of, x, v = _features(words, raw)
                m = len(words.first) - 1
                z = np.bincount(of, weights=v * weight[x], minlength=m) + bias
                scores.append(np.where(np.diff(words.first) > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0))
                votes += _pattern(_votes(_shares(words, raw)))
            score = np.concatenate(scores) if scores else np.zeros(0)
            arrays = [batch.column(i + 1) for i in range(len(names))]
            arrays += [pa.array(votes, pa.string()), pa.array([posterior.get(p) for p in votes], pa.float64()), pa.array(score, pa.float64()), pa.array([bool(s >= 0.5 or (s > 0 and p == silent)) for s, p in zip(score.tolist(), votes, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "votes", "posterior", "score", "kept"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(F.col(text).alias("_text"), *names).mapInArrow(apply, f"{kinds}, votes string, posterior double, score double, kept boolean")


def good_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier keeps; columns may have any names."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    judged = score_quality(own, names[key], names[text], extra=tuple(n for c, n in names.items() if c != key))
    return judged.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
