"""Character n-grams of many texts at once, as numbers: what runs inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

from corpusloom.functions.text import DUP_PUNCTUATION, SPACES

#: Characters that are worked on at once; a longer text is a part of its own.
PART = 1 << 17


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """By code point: 1 white space, 2 what the normaliser for duplicates deletes, else 0."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    kinds[[ord(c) for c in SPACES]] = 1
    kinds[[ord(c) for c in DUP_PUNCTUATION]] = 2
    return kinds


def parts(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of neighbouring texts of up to PART characters, each with the place of its first."""
    first, own, size = 0, [], 0
    for i, x in enumerate(texts):
        x = x or ""
        if own and size + len(x) > PART:
            yield first, own
            first, own, size = i, [], 0
        own.append(x)
        size += len(x)
    if own:
        yield first, own


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after another, and the bounds of each: what ``dup_normalised`` makes of them, given in lower case."""
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    kind = _kinds()[points]
    space = kind == 1
    after = np.empty_like(space)  # of white space or at the start
    after[1:] = space[:-1]
    after[bounds[:-1][bounds[:-1] < len(points)]] = True
    blank = space & ~after  # the first of each run within a text
    some = bounds[1:] > bounds[:-1]
    ends = bounds[1:][some]
    open_ended = space[ends - 1] if len(ends) else np.zeros(0, bool)
    if open_ended.any():
        at = np.flatnonzero(blank)
        last = np.searchsorted(at, ends[open_ended]) - 1
        good = (last >= 0) & (at[np.maximum(last, 0)] >= bounds[:-1][some][open_ended]) if len(at) else np.zeros(len(last), bool)
        blank[at[last[good]]] = False
    keep = (kind == 0) | blank
    points = np.where(space, np.uint32(32), points)[keep]
    return points, np.concatenate([[0], np.cumsum(keep)])[bounds]


def codes(points: np.ndarray, bounds: np.ndarray, n: int, code) -> tuple[np.ndarray, np.ndarray]:
    """``code(points, width)`` of every n-gram within a text, text by text, and the bounds of each; a shorter text is one gram, an empty one has none."""
    size = np.diff(bounds)
    points = points.astype(np.uint64) + np.uint64(1)
    every = code(points, n) if len(points) >= n else np.zeros(0, np.uint64)
    inside = np.zeros(len(every) + 1, dtype=np.int64)  # +1 where grams of a text start, -1 behind them
    long = size >= n
    inside[: len(every) + 1] += np.bincount(bounds[:-1][long], minlength=len(every) + 1)[: len(every) + 1]
    inside -= np.bincount(bounds[1:][long] - n + 1, minlength=len(every) + 1)[: len(every) + 1]
    every = every[np.cumsum(inside)[:-1] > 0]
    count = np.where(long, size - n + 1, (size > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero(~long & (size > 0))
    if len(short):
        whole = np.empty(out[-1], dtype=np.uint64)
        own = np.ones(out[-1], dtype=bool)
        own[out[short]] = False
        whole[own] = every
        for i in short:
            whole[out[i]] = code(points[bounds[i] : bounds[i + 1]], int(size[i]))[0]
        every = whole
    return every, out


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted and without repeats: np.unique hashes 64-bit numbers, which takes much longer than to sort them."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def polynomial(points: np.ndarray, width: int) -> np.ndarray:
    """Codes of signatures."""
    count = len(points) - width + 1
    out = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += points[i : count + i]
    return out ^ (out >> np.uint64(29))


def hashed(points: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes."""
    count = len(points) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        out ^= points[i : count + i]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def signature(own: np.ndarray, odd: np.ndarray, buffer: np.ndarray) -> np.ndarray:
    """Least product of the distinct codes with each odd factor; ``buffer`` has a row per factor."""
    own = own * np.uint64(0xBF58476D1CE4E5B9)
    own ^= own >> np.uint64(32)
    least = np.full(len(odd), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(own), buffer.shape[1]):
        part = own[low : low + buffer.shape[1]]
        block = buffer[:, : len(part)]
        np.multiply(odd[:, None], part[None], out=block)
        np.minimum(least, block.min(axis=1), out=least)
    return least


class Items:
    """Grams of a bounded evaluation side and the items that hold each, for counting what training texts share with them."""

    def __init__(self, gram: np.ndarray, item: np.ndarray, size: np.ndarray):
        """Rows (gram, item number), and the number of grams of each item."""
        order = np.argsort(gram, kind="stable")
        gram, self.item, self.size = gram[order], item[order].astype(np.int64), size
        first = np.concatenate([[True], gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, bool)
        self.gram = gram[first]
        self.at = np.concatenate([np.flatnonzero(first), [len(gram)]]).astype(np.int64)
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[(self.gram.view(np.uint64) >> np.uint64(42)).astype(np.int64)] = True

    def shared(self, own: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, distinct grams that both hold) of hashes and the bounds of each text."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.gram) or not len(own):
            return none, none, none
        at = np.flatnonzero(self.maybe[(own >> np.uint64(42)).astype(np.int64)])
        text = np.searchsorted(bounds, at, side="right") - 1
        order = np.lexsort((own[at], text)) if len(at) > PART * 8 else None  # a long text: its repeats go first
        if order is not None:
            at, text = at[order], text[order]
            new = np.concatenate([[True], (own[at][1:] != own[at][:-1]) | (text[1:] != text[:-1])])
            at, text = at[new], text[new]
        found = own[at].view(np.int64)
        place = np.minimum(np.searchsorted(self.gram, found), len(self.gram) - 1)
        hit = self.gram[place] == found
        key = distinct(text[hit] * len(self.gram) + place[hit])
        text, place = key // len(self.gram), key % len(self.gram)
        texts, items, counts = [], [], []
        length = self.at[place + 1] - self.at[place]
        ends = np.cumsum(length)
        low = 0
        while low < len(place):  # so many postings at once
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PART * 8, side="right")))
            if high < len(place):  # texts stay whole
                start = int(np.searchsorted(text, text[high - 1]))
                high = start if start > low else int(np.searchsorted(text, text[low], side="right"))
            n = length[low:high]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pair = np.repeat(text[low:high] - text[low], n) * len(self.size) + self.item[np.repeat(self.at[place[low:high]], n) + step]
            space = int(text[high - 1] - text[low] + 1) * len(self.size)
            if space <= PART * 32:
                count = np.bincount(pair, minlength=space)
                pair = np.flatnonzero(count)
                count = count[pair]
            else:
                pair, count = np.unique(pair, return_counts=True)
            texts.append(pair // len(self.size) + text[low])
            items.append(pair % len(self.size))
            counts.append(count)
            low = high
        return (np.concatenate(texts), np.concatenate(items), np.concatenate(counts)) if texts else (none, none, none)
