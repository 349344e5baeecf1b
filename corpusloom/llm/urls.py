"""URL filter: rules first, then host word segmentation and naive Bayes.

Hosts and paths are cut at everything but ASCII letters and digits, and names
that were run together are split into words by a unigram Viterbi search.  Word
counts come from the titles of all pages, together with a short list of common
web words; they are written whole, and the words that stand in some name of the
URLs, which are all the search can use, reach the model with the full total.  A multinomial naive Bayes model scores the words: URLs that hold a
listed bad word are its positive examples, all others its negative ones, and
its counts are taken over all pages, hashed into a fixed number of buckets.

A rule (host, path) fits its host and all subdomains where the URL's path
starts with the rule's; the longest fitting rule decides before the model does.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged on no words, by the prior alone.  Equal rows get equal
verdicts.  Very long URLs and words are segmented whole.  Ties between splits go
to the one whose last word is longer.  Extra columns, whatever their names, take
no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import Scratch

# Rules as (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

# Words of URLs that nobody wants, the seeds of the model's positive class.
BAD = frozenset("adult ads bet bets betting casino cheap escort farm gambling loan lottery malware nude payday phishing pills poker porn sex slots spam track tracker viagra warez win xxx".split())

# Common words of host names.
COMMON = "www blog shop store news mail web site online world home page search free best the and for my your get buy sale deals forum wiki help info data cloud tech game games music video photo book books travel food health art car cars auto job jobs city live life love time today daily".split()

BUCKETS = 1 << 16
#: Letters of a string that is no word, at most, and by which title words are looked up in names: longer words by their first letters.
_LONGEST = 20
_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, _A_TO_Z, _A_TO_Z.lower()), path


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a title word in a name may be."""
    for batch in batches:
        seen: set[str] = set()
        for name in batch.column(0).to_pylist():
            for start in range(len(name) - 1):
                seen.update(name[start:end] for end in range(start + 2, min(start + _LONGEST, len(name)) + 1))
                if len(seen) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])
                    seen = set()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])


def title_words(pages: DataFrame, urls: DataFrame, html: str = "html") -> tuple[dict[str, int], int, int]:
    """Counts of the title words that stand in names of ``urls`` (host, path) or are common; the largest count of all title words, and the sum without bad words."""
    title = F.lower(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"(?i)<title[^>]*+>([^<]*+)", 1))
    words = pages.select(F.explode(F.regexp_extract_all(title, F.lit(r"\p{L}{2,}"), F.lit(0))).alias("word"))
    # written first, so that the executors and not the driver merge what each part holds
    scratch = Scratch(pages.sparkSession, "urls")
    counts = scratch.table(words.groupBy("word").count(), "words")
    most, total = counts.agg(F.coalesce(F.max("count"), F.lit(1)), F.coalesce(F.sum(F.when(~F.col("word").isin(*BAD), F.col("count"))), F.lit(0))).first()
    names = urls.select(F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "host", "path")), F.lit("[a-z]+"), F.lit(0))).alias("name")).distinct()
    used = names.mapInArrow(_substrings, "word string").distinct()
    known = counts.withColumn("_start", F.left("word", F.lit(_LONGEST))).join(used.withColumnRenamed("word", "_start"), "_start", "left_semi").drop("_start").unionByName(counts.filter(F.col("word").isin(*COMMON))).distinct()
    rows = scratch.table(known, "known").collect()
    return {r["word"]: r["count"] for r in rows}, most, total


class Segmenter:
    """Unigram Viterbi splitting of names that were run together.

    Where ``counts`` holds only some of the words, ``most`` and ``total`` are the largest count of all and their sum without bad words.
    """

    def __init__(self, counts: Mapping[str, int], most: int | None = None, total: int | None = None) -> None:
        most = max(counts.values(), default=1) if most is None else most
        own = {w: n for w, n in counts.items() if w not in BAD}
        full = dict.fromkeys((*COMMON, *BAD), most) | own
        total = (sum(own.values()) if total is None else total) + most * len(full.keys() - own.keys())
        self.cost = {w: math.log(total / n) for w, n in full.items()}
        self.total = math.log(total)
        self._ready()

    def _ready(self) -> None:
        self.long = sorted({len(w) for w in self.cost if len(w) > _LONGEST})
        self.split = lru_cache(maxsize=100_000)(self._split)

    def _split(self, name: str) -> tuple[str, ...]:
        """Least total cost: a known word of any length costs its own, any other string of up to _LONGEST letters ``total`` and 2.3 a letter."""
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - _LONGEST), end):
                cost = self.cost.get(name[start:end])
                options.append((best[start] + (self.total + 2.3 * (end - start) if cost is None else cost), start))
            for length in self.long:
                if length <= end and (cost := self.cost.get(name[end - length : end])) is not None:
                    options.append((best[end - length] + cost, end - length))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
        out, end = [], len(name)
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return tuple(reversed(out))

    def words(self, host: str, path: str) -> list[str]:
        """Words of a URL; a number is one token whatever its digits."""
        out = []
        for piece in re.findall(r"[a-z]+|[0-9]+", f"{host} {path}".lower()):
            out += ("#",) if piece[0] in "0123456789" else self.split(piece)
        return out


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def url_counts(urls: DataFrame, segmenter: Segmenter) -> tuple[np.ndarray, np.ndarray]:
    """Token counts per class and bucket, and URLs per class, over all rows of (host, path)."""
    costs = segmenter.cost, segmenter.total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _revived(*costs)
        seen, urls_of = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = own.words(host, path)
                bad = int(any(w in BAD for w in words))
                urls_of[bad] += 1
                for w in words:
                    seen[bad, _bucket(w)] += 1
        kind, at = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([kind, [0, 1]])), pa.array(np.concatenate([at, [-1, -1]])), pa.array(np.concatenate([seen[kind, at], urls_of]))], ["kind", "bucket", "n"])

    rows = urls.mapInArrow(count, "kind long, bucket long, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect()
    counts, totals = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in rows:
        if r["bucket"] < 0:
            totals[r["kind"]] = r["n"]
        else:
            counts[r["kind"], r["bucket"]] = r["n"]
    return counts, totals


def token_weights(counts: np.ndarray, backing: float = 50.0) -> np.ndarray:
    """Log odds of each bucket; both classes back off to the common distribution by ``backing`` tokens."""
    common = (counts.sum(axis=0) + 1) / (counts.sum() + counts.shape[1])
    share = (counts + backing * common) / (counts.sum(axis=1, keepdims=True) + backing)
    return np.log(share[1]) - np.log(share[0])


def _revived(cost: dict[str, float], total: float) -> Segmenter:
    own = Segmenter.__new__(Segmenter)
    own.cost, own.total = cost, total
    own._ready()
    return own


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, and the model's ``words`` and ``score`` (log odds of block)."""
    host, path = host_and_path(F.col(url))
    urls = pages.select(key, host.alias("host"), path.alias("path"))
    segmenter = Segmenter(*title_words(pages, urls.select("host", "path"), html))
    counts, totals = url_counts(urls.select("host", "path"), segmenter)
    weight = token_weights(counts)
    prior = math.log((totals[1] + 1) / (totals[0] + 1))
    costs = segmenter.cost, segmenter.total
    kind = pages.schema[key].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _revived(*costs)
        for batch in batches:
            words = [own.words(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            scores = [prior + float(sum(weight[_bucket(w)] for w in ws)) for ws in words]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.list_(pa.string())), pa.array(scores, pa.float64())], [key, "host", "path", "words", "score"])

    scored = urls.mapInArrow(score, f"`{key}` {kind}, host string, path string, words array<string>, score double")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return scored.select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "words", "score")
