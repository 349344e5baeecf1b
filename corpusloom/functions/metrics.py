"""Scalar text metrics as Column builders. Nothing is rounded; reports round."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T

# Phrases of answers that say little.
TEMPLATE_PHRASES = ("建议及时就医", "根据具体情况", "在医生指导下", "具体分析", "因人而异", "视情况而定", "需要结合临床", "进一步检查", "建议咨询医生", "建议到医院就诊")


def _repeated(items: Column) -> Column:
    """Share of items that an earlier one equals."""
    return F.coalesce(F.try_divide((F.size(items) - F.size(F.array_distinct(items))).cast("double"), F.size(items)), F.lit(0.0))


def word_ngrams(tokens: Column, n: int) -> Column:
    """Token n-grams, joined by blanks (tokens hold none): one pass over the joined text."""
    return F.regexp_extract_all(F.array_join(tokens, " "), F.lit(rf"(?=(\S+(?: \S+){{{n - 1}}}))\S+"), F.lit(1))


def ngram_repetition(x: Column, n: int = 3) -> Column:
    return _repeated(word_ngrams(T.tokens(x), n))


def sentence_repetition(x: Column) -> Column:
    return _repeated(T.sentences(x))


def phrase_density(x: Column, phrases: Sequence[str] = TEMPLATE_PHRASES) -> Column:
    """Occurrences of the phrases per 100 characters."""
    hits = sum((occurrences(x, p) for p in phrases), F.lit(0))
    return F.when(x == "", F.lit(0.0)).otherwise(hits / F.greatest(F.length(x), F.lit(1)) * F.lit(100.0))


def occurrences(x: Column, part: Column | str) -> Column:
    """Occurrences that do not overlap."""
    part = F.lit(part) if isinstance(part, str) else part
    return ((F.length(x) - F.length(F.replace(x, part, F.lit("")))) / F.length(part)).cast("int")


def keyword_coverage(prompt: Column, answer: Column, stopwords: Sequence[str] = T.PROMPT_STOPWORDS) -> Column:
    """Share of the prompt's keywords that the lower-cased answer contains; 0 without keywords."""
    words = T.prompt_keywords(prompt, stopwords)
    low = F.lower(answer)
    return F.coalesce(F.try_divide(F.size(F.filter(words, lambda w: F.contains(low, w))).cast("double"), F.size(words)), F.lit(0.0))


def unique_ratio(x: Column) -> Column:
    tokens = T.tokens(x)
    return F.coalesce(F.try_divide(F.size(F.array_distinct(tokens)).cast("double"), F.size(tokens)), F.lit(0.0))


def with_answer_metrics(df: DataFrame, prompt: Column, answer: Column) -> DataFrame:
    """``df`` with the bundle of metrics of an answer; tokens and sentences are cut once each."""
    own = df.withColumns({"_tokens": T.tokens(answer), "_sentences": T.sentences(answer), "_words": T.prompt_keywords(prompt), "_low": F.lower(answer)})
    own = own.withColumns({"_two": word_ngrams(F.col("_tokens"), 2), "_three": word_ngrams(F.col("_tokens"), 3), "_hits": F.filter("_words", lambda w: F.contains(F.col("_low"), w))})
    tokens = F.col("_tokens")
    own = own.withColumns({
        "rep2": _repeated(F.col("_two")),
        "rep3": _repeated(F.col("_three")),
        "sent_rep": _repeated(F.col("_sentences")),
        "empty_score": phrase_density(answer),
        "kw_cov": F.coalesce(F.try_divide(F.size("_hits").cast("double"), F.size("_words")), F.lit(0.0)),
        "length": F.size(tokens).cast("long"),
        "uniq_ratio": F.coalesce(F.try_divide(F.size(F.array_distinct(tokens)).cast("double"), F.size(tokens)), F.lit(0.0)),
    })
    return own.drop("_tokens", "_sentences", "_words", "_low", "_two", "_three", "_hits")


def ngram_overlap(answer: Column, source: Column, n: int = 3) -> Column:
    """Share of the answer's character n-grams, with multiplicity, that the source has too."""
    return _overlap(n)(T.unspaced(answer), T.unspaced(source))


def _overlap(n: int):
    """A multiset intersection: Arrow batches, as the built-in array functions only know sets."""

    @F.pandas_udf("double")
    def overlap(answers: pd.Series, sources: pd.Series) -> pd.Series:
        def grams(x: str) -> Counter:
            return Counter([x] if 0 < len(x) <= n else [x[i : i + n] for i in range(len(x) - n + 1)])

        def share(x: str | None, y: str | None) -> float:
            own = grams(x or "")
            return (own & grams(y or "")).total() / own.total() if own else 0.0

        return pd.Series([share(x, y) for x, y in zip(answers, sources, strict=True)], dtype=float)

    return overlap


def block_repeated(x: Column, width: int = 30, most: int = 2, step: int = 10, reach: int = 500) -> Column:
    """Whether a block of ``width`` characters, from every ``step``-th place within ``reach``, occurs more than ``most`` times without overlap."""
    return _blocks(width, most, step, reach)(x)


def _blocks(width: int, most: int, step: int, reach: int):
    """Arrow batches: the built-in functions copy the text for each block to count it."""

    def repeats(x: str) -> bool:
        return len(x) >= width * (most + 1) and any(x.count(x[at : at + width]) > most for at in range(0, min(len(x) - width, reach), step))

    @F.pandas_udf("boolean")
    def repeated(texts: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else repeats(x) for x in texts], dtype=object)

    return repeated
