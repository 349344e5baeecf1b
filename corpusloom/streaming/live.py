"""Extension: the row-wise operators on streams, and dedup within a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import dedup, filters


def judged(stream: DataFrame, rules: list[filters.Rule]) -> DataFrame:
    """The first failing reason of each row; filters hold no state, so any stream will do."""
    return filters.judged(stream, rules)


def first_within(stream: DataFrame, text: Column, event_time: str, delay: str = "10 minutes") -> DataFrame:
    """The first row of each normalised text; a copy that arrives within the delay is dropped, and state is kept no longer."""
    marked = stream.withWatermark(event_time, delay).withColumn("_key", dedup.identity(T.dup_normalised(text)))
    return marked.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def windowed_counts(stream: DataFrame, event_time: str, by: str, width: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Rows per window and group; a window is final once the watermark has passed it."""
    window = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    return stream.withWatermark(event_time, delay).groupBy(window, by).agg(F.count("*").alias("rows"))


def decontaminated(stream: DataFrame, evals: DataFrame, text: Column, eval_text: Column) -> DataFrame:
    """Rows of a stream whose normalised text no evaluation row has; the evaluation side is a static table."""
    hashes = evals.select(dedup.identity(T.dup_normalised(eval_text)).alias("_hash")).distinct()
    own = stream.withColumn("_mine", dedup.identity(T.dup_normalised(text)))
    return own.join(hashes, own["_mine"] == hashes["_hash"], "left_anti").drop("_mine")
