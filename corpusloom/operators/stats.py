"""Aggregates, quantiles and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import checkpointed


def _places(counts: DataFrame) -> DataFrame:
    """Counts (metric, value, n), one row per value, with ``before``: how many rows of the metric are less.

    Values are dealt by range and written; a part starts after the sums of the
    parts before it, so neither a metric nor a common value falls to one task.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(counts.repartitionByRange(parts, "metric", "value").withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy("metric").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("metric", "_part").agg(F.sum("n").alias("_n"))
    starts = sums.select("metric", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    less = Window.partitionBy("metric", "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("_less", F.coalesce(F.sum("n").over(less), F.lit(0)))
    return within.join(F.broadcast(starts), ["metric", "_part"]).select("metric", "value", "n", (F.col("_start") + F.col("_less")).alias("before"))


def _at(place: Column) -> Column:
    """The value at a place, from 0, of sorted rows."""
    return F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("n")), F.col("value")))


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per metric: count, mean, linear-interpolated p50 to p95 and max. Nulls do not count."""
    named = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(named).alias("m")).select("m.metric", "m.value")
    counts = checkpointed(long.groupBy("metric", "value").agg(F.count("*").alias("n")))
    seen = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    whole = counts.groupBy("metric").agg(F.coalesce(seen, F.lit(0)).alias("count"), F.try_divide(F.sum(F.col("value") * F.col("n")), seen).alias("mean"), F.max("value").alias("max"))
    points = {f"p{int(p * 100)}": F.lit(p) * (F.col("count") - 1) for p in (0.5, 0.75, 0.9, 0.95)}
    own = _places(counts.filter("value IS NOT NULL")).join(F.broadcast(whole.select("metric", "count")), "metric")  # a row per metric
    ends = own.groupBy("metric", "count").agg(*[_at(f(x)).alias(f"_{name}_{side}") for name, x in points.items() for side, f in (("low", F.floor), ("high", F.ceil))])
    between = {name: F.when(F.floor(x) == F.ceil(x), F.col(f"_{name}_low")).otherwise((F.ceil(x) - x) * F.col(f"_{name}_low") + (x - F.floor(x)) * F.col(f"_{name}_high")) for name, x in points.items()}
    found = ends.select("metric", *[c.alias(name) for name, c in between.items()])
    return whole.join(found, "metric", "left").select("metric", "count", "mean", *points, "max")


def index_quantiles(df: DataFrame, column: str, points: dict[str, float]) -> DataFrame:
    """One row: the value at sorted position ``int(n * q)`` for each named q, null without values. Equal values are counted before they are dealt."""
    counts = df.select(F.lit("all").alias("metric"), F.col(column).alias("value")).filter("value IS NOT NULL").groupBy("metric", "value").agg(F.count("*").alias("n"))
    own = checkpointed(_places(counts))
    n = own.agg(F.sum("n")).first()[0] or 0
    return own.agg(*[_at(F.lit(int(n * q))).alias(name) for name, q in points.items()])


def kept_report(df: DataFrame, reason: str = "reason") -> DataFrame:
    kept, total = F.count_if(F.col(reason).isNull()), F.count("*")
    return df.agg(total.alias("total"), kept.alias("kept"), (total - kept).alias("dropped"), F.try_divide(kept.cast("double"), total).alias("ratio"))


def reason_histogram(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Dropped rows by reason, most first."""
    return df.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason)


def pairwise_accuracy(df: DataFrame, chosen: str, rejected: str) -> DataFrame:
    """Share of pairs with a positive margin, mean margin, and the margins at n//2 and int(0.9 n)."""
    own = df.select((F.col(chosen) - F.col(rejected)).alias("margin"))
    whole = own.agg(F.count("*").alias("pairs"), F.avg((F.col("margin") > 0).cast("double")).alias("accuracy"), F.avg("margin").alias("mean_margin"))
    return whole.crossJoin(index_quantiles(own, "margin", {"p50": 0.5, "p90": 0.9}))  # two single rows


def choice_accuracy(df: DataFrame, subject: str, predicted: str, truth: str) -> DataFrame:
    """Accuracy per subject and overall (null subject); rows without a label do not count."""
    own = df.filter(F.col(truth).isNotNull() & (F.col(truth) != ""))
    right = F.count_if(F.col(predicted) == F.col(truth))
    return own.rollup(subject).agg(right.alias("correct"), F.count("*").alias("total"), F.try_divide(right.cast("double"), F.count("*")).alias("accuracy"))


def pass_at_k(df: DataFrame, prompt: str, attempt: str, correct: str, formatted: str, format_attempts: int = 3) -> DataFrame:
    """One row over prompts with several attempts (numbered from 0): pass@K, mean correct, share of prompts with a
    formatted answer among the first attempts, and the decision."""
    each = df.groupBy(prompt).agg(
        F.bool_or(correct).alias("passed"), F.count_if(F.col(correct)).alias("n_correct"),
        F.bool_or((F.col(attempt) < format_attempts) & F.col(formatted)).alias("formatted"),
    )
    share = lambda c: F.avg(F.coalesce(F.col(c), F.lit(False)).cast("double"))
    out = each.agg(F.count("*").alias("prompts"), share("passed").alias("pass_rate"), F.avg("n_correct").alias("mean_correct"), share("formatted").alias("format_rate"))
    return out.withColumn("decision", transition(F.col("pass_rate")))


def transition(rate: Column, low: float = 0.1, high: float = 0.8) -> Column:
    """Whether reinforcement can start; both bounds themselves are ready."""
    return F.when(rate < low, "COLD_START_FAILURE").when(rate > high, "TASKS_TOO_EASY").otherwise("READY_FOR_GRPO")


def accuracy(df: DataFrame, correct: str) -> DataFrame:
    right = F.count_if(F.col(correct))
    return df.agg(right.alias("correct"), F.count("*").alias("total"), F.try_divide(right.cast("double"), F.count("*")).alias("accuracy"))


def first_details(df: DataFrame, order: str, most: int = 20) -> DataFrame:
    """The first judged rows by position, for a report of fixed size."""
    return df.orderBy(order).limit(most)


def perplexity(df: DataFrame, nll: str, tokens: str) -> DataFrame:
    """exp of the token-weighted loss; infinity where it overflows."""
    loss = F.try_divide(F.sum(nll), F.sum(tokens))
    return df.agg(F.sum(tokens).alias("tokens"), loss.alias("loss"), F.exp(loss).alias("perplexity"))


def reward_errors(df: DataFrame, predicted: str, truth: str) -> DataFrame:
    gap = F.col(predicted) - F.col(truth)
    return df.agg(F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"))


def pairwise_loss(df: DataFrame, chosen: str, rejected: str) -> DataFrame:
    """Mean negative log-sigmoid of the margin."""
    return df.agg(F.avg(F.log1p(F.exp(F.col(rejected) - F.col(chosen)))).alias("loss"))


def with_group_advantage(df: DataFrame, reward: str, group: str, out: str = "advantage") -> DataFrame:
    """``df`` with (reward - mean) / standard deviation within the group; 0 where all rewards are equal or null.

    Groups are aggregated before the shuffle, so one of any size falls to no single task. A null group is a group.
    """
    value = F.col(reward)
    each = df.groupBy(F.col(group).alias("_g")).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_spread"), (F.min(value) < F.max(value)).alias("_differ"))
    own = df.join(each, F.col(group).eqNullSafe(F.col("_g")), "left")
    score = F.when(F.col("_differ"), F.try_divide(value - F.col("_mean"), F.col("_spread")))
    return own.withColumn(out, F.coalesce(score, F.lit(0.0))).drop("_g", "_mean", "_spread", "_differ")
