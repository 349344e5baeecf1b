"""Mixtures, splits, shuffles and samples that are reproducible by hash."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import checkpointed


def order_key(seed: object, *keys: str) -> list[Column]:
    """A shuffled order that any engine can reproduce: MD5 of seed and key, then the key."""
    return [F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *map(F.col, keys)]


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the global rank, from 1, of each row.

    Rows are dealt by range; a part's ranks start after the counts of the parts
    before it, one number per part, so no task holds all rows.  The dealt rows
    are written in between: ranges are sampled, and both passes need the same.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = [f"_o{i}" for i in range(len(order))]
    own = df.withColumns(dict(zip(labels, order, strict=True)))
    dealt = checkpointed(own.repartitionByRange(parts, *labels).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*labels))
    return dealt.withColumn("_within", within).join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_within")).drop("_part", "_within", "_before", *labels)


#: Hex digits of the order key by which a source's rows are counted before any of them is ranked: 65,536 counts a source.
_COUNTED = 4


def mixture(df: DataFrame, source: str, ratios: Mapping[str, float], total: int, seed: object, *keys: str) -> DataFrame:
    """``int(total * ratio / sum)`` rows of each named source, or all it has; a short source is not made up for.

    Rows are counted by the head of their order key first, so that only those
    up to the head in which a source's target is reached are ranked.
    """
    whole = sum(ratios.values())
    want = {s: int(total * r / whole) for s, r in ratios.items()}
    target = F.element_at(F.create_map(*[F.lit(x) for s, n in want.items() for x in (s, n)]), F.col(source))
    order = order_key(seed, *keys)
    own = df.filter(F.col(source).isin(*want)).withColumn("_head", F.substring(order[0], 1, _COUNTED))
    before = Window.partitionBy(source).orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    heads = own.groupBy(source, "_head").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = heads.filter(F.col("_before") < target).groupBy(source).agg(F.max("_head").alias("_last"))
    rank = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    near = own.join(F.broadcast(last), source).filter(F.col("_head") <= F.col("_last"))  # a row per named source
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= target).select(*df.columns)


def mixture_stats(df: DataFrame, source: str) -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("rows"))


def shuffled(df: DataFrame, seed: object, *keys: str) -> DataFrame:
    return df.orderBy(*order_key(seed, *keys))


def exact_split(df: DataFrame, ratio: float, seed: object, *keys: str) -> DataFrame:
    """Adds ``split``: ``int(n * ratio)`` rows are valid, the others train."""
    valid = F.floor(F.lit(df.count()) * F.lit(ratio))
    return ranked(df, order_key(seed, *keys)).withColumn("split", F.when(F.col("rank") <= valid, "valid").otherwise("train")).drop("rank")


def head_split(df: DataFrame, percent: float, order: str) -> DataFrame:
    """The first rows by position are valid."""
    valid = round(df.count() * percent / 100)
    return ranked(df, [F.col(order)]).withColumn("split", F.when(F.col("rank") <= valid, "valid").otherwise("train")).drop("rank")


def first_n(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(order).limit(n)


def last_n(df: DataFrame, n: int, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def sample(df: DataFrame, n: int, seed: object, *keys: str) -> DataFrame:
    """``n`` rows in shuffled order."""
    return shuffled(df, seed, *keys).limit(n)


def random_and_hard(df: DataFrame, loss: str, randomly: int, hard: int, pool: int, seed: object, *keys: str) -> DataFrame:
    """``randomly`` rows at random, then the ``hard`` rows of highest loss among the next ``pool``; ``pick`` says which."""
    head = sample(df, randomly + pool, seed, *keys)
    rank = F.row_number().over(Window.orderBy(*order_key(seed, *keys)))  # over randomly + pool rows
    own = head.withColumn("_rank", rank)
    easy = own.filter(F.col("_rank") <= randomly).withColumn("pick", F.lit("random"))
    tough = own.filter(F.col("_rank") > randomly).orderBy(F.desc(loss), *keys).limit(hard).withColumn("pick", F.lit("hard"))
    return easy.unionByName(tough).drop("_rank")


def pick(values: tuple[str, ...], seed: object, *keys: str) -> Column:
    """One of the values by hash of seed and keys."""
    code = F.conv(F.substring(order_key(seed, *keys)[0], 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(code, F.lit(len(values))) + 1).cast("int"))
