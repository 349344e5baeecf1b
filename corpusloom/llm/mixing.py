"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are put in a fixed shuffled order and cut into blocks.
Block j (from 0) of a source with weight w is released at floor(j / w) and due
at ceil((j + 1) / w); one block runs per slot, earliest deadline first among
the released.  With weights that add up to 1 every block meets its deadline, so
after any number of slots t a source has had less than one block more or less
than w * t.

Weights are exact fractions.  One task simulates the schedule slot by slot in
memory for a row per source, and writes a row per slot, of which there is one
for each block that is read; documents take their times from that table.

A source that ends before the others starts again (another epoch) until every
source has been read once, so no document is lost.

Cases: a null source is a source of its own.  Sources without a target weight
take part with weight 0 only if ``weights`` leaves them out, and then raise,
because their documents would be lost; weights of absent sources are ignored.
Equal rows are rows like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.store import Scratch

RESOLUTION = 10_000
BLOCK = 64
#: Sources up to which their figures are broadcast.
BROADCAST_SOURCES = 10_000


def smoothed(rows: Mapping[str | None, int], power: float = 0.7) -> dict[str | None, float]:
    """Target weights in proportion to a power of the sources' sizes: below 1, small sources are read more often."""
    return {s: n**power for s, n in rows.items()}


def quantised(weights: Mapping[str | None, float], resolution: int = RESOLUTION) -> dict[str | None, int]:
    """Slots per period of each source, by largest remainder, one at least."""
    names = sorted(weights, key=lambda s: (s is not None, s))
    if len(names) > resolution:
        raise ValueError(f"{len(names)} sources do not fit in a period of {resolution} slots; raise the resolution")
    total = sum(Fraction(weights[s]) for s in names)
    exact = {s: Fraction(weights[s]) / total * (resolution - len(names)) for s in names}
    out = {s: 1 + math.floor(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: (math.floor(exact[s]) - exact[s], names.index(s)))[: resolution - sum(out.values())]:
        out[s] += 1
    return out


def whole(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """Integers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    common = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * common) for s, w in exact.items()}


def slots(weights: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, slot, release, deadline) in slot order, until each source has had its number of blocks; blocks count on over epochs."""
    total, left = sum(weights), sum(b > 0 for b in blocks)
    waiting = [(0, i, 0) for i in range(len(weights))]  # release, source, block
    ready: list[tuple[int, int, int, int]] = []  # deadline, source, block, release
    slot = 0
    while left:
        while waiting and waiting[0][0] <= slot:
            release, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[i]), i, j, release))
        deadline, i, j, release = heapq.heappop(ready)
        yield i, j, slot, release, min(deadline, (1 << 63) - 1)
        left -= j + 1 == blocks[i]
        heapq.heappush(waiting, ((j + 1) * total // weights[i], i, j + 1))
        slot += 1


_CELLS = "_i int, _k long, _slot long, _release long, _deadline long"


def _simulate(weights: list[int], blocks: list[int]):
    def simulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), *[pa.int64()] * 4)
        names = ["_i", "_k", "_slot", "_release", "_deadline"]
        for batch in batches:
            for _ in range(batch.num_rows):
                rows = slots(weights, blocks)
                while some := list(itertools.islice(rows, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], names)

    return simulate


def _ranked(docs: DataFrame, source: str, order: list[Column], scratch: Scratch) -> DataFrame:
    """``docs`` with _rank, the row's place within its source, from 0.

    Rows are dealt by range of (source, order), so a large source spreads over many
    tasks; ranks start at the counts of the parts before, one number per part and source.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.repartitionByRange(parts, F.col(source), *order).withColumn("_part", F.spark_partition_id())
    dealt = scratch.table(dealt, "dealt")
    counts = dealt.groupBy("_part", source).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(source).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", F.col(source).alias("_s"), "_before")
    within = F.row_number().over(Window.partitionBy("_part", source).orderBy(*order)) - 1
    return (
        dealt.withColumn("_within", within)
        .join(starts.withColumnRenamed("_part", "_p"), (F.col("_part") == F.col("_p")) & F.col(source).eqNullSafe(F.col("_s")))
        .withColumn("_rank", F.col("_before") + F.col("_within"))
        .drop("_part", "_within", "_p", "_s", "_before")
    )


def schedule(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: Mapping[str | None, float] | None = None, power: float = 0.7, block: int = BLOCK, resolution: int | None = None) -> DataFrame:
    """One row per document and reading of it: key, source, block, epoch, release, deadline, slot and position.

    ``position`` orders the whole mix: block slots, then the rows of a block.
    Without ``weights`` the targets are the sources' sizes to ``power``.  A
    ``resolution`` rounds them as :func:`quantised` does; without one they are exact.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    narrow = docs.select(F.col(key), F.col(source))
    sizes = {r[0]: r[1] for r in narrow.groupBy(source).count().collect()}  # a number per source
    if weights is None:
        weights = smoothed(sizes, power)
    elif missing := [s for s in sizes if weights.get(s, 0) <= 0]:
        raise ValueError(f"sources without a positive weight: {missing[:5]}")
    targets = {s: weights[s] for s in sizes}
    shares = {} if not sizes else whole(targets) if resolution is None else quantised(targets, resolution)
    names = sorted(sizes, key=lambda s: (s is not None, s))
    blocks = [-(-sizes[s] // block) for s in names]
    cells = scratch.table(spark.range(0, 1, 1, 1).mapInArrow(_simulate([shares[s] for s in names], blocks), _CELLS), "cells")
    plan = spark.createDataFrame(list(zip(names, range(len(names)), blocks, strict=True)), "_s string, _i int, _blocks long")
    plan = plan.join(cells.groupBy("_i").agg((F.max("_k") + 1).alias("_served")), "_i")
    plan = scratch.table(plan.coalesce(1), "plan")
    order = [F.xxhash64(F.col(key).cast("string"), F.lit("mix")), F.col(key)]
    ranked = _ranked(narrow, source, order, scratch)
    few = F.broadcast(plan) if len(names) <= BROADCAST_SOURCES else plan
    timed = (
        ranked.join(few, F.col(source).eqNullSafe(F.col("_s")))
        .withColumn("block", F.expr(f"_rank div {block}"))
        .withColumn("epoch", F.explode(F.expr("sequence(0, cast(greatest(_served - block - 1, 0) div _blocks AS int))")))
        .withColumn("_k", F.col("block") + F.col("epoch") * F.col("_blocks"))
        .join(cells.hint("shuffle_hash"), ["_i", "_k"])  # a row per slot, never sent whole
    )
    return timed.select(
        key, source, "block", "epoch",
        F.col("_release").alias("release"), F.col("_deadline").alias("deadline"), F.col("_slot").alias("slot"),
        (F.col("_slot") * block + F.expr(f"_rank % {block}")).alias("position"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", weights: Mapping[str | None, float] | None = None, power: float = 0.7, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the schedule reads them and in its order."""
    names, same = docs.columns, F.col(key).eqNullSafe(F.col("_key")) & F.col(source).eqNullSafe(F.col("_source"))
    scratch = Scratch(docs.sparkSession, "mixing")
    plan = schedule(docs.select(key, source), key, source, weights, power, block)
    plan = plan.groupBy(F.col(key).alias("_key"), F.col(source).alias("_source")).agg(F.sort_array(F.collect_list("position")).alias("_places"), F.count_if(F.col("epoch") == 0).alias("_rows"))
    plan = scratch.table(plan, "plan")
    out = docs.join(plan.filter("_rows = 1"), same).withColumn("_position", F.explode("_places"))
    repeated = plan.filter("_rows > 1")
    if not repeated.isEmpty():  # rows of one id and source share its places evenly, in the order of their JSON: maps have none of their own
        turn = F.row_number().over(Window.partitionBy(key, source).orderBy(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))) - 1
        own = docs.join(repeated, same).withColumn("_turn", turn)
        out = out.unionByName(own.withColumn("_position", F.explode(F.expr("filter(_places, (p, i) -> i % _rows = _turn)"))).drop("_turn"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(parts, "_position").sortWithinPartitions("_position").select(*names)
