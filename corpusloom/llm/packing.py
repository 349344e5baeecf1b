"""Best-fit packing of documents into sequences of several permitted lengths.

A document is a run of byte tokens and an end mark.  Documents longer than the
largest length are cut into pieces of it; nothing is dropped.  Documents are
dealt to shards by hash of their id and place in the table, so that repeated ids
spread too; a shard gets about ``shard_rows`` pieces, and a shard packs
its pieces in decreasing length: each goes to the open bin it fills best, or a
new bin is opened at the permitted length of least cost per expected token.
All upper limits on the opening length are tried jointly with that rule, each
plan is finished by downsizing every bin to the least length that holds its
contents, and the cheapest plan is kept.

Cases: a null or empty text is its end mark alone.  Equal rows are packed as
often as they occur.  Ties go by id, then piece.  A very long text is cut into
pieces and nothing of it is lost.  Extra columns, whatever their names, take no
part.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITIES = (4096, 8192, 16384, 32768)
SHARD_ROWS = 25_000


def cost_of(capacity: int) -> float:
    """Cost of a sequence: linear layers plus attention over its length."""
    return capacity * (1 + capacity / 131_072)


def _plan(lengths: list[int], capacities: Sequence[int], limit: int, cost: Callable[[int], float]) -> tuple[list[int], list[int], list[int], float]:
    """Bin and offset of each piece (lengths in decreasing order), the bins' downsized lengths, and the total cost."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    falling = [-x for x in lengths]
    open_bins: dict[int, list[int]] = {}
    mask = 0  # bit r is set when a bin with r tokens of room is open
    bins, offsets, loads, sizes = [], [], [], []
    total, n = int(ends[-1]), len(lengths)
    for i, size in enumerate(lengths):
        rest = mask >> size
        if rest:
            room = size + (rest & -rest).bit_length() - 1
            own = open_bins[room]
            at = own.pop()
            if not own:
                del open_bins[room]
                mask &= ~(1 << room)
        else:
            best = None
            for capacity in capacities:
                if capacity < size or (capacity > limit and best is not None):
                    continue
                gap = capacity - size
                small = max(i + 1, bisect_left(falling, -gap)) if gap else n
                fill = size + min(gap, total - int(ends[min(small, n)]))
                price = cost(capacity) / fill
                if best is None or price < best[0]:
                    best = (price, capacity)
            room, at = best[1], len(loads)
            loads.append(0)
            sizes.append(room)
        bins.append(at)
        offsets.append(loads[at])
        loads[at] += size
        left = room - size
        if left:
            open_bins.setdefault(left, []).append(at)
            mask |= 1 << left
    down = [capacities[bisect_left(capacities, x)] for x in loads]
    return bins, offsets, down, sum(map(cost, down))


def _pack(capacities: tuple[int, ...], cost: Callable[[int], float], key: str):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_key", "piece"], ascending=[False, True, True], kind="stable", na_position="first").reset_index(drop=True)
        lengths = rows["length"].tolist()
        bins, offsets, down, _ = min((_plan(lengths, capacities, limit, cost) for limit in capacities), key=lambda plan: plan[3])
        shard = rows["shard"].iloc[0]
        return pd.DataFrame({
            "_key": rows["_key"], "piece": rows["piece"], "start": rows["start"], "length": rows["length"],
            "bin_id": [f"{shard}-{b}" for b in bins], "bin_offset": offsets, "capacity": [down[b] for b in bins],
        })

    return pack


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = cost_of, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: key, piece, start (in bytes), length, bin_id, bin_offset and capacity of its bin."""
    capacities = tuple(sorted(capacities))
    largest, kind = capacities[-1], docs.schema[key].dataType.simpleString()
    sized = docs.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_place"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("_size"))
    pieces = sized.agg(F.sum(F.ceil(F.col("_size") / largest))).first()[0] or 0
    shards = max(1, -(-int(pieces) // shard_rows))
    items = (
        sized.withColumn("piece", F.explode(F.expr(f"sequence(0, cast((_size - 1) div {largest} AS int))")))
        .withColumn("start", F.col("piece").cast("long") * largest)
        .withColumn("length", F.least(F.col("_size") - F.col("start"), F.lit(largest)).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64(F.col("_key").cast("string"), "_place", "piece"), F.lit(shards)).cast("int"))
        .select("_key", "piece", "start", "length", "shard")
    )
    schema = f"_key {kind}, piece int, start long, length int, bin_id string, bin_offset int, capacity int"
    # dealt by number: shards cost Python time, not the bytes by which small partitions would be put together
    return items.repartition(shards, "shard").groupBy("shard").applyInPandas(_pack(capacities, cost, key), schema).withColumnRenamed("_key", key)


def sequences(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The plan with the bytes of each piece (the last piece of a document lacks its end mark). Ids must be unique in ``docs``."""
    content = docs.select(F.col(key).alias("_key"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("_bytes"))
    both = plan.join(content, F.col(key).eqNullSafe(F.col("_key")))
    return both.withColumn("bytes", F.substring("_bytes", F.col("start").cast("int") + 1, F.col("length"))).drop("_key", "_bytes")
