"""Connected components by alternating large-star and small-star rounds.

Every round is two joins on the edge list; the table is written after each.  A
node with any number of neighbours only meets a minimum that is aggregated
before the shuffle, and the join behind it can be split by adaptive execution.
A graph with a few hundred thousand edges at most is solved in one go instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.llm.store import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _solved(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their components by label passing and pointer jumping over arrays."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if own:
        nodes, labels = _solved(np.concatenate([x for x, _ in own]), np.concatenate([y for _, y in own]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], ["node", "component"])


#: Edges up to this number (8 MB) are solved by one task; more take rounds over the whole cluster.
ONE_TASK = 500_000


def connected_components(edges: DataFrame, scratch: Scratch, name: str, one_task: int = ONE_TASK, rounds: int = 60) -> DataFrame:
    """(node, component) for every end of ``edges`` (columns a, b, long); the component is its least node.

    ``edges`` must be a written table: it is read twice.
    """
    own = edges.filter("a <> b").select("a", "b")
    if edges.count() <= one_task:
        return scratch.table(own.coalesce(1).mapInArrow(_solve, "node long, component long"), f"{name}-solved")
    # each part shrinks to a star per local component before the first round
    now = scratch.table(own.mapInArrow(_solve, "node long, component long").select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b"), f"{name}-local")
    before = None
    for i in range(rounds):
        large = scratch.table(_large_star(now).distinct(), f"{name}-large-{i}")
        seen = Observation()
        now = _small_star(large).distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"))
        now = scratch.table(now, f"{name}-small-{i}")
        if i:
            scratch.drop(f"{name}-large-{i - 1}")
            scratch.drop(f"{name}-small-{i - 1}")
        mark = seen.get
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def merged(labels: DataFrame, edges: DataFrame, scratch: Scratch, name: str, one_task: int = ONE_TASK) -> DataFrame:
    """``labels`` after further edges: only the graph of components is solved again."""
    at = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    own = edges.join(at("a"), "a", "left").join(at("b"), "b", "left").select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    own = scratch.table(own, f"{name}-own")
    over = connected_components(own.select(F.col("ca").alias("a"), F.col("cb").alias("b")), scratch, name, one_task)
    fresh = own.select(F.col("a").alias("node"), F.col("ca").alias("component")).unionByName(own.select(F.col("b").alias("node"), F.col("cb").alias("component"))).distinct()
    every = labels.unionByName(fresh.join(labels.select("node"), "node", "left_anti"))
    out = every.join(over.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    return scratch.table(out.select("node", F.coalesce("top", "component").alias("component")), f"{name}-labels")
