"""Exact top-k by inner product with two cover trees.

Rows are dealt to cells around pivots (farthest-first over a bounded sample) and
large cells to chunks of a bounded size, so a common vector fills many chunks and
no task.  Each chunk grows a cover tree over its rows and another over the
queries that reach it; node pairs are pruned when their centres' product plus
the covering radii cannot reach the worst k-th score of the query node.

A query first searches its own chunk, which gives its k-th score so far.  It
then goes only to the cells whose pivot and radius allow a better or equal
score, and all partial lists are merged.

Cases: vectors that are null or hold a null or non-finite component take no
part.  Shorter vectors count as padded with zeros.  Equal scores go to the
smaller id.  Equal rows are candidates each; a repeated query is answered once.
A query with fewer than k candidates gets them all.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.store import Scratch

LEAF = 48
CHUNK = 4096
SAMPLE = 2048
MOST_CELLS = 256
#: Queries of one tree.
QUERIES = 1024


class Node:
    """A centre, the distance to its farthest point, and either points or children."""

    __slots__ = ("centre", "children", "norm", "points", "radius", "stack")

    def __init__(self, x: np.ndarray, points: np.ndarray, centre: int) -> None:
        self.points, self.centre, self.children = points, x[centre], None
        distance = np.sqrt(((x[points] - self.centre) ** 2).sum(axis=1))
        self.radius = float(distance.max())
        self.norm = float(np.sqrt((self.centre**2).sum()))
        if len(points) > LEAF and self.radius > 0:
            self.children = self._cover(x, points, centre, distance)
            self.stack = (np.stack([c.centre for c in self.children]), np.array([c.radius for c in self.children]), np.array([c.norm for c in self.children]))

    def _cover(self, x: np.ndarray, points: np.ndarray, centre: int, distance: np.ndarray) -> list[Node]:
        """Centres more than half the radius apart that cover all points within it."""
        own, nearest, owner, centres = x[points], distance.copy(), np.zeros(len(points), np.int64), [centre]
        while True:
            far = int(nearest.argmax())
            if nearest[far] <= self.radius / 2:
                break
            away = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
            closer = away < nearest
            owner[closer], nearest[closer] = len(centres), away[closer]
            centres.append(int(points[far]))
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(centres) + 1))
        groups = [(points[order[cuts[i] : cuts[i + 1]]], c) for i, c in enumerate(centres)]
        lone = [g for g, _ in groups if len(g) == 1]
        out = [Node(x, g, c) for g, c in groups if len(g) > 1]
        for low in range(0, len(lone), LEAF):  # single points share leaves
            together = np.concatenate(lone[low : low + LEAF])
            out.append(Node(x, together, int(together[0])))
        return out


def _tree(x: np.ndarray) -> Node:
    return Node(x, np.arange(len(x)), 0)


class Search:
    """The k best products of each query with a tree's points."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.q, self.q_ids, self.k = q, q_ids, k
        self.floor = floor
        self.score = np.full((len(q), k), -np.inf)
        self.id = np.full((len(q), k), np.iinfo(np.int64).max)
        self.top = _tree(q)

    def run(self, x: np.ndarray, ids: np.ndarray, tree: Node) -> None:
        self.x, self.ids = x, ids
        self._pair(self.top, tree)

    def _worst(self, node: Node) -> float:
        return float(np.maximum(self.score[node.points, -1], self.floor[node.points]).min())

    def _pair(self, a: Node, b: Node) -> None:
        slack = 1e-9 * (1 + (a.norm + a.radius) * (b.norm + b.radius))
        if a.centre @ b.centre + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius + slack < self._worst(a):
            return
        if a.children is None and b.children is None:
            self._leaves(a.points, b.points)
            return
        left = [a] if a.children is None or (b.children is not None and b.radius > 2 * a.radius) else a.children
        right = [b] if left is not None and left is a.children and a.radius > 2 * b.radius or b.children is None else b.children
        lc, lr, ln = a.stack if left is a.children else (a.centre[None], np.array([a.radius]), np.array([a.norm]))
        rc, rr, rn = b.stack if right is b.children else (b.centre[None], np.array([b.radius]), np.array([b.norm]))
        bound = lc @ rc.T + lr[:, None] * rn[None] + ln[:, None] * rr[None] + lr[:, None] * rr[None]
        for i, node in enumerate(left):
            for j in np.argsort(-bound[i]).tolist():
                if bound[i, j] + slack < self._worst(node):
                    break
                self._pair(node, right[j])

    def _leaves(self, a: np.ndarray, b: np.ndarray) -> None:
        scores = self.q[a] @ self.x[b].T
        ids = np.broadcast_to(self.ids[b], scores.shape)
        scores = np.where(ids == self.q_ids[a][:, None], -np.inf, scores)
        live = (scores >= np.maximum(self.score[a, -1], self.floor[a])[:, None]).any(axis=1)
        if not live.any():
            return
        a, scores, ids = a[live], scores[live], ids[live]
        scores, ids = np.concatenate([self.score[a], scores], axis=1), np.concatenate([self.id[a], ids], axis=1)
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.score[a], self.id[a] = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which, place = np.nonzero((self.score > -np.inf) & (self.score >= self.floor[:, None]))
        return which, self.id[which, place], self.score[which, place]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width from lists of integers, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def integer_vectors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first centres of a sample."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < most and nearest.max() > 0:
        far = int(nearest.argmax())
        chosen.append(far)
        nearest = np.minimum(nearest, ((sample - sample[far]) ** 2).sum(axis=1))
    return sample[chosen]


def _searching(k: int, width: int):
    """Over rows sorted by (block, kind): grow a tree from the block's rows, then answer its queries as they come."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, ids, tree = None, [], [], None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])]))
            for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(blocks)], strict=True):
                part = batch.slice(low, high - low)
                if blocks[low] != block:
                    block, rows, ids, tree = blocks[low], [], [], None
                if kinds[low] == 0:
                    rows.append(_matrix(part.column(3), width))
                    ids.append(part.column(2).to_numpy())
                    continue
                if not rows:
                    continue
                if tree is None:
                    x, own = np.concatenate(rows), np.concatenate(ids)
                    tree = _tree(x)
                for at in range(0, part.num_rows, QUERIES):
                    some = part.slice(at, QUERIES)
                    found = Search(_matrix(some.column(3), width), some.column(2).to_numpy(), some.column(4).to_numpy(), k)
                    found.run(x, own, tree)
                    which, best, score = found.rows()
                    yield pa.RecordBatch.from_arrays([some.column(2).take(pa.array(which)), pa.array(best), pa.array(score.astype(np.int64))], ["query_id", "vec_id", "score"])

    return search


def top_k(data: DataFrame, queries: DataFrame, k: int = 5, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows but its own.

    Both tables have columns id (long) and v (array of long, not null); the
    vectors of ``queries`` are among those of ``data`` or not, as one likes.
    """
    spark = data.sparkSession
    scratch = Scratch(spark, "covertree")
    out = "query_id long, vec_id long, score long"
    both = data.withColumn("kind", F.lit(0)).unionByName(queries.dropDuplicates(["id", "v"]).withColumn("kind", F.lit(1)))
    both = scratch.table(both.select("id", "v", "kind"), "both")
    size = both.agg(F.count_if(F.col("kind") == 0).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = [r["v"] for r in both.filter("kind = 0").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()]
    pivots = _pivots(np.array([v + [0] * (width - len(v)) for v in sample], dtype=np.float64).reshape(len(sample), width), min(MOST_CELLS, -(-n // chunk)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            square = (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
            cell = square.argmin(axis=1)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["id", "v", "kind", "cell", "away"])

    placed = scratch.table(both.mapInArrow(place, "id long, v array<long>, kind int, cell int, away double"), "placed")
    stats = {r["cell"]: r for r in placed.filter("kind = 0").groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}
    chunks = [max(1, -(-stats[c]["n"] // chunk)) if c in stats else 0 for c in range(len(pivots))]
    radius = np.array([stats[c]["radius"] if c in stats else -1.0 for c in range(len(pivots))])
    first = np.concatenate([[0], np.cumsum(chunks)]).tolist()
    per_cell = spark.createDataFrame([(c, chunks[c], first[c]) for c in range(len(pivots)) if chunks[c]], "cell int, chunks int, first int")
    blocks = placed.join(F.broadcast(per_cell), "cell").withColumn("block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    rows = blocks.filter("kind = 0").select("block", "kind", "id", "v", F.lit(0.0).alias("floor"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def searched(asked: DataFrame) -> DataFrame:
        dealt = rows.unionByName(asked).repartition(max(parts, first[-1]), F.xxhash64("block")).sortWithinPartitions("block", "kind")
        return dealt.select("block", "kind", "id", "v", "floor").mapInArrow(_searching(k, width), out)

    home = blocks.filter("kind = 1").select("block", "kind", "id", "v", F.lit(float("-inf")).alias("floor"))
    near = scratch.table(searched(home), "near")
    floors = near.groupBy("query_id").agg(F.min("score").cast("double").alias("least"), F.count("*").alias("found"))
    asked = blocks.filter("kind = 1").join(floors, F.col("id") == F.col("query_id"), "left")
    asked = asked.select("id", "v", "block", F.when(F.col("found") >= k, F.col("least")).otherwise(F.lit(float("-inf"))).alias("floor"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query to the blocks of the cells that may better its k-th score, but its own."""
        starts = np.array(first)
        for batch in batches:
            q, floor, own = _matrix(batch.column(1), width), batch.column(3).to_numpy(), batch.column(2).to_numpy()
            bound = q @ pivots.T + np.sqrt((q**2).sum(axis=1))[:, None] * radius[None]
            may = (bound * (1 + 1e-12) + 1e-6 >= floor[:, None]) & (radius >= 0)[None]
            which, cell = np.nonzero(may)
            count = starts[cell + 1] - starts[cell]
            row = np.repeat(which, count)
            block = np.repeat(starts[cell], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            keep = block != own[row]
            row, block = row[keep], block[keep].astype(np.int32)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.ones(len(row), np.int32)), batch.column(0).take(take), batch.column(1).take(take), batch.column(3).take(take)], ["block", "kind", "id", "v", "floor"])

    far = searched(asked.mapInArrow(spread, "block int, kind int, id long, v array<long>, floor double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_every(embeddings: DataFrame, modulus: int, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Top-k of the rows whose id is divisible by ``modulus`` against all rows."""
    data = embeddings.select(F.col(key).cast("long").alias("id"), integer_vectors(F.col(vector), scale).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    return top_k(data, data.filter(F.col("id") % modulus == 0), k)
