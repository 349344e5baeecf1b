"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles; equal sets form one class.
Trees branch classes by selected minwise tokens: the root of a tree holds all
classes, a node picks one or two coordinates of the minwise sketch (5/4 on
average at similarity 4/5, so two linked classes stay together somewhere with a
probability that hardly falls with depth), and a class goes to the child named
by its own minwise token there.  Because a path depends only on the class's own
sketch, all paths of a class down to the first depth are written in one pass.

A node is compared exhaustively, by arrays: sizes first, then 128 one-bit
sketches, of which too few agree with odds MISS for a linked pair (the recall
allows for it).  A node of more than LIMIT classes is dealt to chunks that share
a few of its classes.

1. Of what passes, every class proposes its HOOKS partners that come first in a
   common order.  In a group of copies all propose the same few, so pairs stay
   in proportion to classes, and confirming them joins the group.
2. Nodes with pairs left over are compared once more, now only across the
   components found; in chunked nodes, classes outside the largest component
   visit all chunks.  Here the places where parities of hashed shingles differ
   are counted too: at most as many as shingles that only one set has, so this
   screen loses no link.  What passes is confirmed: nothing is left uncompared.
3. A chunked node with more than FEW classes outside its largest component
   branches further instead, up to DEEPER levels, before its visits.

Links are confirmed on the full sets.  ``recall`` sets the number of independent
trees; more than the sketch has coordinates for raise.  Sets are compared by
64-bit shingle hashes and named by 64 bits: two different sets of one name, of
odds 2^-64 a pair, stop the run rather than merge.

Cases: a null or empty text (or one without words) has an empty set, 0
shingles, and is alone.  A text with fewer words than a shingle is one shingle,
its whole sequence.  Equal rows are copies like any other; rows with a null id
join the group of their text and never give it its name.  Ties do not occur:
links are symmetric, and a group is named by its least id.  Texts are read
whole, a very long one as a batch of its own.  Extra columns, whatever their
names, take no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components
from corpusloom.llm.store import Scratch, small_batches
from corpusloom.llm.words import SPACED, Words, mix, word_batches

COORDINATES = 128
#: Classes of one chunk of a node, about; every pair of a chunk is compared.
LIMIT = 512
#: Classes of a chunked node that all its chunks share, about.
PIVOTS = 16
#: Partners that each class of a node proposes before the rest of its pairs is looked at.
HOOKS = 3
#: Classes of a node that the first depth aims at.
LEAF = 32
#: Classes outside the largest component that visit all chunks of a node before it branches further.
FEW = 2000
#: Levels below the first depth before all remaining pairs are compared.
DEEPER = 4
#: Members that are confirmed against one class at a time.
MEMBERS = 256
#: Share of pairs of unrelated classes that a level is expected to keep together, for the first depth.
BACKGROUND = 0.05
RECALL = 0.999999
#: Odds that the one-bit sketches part a linked pair.
MISS = 1e-7

_u = np.uint64
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _u(0x9E3779B97F4A7C15)) | _u(1)


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    h = words.hash
    if len(h) >= size:
        code = np.zeros(len(h) - size + 1, np.uint64)
        for j in range(size):
            code = code * _u(0xD1342543DE82EF95) + h[j : len(h) - size + 1 + j]
        code = mix(code)
    for d in range(len(words.first) - 1):
        low, high = int(words.first[d]), int(words.first[d + 1])
        if high - low >= size:
            yield np.unique(code[low : high - size + 1])
        elif high > low:
            short = np.array([high - low], dtype=np.uint64)
            for x in h[low:high]:
                short = short * _u(0xD1342543DE82EF95) + x
            yield mix(short ^ _u(0x5851F42D4C957F2D))
        else:
            yield np.zeros(0, np.uint64)


def _node(own: np.ndarray) -> int:
    """Name of a set: equal sets have equal names."""
    if not len(own):
        return 0
    total = mix(own).sum(keepdims=True) + np.array([len(own)], dtype=np.uint64) * _u(0x9E3779B97F4A7C15)
    return int(mix(total).view(np.int64)[0])


def _sketch(own: np.ndarray) -> np.ndarray:
    """Minwise values, one per coordinate."""
    out = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for low in range(0, len(own), 2048):
        values = (own[low : low + 2048, None] * _FACTORS[None, :]) >> _u(32)
        out = np.minimum(out, values.min(axis=0).astype(np.uint32))
    return out


def _parities(own: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each of 8 to 16 places a shingle, 64 at least: the places are a power of two."""
    places = max(64, 1 << (8 * len(own) - 1).bit_length()) if len(own) else 64
    counts = np.bincount((own & _u(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _bits(sketch: np.ndarray) -> list[int]:
    """128 one-bit sketches, as two 64-bit integers."""
    odd = ((mix(sketch.astype(np.uint64) + np.arange(COORDINATES, dtype=np.uint64) * _u(0x9E3779B97F4A7C15)) >> _u(17)) & _u(1)).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def _least_bits(similarity: float) -> int:
    """One-bit sketches that must agree: fewer happen with probability MISS at the threshold."""
    p, total = (1 + similarity) / 2, 0.0
    for k in range(COORDINATES + 1):
        total += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if total > MISS:
            return k
    return 0


_SIGNED = "sha binary, n int, node long, twin long, sketch binary, s long, t long, odd binary"


def _sign(size: int, percent: int, key: str):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            for words in word_batches(batch.column(1), SPACED):
                for own in shingle_sets(words, size):
                    # a set of n shingles can only be linked with one of n + 1 or more where n is this large
                    may = len(own) * 100 >= (len(own) + 1) * percent
                    row = [len(own), _node(own), _node(mix(own ^ _u(0x9FB21C651E98DF25)))]
                    sketch = _sketch(own) if may else None
                    row += [sketch.tobytes(), *_bits(sketch), _parities(own)] if may else [None] * 4
                    for col, x in zip(cols, row, strict=True):
                        col.append(x)
            arrays = [batch.column(0), batch.column(2), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, [key, "sha", "n", "node", "twin", "sketch", "s", "t", "odd"])

    return sign


def _branching(similarity: float) -> float:
    return min(2.0, max(1.0, 1 / similarity))


def together(depth: int, similarity: float) -> float:
    """Probability that one tree keeps two classes of this similarity together to a leaf of this depth."""
    second, p = _branching(similarity) - 1, 1.0
    for _ in range(depth):
        q = similarity * p
        p = (1 - second) * q + second * (1 - (1 - q) ** 2)
    return p


def trees_for(depth: int, similarity: float, recall: float) -> int:
    """Independent trees that together find a pair at the threshold with probability ``recall``."""
    missed = 1 - recall - MISS
    if missed <= 0:
        raise ValueError(f"the one-bit sketches alone miss {MISS}; no number of trees makes a recall of {recall}")
    trees = math.ceil(math.log(missed) / math.log(1 - together(depth, similarity)))
    if trees > COORDINATES // 2:
        raise ValueError(f"a recall of {recall} at similarity {similarity} takes {trees} trees; the sketch has coordinates for {COORDINATES // 2}")
    return trees


def _children(path: np.ndarray, row: np.ndarray, values: np.ndarray, second: float) -> tuple[np.ndarray, np.ndarray]:
    """Paths and rows one level down. ``values``: a row of minwise tokens per class."""
    pick = mix(path ^ _u(0xA0761D6478BD642F))
    one = (pick >> _u(8)) % _u(COORDINATES)
    two = (one + _u(1) + (pick >> _u(24)) % _u(COORDINATES - 1)) % _u(COORDINATES)
    also = (pick >> _u(44)).astype(np.float64) < second * float(1 << 20)
    row = np.concatenate([row, row[also]])
    which = np.concatenate([one, two[also]])
    path = np.concatenate([path, path[also]])
    token = values[row, which.astype(np.int64)].astype(np.uint64)
    return mix(path * _u(0xE7037ED1A0B428DB) + (which << _u(32)) + token), row


_ENTRY = "path long, node long"


def _expand(depth: int, trees: int, second: float):
    """All paths of each class down to ``depth``, or one level below the given path (depth 1, trees 0)."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2000):
                batch = whole.slice(low, 2000)
                m = batch.num_rows
                values = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(m, COORDINATES)
                row = np.arange(m)
                if trees:
                    roots = np.arange(trees, dtype=np.uint64)
                    row = np.repeat(row, trees)
                    root = np.tile(roots, m)
                    # roots take coordinates of their own, so that trees start independently
                    one = (root * _u(2)) % _u(COORDINATES)
                    also = (mix(root + _u(77)) >> _u(44)).astype(np.float64) < second * float(1 << 20)
                    which = np.concatenate([one, one[also] + _u(1)])
                    row, root = np.concatenate([row, row[also]]), np.concatenate([root, root[also]])
                    path = mix(mix(root + _u(1)) + (which << _u(32)) + values[row, which.astype(np.int64)].astype(np.uint64))
                    levels = depth - 1
                else:
                    path, levels = batch.column(2).to_numpy().view(np.uint64), 1
                for _ in range(levels):
                    path, row = _children(path, row, values, second)
                node = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(node[row])], ["path", "node"])

    return expand


class _Parities:
    """The parities of many sets, by number of places."""

    def __init__(self, blobs: list[bytes]) -> None:
        self.wide = np.array([len(b) // 8 for b in blobs], dtype=np.int64)  # 64-bit words
        self.slot = np.zeros(len(blobs), np.int64)
        self.store: dict[int, np.ndarray] = {}
        for w in np.unique(self.wide).tolist():
            at = np.flatnonzero(self.wide == w)
            self.slot[at] = np.arange(len(at))
            self.store[w] = np.frombuffer(b"".join([blobs[i] for i in at.tolist()]), dtype=np.uint64).reshape(len(at), w)

    def _words(self, rows: np.ndarray, w: int) -> np.ndarray:
        """The rows' parities at ``w`` words: halves of wider ones are added."""
        out, wide = np.empty((len(rows), w), np.uint64), self.wide[rows]
        for v in np.unique(wide).tolist():
            at = np.flatnonzero(wide == v)
            m, width = self.store[v][self.slot[rows[at]]], v
            while width > w:
                width //= 2
                m = m[:, :width] ^ m[:, width:]
            out[at] = m
        return out

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places where the parities of each pair differ."""
        out, narrow = np.zeros(len(left), np.int64), np.minimum(self.wide[left], self.wide[right])
        for w in np.unique(narrow).tolist():
            at = np.flatnonzero(narrow == w)
            step = max(1, (1 << 19) // w)
            for low in range(0, len(at), step):
                some = at[low : low + step]
                out[some] = np.bitwise_count(self._words(left[some], w) ^ self._words(right[some], w)).sum(axis=1)
        return out


def _screened(block: np.ndarray, rows: dict[str, np.ndarray], odd: _Parities | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block that may be linked. Rows come sorted by block; one row of a pair lives in the block, and components differ where given."""
    m, apart = len(block), COORDINATES - _least_bits(percent / 100)
    n, own, component = rows["n"].astype(np.int64), rows["own"], rows.get("component")
    s, t = rows["s"].view(np.uint64), rows["t"].view(np.uint64)
    counts = np.searchsorted(block, block, side="right") - np.arange(m) - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    low = 0
    while low < m:
        high = max(low + 1, int(np.searchsorted(total, total[low] + (1 << 18), side="right")) - 1)
        few = counts[low:high]
        left = np.repeat(np.arange(low, high), few)
        right = left + 1 + np.arange(len(left)) - np.repeat(total[low:high] - total[low], few)
        na, nb = n[left], n[right]
        fits = (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent) & (own[left] | own[right])
        fits &= np.bitwise_count(s[left] ^ s[right]).astype(np.int64) + np.bitwise_count(t[left] ^ t[right]) <= apart
        if component is not None:
            fits &= component[left] != component[right]
        left, right, both = left[fits], right[fits], na[fits] + nb[fits]
        if odd is not None:
            fits = odd.apart(left, right) * (100 + percent) <= both * (100 - percent)
            left, right = left[fits], right[fits]
        yield left, right
        low = high


def _compare(percent: int, hooks: int):
    """Rows of blocks, sorted by block -> candidate pairs (a, b), a before b in the order of places.

    With ``hooks``, each class proposes its first partners only, and a block with
    more answers with its name (a null); otherwise all pairs across components.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(rows: pa.Table) -> pa.RecordBatch:
            columns = {c: rows.column(c).to_numpy() for c in rows.column_names if c != "odd"}
            block, node, place = columns["block"], columns["node"], columns["place"]
            pairs = list(_screened(block, columns, None if hooks else _Parities(rows.column("odd").to_pylist()), percent))
            left, right = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            left, right = left[node[left] != node[right]], right[node[left] != node[right]]
            swap = place[left] > place[right]
            left, right = np.where(swap, right, left), np.where(swap, left, right)
            more = np.zeros(0, np.int64)
            if hooks and len(left):
                who, pair = np.concatenate([left, right]), np.tile(np.arange(len(left)), 2)
                other = np.concatenate([right, left])
                order = np.lexsort((place[other], who))
                first = np.searchsorted(who[order], who[order])
                chosen = np.zeros(len(left), bool)
                chosen[pair[order[np.arange(len(order)) - first < hooks]]] = True
                more = np.unique(block[left[~chosen]])
                left, right = left[chosen], right[chosen]
            none = pa.nulls(len(more), pa.int64())
            columns = [pa.chunked_array([pa.array(node[left]), none]), pa.chunked_array([pa.array(node[right]), none]), pa.chunked_array([pa.nulls(len(left), pa.int64()), pa.array(more)])]
            return pa.table(columns, ["a", "b", "block"]).combine_chunks()

        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            block = rows.column("block").to_numpy()
            cut = int(np.searchsorted(block == block[-1], True)) if len(block) else 0
            rest = rows.slice(cut)
            if cut:
                yield from judged(rows.slice(0, cut)).to_batches()
        if rest is not None and rest.num_rows:
            yield from judged(rest).to_batches()

    return compare


def _compared(rows: DataFrame, percent: int, hooks: int) -> DataFrame:
    """Candidates (a, b, block) of rows of blocks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ("block", "node", "n", "s", "t", "place", "own", *(() if hooks else ("component", "odd")))
    dealt = rows.select(*columns).repartition(parts, F.xxhash64("block")).sortWithinPartitions("block")
    return dealt.mapInArrow(_compare(percent, hooks), "a long, b long, block long").distinct()


def _sieved(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that the parities of their shingles do not part."""

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            odd = _Parities([*batch.column(3).to_pylist(), *batch.column(4).to_pylist()])
            keep = odd.apart(np.arange(m), np.arange(m, 2 * m)) * (100 + percent) <= batch.column(2).to_numpy().astype(np.int64) * (100 - percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("odd").alias(f"o{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "oa", "ob").mapInArrow(sieve, "a long, b long")


def _sets(size: int, marks: np.ndarray | None = None):
    """Name and set of each text; with ``marks`` only of texts whose slot is marked."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if marks is not None:
                h = batch.column(1).to_numpy()
                batch = batch.filter(pa.array((marks[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
            node, own = [], []
            for words in word_batches(batch.column(0), SPACED):
                for s in shingle_sets(words, size):
                    node.append(_node(s))
                    own.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(own, pa.binary())], ["node", "own"])

    return build


#: Bits of the filter that keeps unneeded texts out of the shuffle; its size never grows.
_FILTER_BITS = 1 << 23


def _sets_of(docs: DataFrame, key: str, text: str, needed: DataFrame, size: int) -> DataFrame:
    """Names and sets of the texts of the needed ids, and of few others: a filter of fixed size lets them pass in the scan.

    Where more ids are needed than it can tell apart, the texts that pass are joined with the ids before sets are built.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(_FILTER_BITS))
    ids = needed.select(F.col("id").alias(key))
    found = ids.select(slot.alias("h")).groupBy(F.expr("cast(h div 8 AS int)").alias("at")).agg(F.expr("bit_or(shiftleft(1, cast(h % 8 AS int)))").alias("bits")).toPandas()
    marks = np.zeros(_FILTER_BITS // 8, dtype=np.uint8)
    marks[found["at"].to_numpy()] = found["bits"].to_numpy()
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), slot.alias("_slot"))
    kind = "node long, own binary"
    if needed.count() <= _FILTER_BITS // 8:
        return own.select("_text", "_slot").mapInArrow(_sets(size, marks), kind)

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            yield batch.filter(pa.array((marks[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))

    sieved = own.mapInArrow(sieve, f"_key {docs.schema[key].dataType.simpleString()}, _text string, _slot long")
    sieved = sieved.join(needed.select("id").distinct(), F.col("_key").eqNullSafe(F.col("id")), "left_semi")
    return sieved.select("_text").mapInArrow(_sets(size), kind)


def _confirm(percent: int):
    """Rows (block, a, b, own) sorted by block, then a's own set (b null) before its partners' -> links."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            blocks, a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            head = np.asarray(b.is_null())
            blobs = batch.column(3)
            linked = np.zeros(len(blocks), bool)
            cuts = np.flatnonzero(head | np.concatenate([[True], blocks[1:] != blocks[:-1]])).tolist()
            for low, high in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
                if head[low]:
                    block, centre = blocks[low], np.frombuffer(blobs[low].as_py(), np.uint64)
                    low += 1
                if low == high:
                    continue
                if blocks[low] != block:
                    raise RuntimeError("a pair came without the set of its first class")
                own = [np.frombuffer(blobs[i].as_py(), np.uint64) for i in range(low, high)]  # fails on a missing set
                sizes, every = np.array([len(x) for x in own]), np.concatenate(own)
                at = np.minimum(np.searchsorted(centre, every), len(centre) - 1)
                common = np.bincount(np.repeat(np.arange(high - low), sizes)[centre[at] == every], minlength=high - low)
                linked[low:high] = 100 * common >= percent * (len(centre) + sizes - common)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(keep), b.filter(keep)], ["a", "b"])

    return confirm


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs whose full sets are linked. A class meets its partners in blocks of about MEMBERS, each partner's set sent once a pair."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("_parts"))
    placed = pairs.join(degree, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("_parts"))).alias("block"))
    members = placed.join(sets.withColumnRenamed("node", "b"), "b", "left").select("block", "a", "b", "own")
    centres = placed.select("block", "a").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("block", "a", F.lit(None).cast("long").alias("b"), "own")
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = centres.unionByName(members).repartition(parts, F.xxhash64("block", F.lit(1))).sortWithinPartitions("block", "a", F.asc_nulls_first("b"))
    with small_batches(scratch.spark, 500):
        return scratch.table(dealt.mapInArrow(_confirm(percent), "a long, b long"), name)


def _sha(text: str) -> Column:
    """Name of a text, by which its rows are found again; null texts have none."""
    return F.unhex(F.sha1(F.col(text)))


def _held(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of nodes with several classes, in blocks: a node's chunk, and for its pivots (the first by place) every chunk. ``own`` where the class lives."""
    sizes = entries.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
    held = entries.join(sizes, "path").join(classes.select("node", "n", "s", "t", "place"), "node")
    held = held.withColumn("chunks", F.ceil(F.col("size") / LIMIT).cast("int"))
    held = held.withColumn("chunk", F.pmod(F.xxhash64("node", "path"), F.col("chunks")).cast("int"))
    pivot = (F.col("chunks") > 1) & ((F.col("place") / float(2**64) + 0.5) * F.col("size") < PIVOTS)
    held = held.withColumn("at", F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))))
    return held.select("path", "node", "n", "s", "t", "place", "chunks", F.xxhash64("path", "at").alias("block"), (F.col("at") == F.col("chunk")).alias("own"))


def _open(held: DataFrame, more: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of blocks with pairs left over (``more``) and of chunked nodes, with parities and the component so far; a class without links is its own."""
    state = classes.select("node", "odd").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = held.join(more.withColumn("more", F.lit(True)), "block", "left").filter("more OR chunks > 1")
    return rows.join(state, "node").withColumn("more", F.coalesce("more", F.lit(False)))


def _visits(rows: DataFrame, last: bool) -> tuple[DataFrame, DataFrame]:
    """Of chunked nodes: rows of blocks that are visited and of the classes that visit them, and (path, node) of nodes that branch further first."""
    large = rows.filter("chunks > 1 AND own")
    most = large.groupBy("path", "component").agg(F.count("*").alias("_n")).groupBy("path").agg(F.max(F.struct("_n", "component")).alias("top"), F.sum("_n").alias("all"))
    most = most.select("path", F.col("top.component").alias("home"), (F.col("all") - F.col("top._n")).alias("outside")).filter("outside > 0")
    open_ones = large.join(most, "path")
    now = open_ones if last else open_ones.filter(F.col("outside") <= FEW)
    others = F.filter(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: F.xxhash64("path", i)), lambda b: b != F.col("block"))
    there = F.when(F.col("component") != F.col("home"), others).otherwise(F.array().cast("array<long>"))
    here = F.when(F.col("more"), F.array().cast("array<long>")).otherwise(F.array("block"))  # blocks with pairs left over come anyway
    came = now.withColumn("_at", F.explode(F.concat(here, there))).withColumn("own", F.col("_at") == F.col("block")).withColumn("block", F.col("_at"))
    many = open_ones.filter(F.lit(not last) & (F.col("outside") > FEW)).select("path", "node")
    return came.select(*_ROW), many


_ROW = ("block", "node", "n", "s", "t", "place", "own", "component", "odd")


def _grouped(docs: DataFrame, key: str, text: str, shingle: int, percent: int, recall: float, named: bool = False) -> tuple[DataFrame, DataFrame]:
    """Signed documents (key, sha, n, node, ..), and the group of each class: node, component and component_id. sha is null unless ``named``."""
    scratch = Scratch(docs.sparkSession, "near")
    kind = docs.schema[key].dataType.simpleString()
    similarity, second = percent / 100, _branching(percent / 100) - 1
    with small_batches(scratch.spark, 1000):
        sha = _sha(text) if named else F.lit(None).cast("binary")
        signed = scratch.table(docs.select(F.col(key), F.col(text), sha.alias("_sha")).mapInArrow(_sign(shingle, percent, key), f"`{key}` {kind}, {_SIGNED}"), "signed")
    firsts = [F.first(c).alias(c) for c in ("n", "sketch", "s", "t", "odd")]
    classes = signed.filter("n > 0").groupBy("node").agg(F.min(key).alias("id"), *firsts, (F.min("twin") != F.max("twin")).alias("mixed"))
    classes = scratch.table(classes.withColumn("place", F.xxhash64("node")), "classes")
    if not classes.filter("mixed").isEmpty():
        raise RuntimeError("two different sets have one name")
    joinable = classes.filter(F.col("sketch").isNotNull()).select("node", "sketch")
    depth = max(2, math.ceil(math.log(max(joinable.count(), LEAF + 1) / LEAF) / math.log(1 / BACKGROUND)))
    # dense nodes branch up to DEEPER levels further, where a pair may part again
    trees = trees_for(depth + DEEPER, similarity, recall)
    entries = scratch.table(joinable.mapInArrow(_expand(depth, trees, second), _ENTRY), "entries")

    labels, sets = None, None
    tested: list[DataFrame] = []
    for level in range(DEEPER + 1):
        with small_batches(scratch.spark, 1000):
            held = scratch.table(_held(entries, classes), f"held-{level}")
            found = scratch.table(_compared(held, percent, HOOKS), f"found-{level}")
        scratch.drop("entries" if level == 0 else f"entries-{level}")
        proposed = found.filter("block IS NULL").select("a", "b")
        with small_batches(scratch.spark, 1000):
            pairs = scratch.table(_sieved(_without(proposed, tested), classes, percent), f"pairs-{level}")
        chunked = not held.filter("chunks > 1").isEmpty()
        if sets is None:  # a class that proposes nothing here has no partner in its nodes, nor in deeper ones
            needed = proposed.select(F.col("a").alias("node")).unionByName(proposed.select(F.col("b").alias("node")))
            needed = needed.unionByName(held.filter("chunks > 1").select("node")) if chunked else needed
            needed = scratch.table(needed.distinct().join(classes.select("node", "id"), "node"), "needed")
            with small_batches(scratch.spark, 1000):
                built = _sets_of(docs, key, text, needed, shingle)
                sets = scratch.table(built.join(needed.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
        links = _linked(pairs, sets, percent, scratch, f"links-{level}")
        labels = connected_components(_edges(labels, links), scratch, f"components-{level}")
        tested.append(proposed)

        many = None
        with small_batches(scratch.spark, 1000):
            rows = scratch.table(_open(held, found.filter("block IS NOT NULL").select("block"), classes, labels), f"open-{level}")
            again = rows.filter("more").select(*_ROW)
            if chunked:
                came, many = _visits(rows, level == DEEPER)
                again = again.unionByName(came)
            across = scratch.table(_without(_compared(again, percent, 0).select("a", "b"), tested), f"across-{level}")
        if not across.isEmpty():
            links = _linked(across, sets, percent, scratch, f"across-links-{level}")
            labels = connected_components(_edges(labels, links), scratch, f"across-components-{level}")
            tested.append(across)
        if many is None or many.isEmpty():
            break
        grown = many.distinct().join(joinable, "node").select("node", "sketch", "path")
        entries = scratch.table(grown.mapInArrow(_expand(1, 0, second), _ENTRY), f"entries-{level + 1}")

    names = labels.join(classes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("component_id"))
    groups = labels.join(names, "component").select("node", "component", "component_id")
    own = classes.select("node", "id").join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("component"), F.coalesce("component_id", "id").alias("component_id"))
    return signed, own


def _edges(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Links beside the components so far, as edges."""
    return links if labels is None else links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))


def _without(pairs: DataFrame, tested: list[DataFrame]) -> DataFrame:
    for done in tested:
        pairs = pairs.join(done, ["a", "b"], "left_anti")
    return pairs


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """One row per document: key, n_shingles, component_id (least id of its group) and kept (whether it is that document)."""
    signed, own = _grouped(docs, key, text, shingle, percent, recall)
    alone = signed.filter("n = 0").select(key, F.col("n").cast("long").alias("n_shingles"), F.col(key).alias("component_id"))
    rest = signed.filter("n > 0").select(key, "n", "node").join(own, "node").select(key, F.col("n").cast("long").alias("n_shingles"), "component_id")
    return rest.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one row of each group does.

    That is the row of the least id (a null one only where no row of the group
    has an id), then of the least SHA-1 of its text: ids may be null or repeated,
    so rows are named by both.  Texts without words all stay.
    """
    signed, groups = _grouped(docs, key, text, shingle, percent, RECALL, named=True)
    scratch = Scratch(docs.sparkSession, "near")
    rows = signed.filter("n > 0").groupBy(F.col(key).alias("_id"), F.col("sha").alias("_sha"), "node").agg(F.count("*").alias("_rows"))
    rows = scratch.table(rows.join(groups.select("node", "component"), "node").drop("node"), "rows")
    first = rows.groupBy("component").agg(F.min(F.struct(F.isnull("_id").alias("none"), F.col("_id").alias("id"), F.col("_sha").alias("sha"))).alias("_first"))
    stays = F.col("_id").eqNullSafe(F.col("_first.id")) & (F.col("_sha") == F.col("_first.sha"))
    judged = scratch.table(rows.join(first, "component").withColumn("_stays", stays).filter("NOT _stays OR _rows > 1").select("_id", "_sha", "_stays"), "judged")
    dropped, repeated = judged.filter("NOT _stays"), judged.filter("_stays")
    match = lambda few: F.col(key).eqNullSafe(few["_id"]) & (F.col("_own") == few["_sha"])
    kept = docs.withColumn("_own", _sha(text)).join(dropped, match(dropped), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, match(repeated), "left_semi").dropDuplicates([key, "_own"])
        kept = kept.join(repeated, match(repeated), "left_anti").unionByName(once)
    return kept.drop("_own")
