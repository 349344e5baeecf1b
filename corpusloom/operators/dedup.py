"""Exact and approximate duplicates by character n-grams, and decontamination against evaluation sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.operators import grams as G
from corpusloom.session import checkpointed


def identity(x: Column) -> Column:
    """SHA-1 of the UTF-8 bytes, lower hex."""
    return F.sha1(x)


def duplicate_hashes(instruction: Column, extra: Column, output: Column) -> dict[str, Column]:
    """Hashes of the question (input, line end, instruction) and of question and answer."""
    question = T.strip(F.concat(extra, F.lit("\n"), instruction))
    return {
        "question_hash": identity(T.dup_normalised(question)),
        "qa_hash": identity(T.dup_normalised(F.concat(question, F.lit("\n"), output))),
    }


def duplicate_stats(df: DataFrame, key: str) -> DataFrame:
    """total, unique, dup_instances, dup_rate, clusters and max_dup of a hash column, in one row.

    Two aggregations: the first already shrinks to a row per hash on each side of the shuffle.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return counts.agg(
        total.alias("total"), unique.alias("unique"), (total - unique).alias("dup_instances"),
        F.coalesce(F.try_divide((total - unique).cast("double"), total), F.lit(0.0)).alias("dup_rate"),
        F.count_if(F.col("n") >= 2).alias("clusters"), F.coalesce(F.max("n"), F.lit(0)).alias("max_dup"),
    )


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row, by ``order``, of each key. The aggregate finds it before the shuffle, and no group is gathered.

    A null key is a key; a null order comes last.  Rows of one order count as one, so ``order`` should name rows.
    """
    firsts = df.select(key.alias("_k"), F.col(order).alias("_at")).groupBy("_k").agg(F.min("_at").alias("_at"))
    own = df.withColumn("_key", key)
    return own.join(firsts, own["_key"].eqNullSafe(firsts["_k"]) & own[order].eqNullSafe(firsts["_at"]), "left_semi").drop("_key")


def keep_first_question(df: DataFrame, question: Column, order: str) -> DataFrame:
    """Keep-first on the question without white space and case."""
    return keep_first(df, identity(T.compacted(T.text_of(question))), order)


def keep_first_prompt(df: DataFrame, prompt: Column, order: str) -> DataFrame:
    """Keep-first on the stripped prompt."""
    return keep_first(df, identity(T.strip(T.text_of(prompt))), order)


def top_clusters(df: DataFrame, key: str, order: str, most: int = 50, examples: int = 5, columns: tuple[str, ...] = ()) -> DataFrame:
    """The largest clusters of two rows or more (ties by first row), each with its first rows in order."""
    df = df if columns else checkpointed(df.select(key, order))  # a key is costly to make, and is read twice
    sizes = df.groupBy(key).agg(F.count("*").alias("size"), F.min(order).alias("first")).filter("size >= 2")
    top = sizes.orderBy(F.desc("size"), "first").limit(most)  # a report of fixed size
    by = Window.partitionBy(key).orderBy(order)
    rows = df.join(F.broadcast(top.select(key, "size", "first")), key).withColumn("member", F.row_number().over(by))
    return rows.filter(F.col("member") <= examples).select(key, "size", "first", "member", order, *columns)


@lru_cache(maxsize=64)
def bands_for(threshold: float, permutations: int = 128, steps: int = 200) -> tuple[int, int]:
    """Bands and rows per band with the least equally weighted area of false positives and negatives."""

    def area(low: float, high: float, f) -> float:
        width = (high - low) / steps
        return sum(f(low + (i + 0.5) * width) for i in range(steps)) * width

    best = None
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            wrong = area(0, threshold, lambda s: 1 - (1 - s**r) ** b) + area(threshold, 1, lambda s: (1 - s**r) ** b)  # noqa: B023
            if best is None or wrong < best[0]:
                best = (wrong, b, r)
    return best[1], best[2]


#: Chance that verified pairs at the threshold become candidates; more alike ones do with more.
RECALL = 0.999999
#: Permutations that the bands for this recall may take.
RECALL_PERMUTATIONS = 256


@lru_cache(maxsize=64)
def bands_for_recall(threshold: float, recall: float = RECALL, permutations: int = RECALL_PERMUTATIONS) -> tuple[int, int]:
    """Bands and rows per band, as many rows as fit, that find a pair at the threshold with probability ``recall``. One row takes as many bands as it needs."""
    if threshold >= 1:
        return 1, permutations
    bands = lambda r: math.ceil(math.log(1 - recall) / math.log1p(-(threshold**r)))
    rows = 1
    while bands(rows + 1) * (rows + 1) <= permutations:
        rows += 1
    return bands(rows), rows


@lru_cache(maxsize=64)
def _least_bits(threshold: float, bits: int, miss: float = 1e-7) -> int:
    """One-bit sketches that must agree: fewer happen with probability ``miss`` at the threshold."""
    p, total = (1 + threshold) / 2, 0.0
    for k in range(bits + 1):
        total += math.comb(bits, k) * p**k * (1 - p) ** (bits - k)
        if total > miss:
            return k
    return 0


def signatures(df: DataFrame, key: str, text: Column, n: int, permutations: int, seed: int = 1) -> DataFrame:
    """(key, signature) by MinHash of each text's character n-grams; empty texts have none.

    The text is normalised for duplicates here.  A gram is a polynomial over its
    code points, so the grams of many texts are hashed at once; a signature is
    the least product with each of the odd factors.
    """
    kind = df.schema[key].dataType.simpleString()
    odd = np.random.default_rng(seed).integers(1, 1 << 63, permutations, dtype=np.uint64) | np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = np.empty((permutations, 512), dtype=np.uint64)
        for batch in batches:
            texts, at, rows = batch.column(1).to_pylist(), [], []
            for first, part in G.parts(texts):
                own, bounds = G.codes(*G.normalised(part), n, G.polynomial)
                for i in np.flatnonzero(np.diff(bounds)):
                    at.append(first + i)
                    rows.append((G.signature(G.distinct(own[bounds[i] : bounds[i + 1]]), odd, buffer) >> np.uint64(16)).view(np.int64))
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * permutations), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), lists], ["key", "signature"])

    return df.select(F.col(key), F.lower(text).alias("_text")).mapInArrow(sign, f"key {kind}, signature array<long>")


def banded(df: DataFrame, key: str, text: Column, n: int, threshold: float, permutations: int = 128) -> DataFrame:
    """(band, hash, key): documents that share a row are candidates. Empty texts have no bands."""
    b, r = bands_for(threshold, permutations)
    own = signatures(df, key, text, n, b * r)
    bands = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(F.slice(F.col("signature"), i * r + 1, F.lit(r))).alias("hash")))
    return own.select("key", F.explode(bands).alias("_b")).select(F.col("_b.band").alias("band"), F.col("_b.hash").alias("hash"), "key")


def _screened_pairs(df: DataFrame, key: str, text: Column, n: int, threshold: float, among: DataFrame) -> DataFrame:
    """Pairs (a, b) of the keys ``among`` that may reach the threshold: of a band for the recall, and alike in one-bit sketches of up to 128 signature values."""
    b, r = bands_for_recall(threshold)
    words = min(2, b * r // 64)
    bit = lambda low: F.aggregate(F.slice("signature", low, 64), F.lit(0).cast("long"), lambda s, x: F.shiftleft(s, 1).bitwiseOR(x.bitwiseAND(1)))
    sketch = [f"s{i}" for i in range(words)]
    bands = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: F.xxhash64(i, F.slice(F.col("signature"), i * r + 1, F.lit(r))))
    own = signatures(df, key, text, n, b * r).select("key", bands.alias("bands"), *[bit(64 * i + 1).alias(c) for i, c in enumerate(sketch)])
    own = checkpointed(own.join(among.select(F.col(key).alias("key")), "key", "left_semi"))  # read on both sides
    left = own.select(F.explode("bands").alias("hash"), F.col("key").alias("a"), *sketch)
    right = left.select("hash", F.col("a").alias("b"), *[F.col(c).alias(f"o{c}") for c in sketch])
    pairs = left.join(right, "hash").filter("a < b")
    if words:
        apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"o{c}"))) for c in sketch), F.lit(0))
        pairs = pairs.filter(apart <= 64 * words - _least_bits(threshold, 64 * words))
    return pairs.select("a", "b").distinct()


#: Texts of a cell that are compared with one another: a task holds the grams of twice as many.
CELL = 64


def _cells(pairs: DataFrame) -> DataFrame:
    """(cell, a, b): pairs (a, b) dealt so that those of a group share their cell, and a cell has about 2 * CELL keys at most.

    A pair goes with the least key that its lesser one is paired with; groups larger than CELL are cut into squares by hash.
    """
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    group = both.groupBy("a").agg(F.least("a", F.min("b")).alias("_g"))
    own = checkpointed(pairs.join(group, "a"))
    sides = own.select("_g", F.explode(F.array("a", "b")).alias("_k")).distinct().groupBy("_g").agg(F.ceil(F.count("*") / CELL).alias("_q"))
    place = lambda x: F.pmod(F.xxhash64(x), F.col("_q"))
    return own.join(sides, "_g").select(F.xxhash64("_g", place("a"), place("b")).alias("cell"), "a", "b")


def _similarities(pairs: DataFrame, df: DataFrame, key: str, text: Column, n: int) -> DataFrame:
    """(a, b, similarity) of pairs (a, b) of keys: over the full sets of 64-bit hashes of the texts' n-grams.

    Texts travel once for each cell that needs them, not for each pair, and a set is made once in a cell.
    """
    kind = df.schema[key].dataType.simpleString()
    own = checkpointed(_cells(pairs))
    wanted = own.select("cell", F.explode(F.array("a", "b")).alias("_k")).distinct()
    texts = df.select(F.col(key).alias("_k"), F.lower(text).alias("_t")).join(wanted, "_k").select("cell", F.lit(0).alias("_i"), F.col("_k").alias("a"), F.col("_k").alias("b"), "_t")
    rows = texts.unionByName(own.select("cell", F.lit(1).alias("_i"), "a", "b", F.lit(None).cast("string").alias("_t")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for batch in batches:
            cells, kinds, a, b, texts = (c.to_pylist() for c in batch.columns)
            at = [i for i, x in enumerate(kinds) if x == 0]
            made = {}
            for first, part in G.parts([texts[i] for i in at]):
                codes, bounds = G.codes(*G.normalised(part), n, G.hashed)
                made |= {at[first + i]: G.distinct(codes[bounds[i] : bounds[i + 1]]) for i in range(len(part))}
            found, alike = [], []
            for i, cell in enumerate(cells):
                if cell != now:
                    now, sets = cell, {}
                if i in made:
                    sets.setdefault(a[i], []).append(made.pop(i))  # keys may be repeated
                    continue
                found.append(i)
                alike.append(max(_alike(x, y) for x in sets[a[i]] for y in sets[b[i]]))
            places = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(2).take(places), batch.column(3).take(places), pa.array(alike, pa.float64())], ["a", "b", "similarity"])

    return rows.repartition("cell").sortWithinPartitions("cell", "_i").mapInArrow(compare, f"a {kind}, b {kind}, similarity double")


def _alike(x: np.ndarray, y: np.ndarray) -> float:
    """Share of two sorted sets that both hold."""
    union = len(G.distinct(np.concatenate([x, y])))
    return (len(x) + len(y) - union) / union if union else 0.0


def candidate_edges(bands: DataFrame) -> DataFrame:
    """A star around the least key of each bucket: the same components as all its pairs, with one edge fewer than keys.

    The least key is aggregated before the shuffle, so no task holds a bucket.
    """
    least = bands.groupBy("band", "hash").agg(F.min("key").alias("a"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    return bands.join(least, ["band", "hash"]).filter("key <> a").select("a", F.col("key").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): least node reachable over ``edges`` (a, b). Labels travel along edges and jump to their label's
    label; each round is checkpointed to the shared folder, so lineage stays short and lost executors cost a reread.
    A round without a lower label is the last one, and there is always one."""
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("seen"))
        near = labels.join(seen, labels["node"] == seen["a"], "left").select("node", "component", F.least("component", "seen").alias("least"))
        jump = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        step = checkpointed(near.join(jump, near["least"] == jump["_n"], "left").select("node", "component", F.least("least", F.coalesce("_c", "least")).alias("next")))
        labels = step.select("node", F.col("next").alias("component"))
        if step.filter("next <> component").isEmpty():
            return labels


def near_pairs(df: DataFrame, key: str, text: Column, n: int = 3, threshold: float = 0.9, verified: bool = True) -> DataFrame:
    """Pairs (a, b) that share a band, as surveyed.

    ``verified``: pairs whose exact similarity reaches the threshold, with it;
    each is found with probability RECALL or more.  Rows of one normalised text
    are a class: the least key of each is compared with those of others, and is
    paired with the keys of its own class at similarity 1, so that copies are
    not expanded into all pairs.  Empty texts and null keys have no pairs.
    """
    plain = T.dup_normalised(T.text_of(text))
    if not verified:
        bands = banded(df, key, text, n, threshold)
        other = bands.select("band", "hash", F.col("key").alias("b"))
        return bands.join(other, ["band", "hash"]).filter("key < b").select(F.col("key").alias("a"), "b").distinct()
    named = checkpointed(df.filter(F.col(key).isNotNull()).select(F.col(key).alias("b"), plain.alias("_t")).filter("_t <> ''").select("b", F.unhex(identity(F.col("_t"))).alias("_class")))
    least = named.groupBy("_class").agg(F.min("b").alias("a"), F.count("*").alias("_n"))
    copies = named.join(least.filter("_n > 1"), "_class").filter("a < b").select("a", "b", F.lit(1.0).alias("similarity"))
    pairs = checkpointed(_screened_pairs(df, key, text, n, threshold, least.select(F.col("a").alias(key))))
    scored = _similarities(pairs, df, key, text, n)
    found = scored.filter(F.col("similarity") >= threshold).unionByName(copies)
    return found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))  # keys may be repeated


def near_components(df: DataFrame, key: str, text: Column, n: int = 3, threshold: float = 0.9, verified: bool = False) -> DataFrame:
    """Clusters of two rows or more: node, component, size."""
    if verified:
        edges = near_pairs(df, key, text, n, threshold).select("a", "b")
    else:
        edges = candidate_edges(checkpointed(banded(df, key, text, n, threshold)))  # read twice
    found = components(edges)
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    return found.join(sizes, "component").select("node", "component", "size")


def exact_contaminated(train: DataFrame, evals: DataFrame, key: str, train_text: Column, eval_text: Column) -> DataFrame:
    """Keys of training rows whose normalised text an evaluation row has too."""
    hashes = evals.select(identity(T.dup_normalised(eval_text)).alias("_hash")).distinct()
    own = train.select(key, identity(T.dup_normalised(train_text)).alias("_hash"))
    return own.join(hashes, "_hash", "left_semi").select(key)


def _prefix(size: Column, threshold: float) -> Column:
    """Grams of a set of which a set as alike as the threshold holds one at least, in any order."""
    return size - F.ceil(size * threshold - 1e-9) + 1


def jaccard_contaminated(train: DataFrame, evals: DataFrame, key: str, train_text: Column, eval_text: Column, n: int = 5, threshold: float = 0.7) -> DataFrame:
    """Keys of training rows whose similarity to an evaluation row reaches the threshold.

    Where the evaluation side has at most KNOWN_GRAMS grams, as 64-bit hashes,
    training rows are compared in the scan, all of them with all items; else by
    an exact prefix-filter join.
    """
    own = checkpointed(gram_hashes(evals.withColumn("_item", identity(T.dup_normalised(eval_text))), "_item", eval_text, n).filter(F.size("grams") > 0).dropDuplicates(["key"]))
    items = _known_items(own.select(F.col("key").alias("_item"), F.size("grams").alias("_size"), F.explode("grams").alias("gram")))
    if items is None:
        return _jaccard_joined(train, evals, key, train_text, eval_text, n, threshold)

    def alike(text, item, count, size, distinct):
        near = count >= threshold * size[item] - 1e-6  # else the union is too large, whatever the text's own size
        text, item, count = text[near], item[near], count[near]
        which, place = np.unique(text, return_inverse=True)
        value = count / (distinct(which)[place] + size[item] - count)
        return _most(text[value >= threshold], value[value >= threshold])

    return _against_items(train, key, train_text, n, items, alike, "_alike").select(key).distinct()


def _jaccard_joined(train: DataFrame, evals: DataFrame, key: str, train_text: Column, eval_text: Column, n: int, threshold: float) -> DataFrame:
    """The same for an evaluation side of any size: an exact prefix-filter join.

    Grams are ordered by the evaluation rows that hold them, so those that none
    holds come first, and a training row without enough known grams is dropped.
    """
    text = lambda x: T.dup_normalised(x)
    grams = lambda x: F.array_distinct(T.ngrams(text(x), n))
    items = checkpointed(evals.select(identity(text(eval_text)).alias("_item"), grams(eval_text).alias("_b")).filter(F.size("_b") > 0).dropDuplicates(["_item"]))
    posts = items.select("_item", F.size("_b").alias("_nb"), F.explode("_b").alias("gram"))
    held = posts.groupBy("gram").agg(F.count("*").alias("_df"))
    ordered = F.sort_array(F.collect_set(F.struct("_df", "gram")))
    first = posts.join(held, "gram").groupBy("_item", "_nb").agg(ordered.alias("_k")).select("_item", F.explode(F.slice("_k", F.lit(1), _prefix(F.col("_nb"), threshold).cast("int"))).alias("_s")).select("_item", "_s.gram")
    least, most = items.agg(F.min(F.size("_b")), F.max(F.size("_b"))).first()
    if least is None:
        return train.select(key).limit(0)
    own = train.select(F.col(key).alias("_id"), identity(text(train_text)).alias("_h"), grams(train_text).alias("_a"))
    own = own.select("_id", "_h", F.size("_a").alias("_na"), "_a").filter((F.col("_na") >= least * threshold - 1e-9) & (F.col("_na") * threshold <= most + 1e-9))
    known = own.select("_id", "_h", "_na", F.explode("_a").alias("gram")).join(held, "gram").groupBy("_id", "_h", "_na").agg(ordered.alias("_k"))
    known = known.withColumn("_take", (_prefix(F.col("_na"), threshold) - (F.col("_na") - F.size("_k"))).cast("int")).filter("_take > 0")
    known = checkpointed(known)
    pairs = known.select("_id", "_h", F.explode(F.slice("_k", F.lit(1), F.col("_take"))).alias("_s")).select("_id", "_h", "_s.gram").join(first, "gram").select("_id", "_h", "_item").distinct()
    sets = known.select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), "_na", F.col("_k.gram").alias("_a"))
    both = pairs.join(sets, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g"))).join(items, "_item")
    common = F.size(F.array_intersect("_a", "_b"))  # grams that no item holds are not among _a
    alike = F.try_divide(common.cast("double"), F.col("_na") + F.size("_b") - common)
    return both.filter(alike >= threshold).select(F.col("_id").alias(key)).distinct()


def approx_contaminated(train: DataFrame, evals: DataFrame, key: str, eval_key: str, train_text: Column, eval_text: Column, n: int = 5, threshold: float = 0.7, verified: bool = False) -> DataFrame:
    """Keys of training rows that share a band with an evaluation row, or reach the exact similarity when ``verified``."""
    if verified:
        return jaccard_contaminated(train, evals, key, train_text, eval_text, n, threshold)
    left = banded(train, key, train_text, n, threshold)
    right = banded(evals, eval_key, eval_text, n, threshold).select("band", "hash", F.col("key").alias("other"))
    return left.join(right, ["band", "hash"]).select(F.col("key").alias(key)).distinct()


def contamination_flags(train: DataFrame, evals: DataFrame, key: str, eval_key: str, train_text: Column, eval_text: Column, n: int = 5, threshold: float = 0.7, verified: bool = False) -> DataFrame:
    """``train`` with ``contamination``: exact, approx or null. A row that is both is exact."""
    exact = exact_contaminated(train, evals, key, train_text, eval_text)
    approx = approx_contaminated(train, evals, key, eval_key, train_text, eval_text, n, threshold, verified)
    flags = exact.withColumn("contamination", F.lit("exact")).unionByName(approx.withColumn("contamination", F.lit("approx"))).groupBy(key).agg(F.max("contamination").alias("contamination"))
    return train.join(flags, key, "left")


def evaluation_sources(evals: DataFrame, source: str, text: str = "text") -> DataFrame:
    """Rows and distinct texts of each evaluation source, for the report: they count evaluation rows, not hits."""
    return evals.groupBy(source).agg(F.count("*").alias("rows"), F.countDistinct(text).alias("distinct_texts"))


def contamination_report(flagged: DataFrame) -> DataFrame:
    """total, exact, approx, contaminated, clean and rate, in one row."""
    exact, approx, total = F.count_if(F.col("contamination") == "exact"), F.count_if(F.col("contamination") == "approx"), F.count("*")
    return flagged.agg(
        total.alias("total"), exact.alias("exact"), approx.alias("approx"), (exact + approx).alias("contaminated"),
        (total - exact - approx).alias("clean"), F.coalesce(F.try_divide((exact + approx).cast("double"), total), F.lit(0.0)).alias("rate"),
    )


def gram_hashes(df: DataFrame, key: str, text: Column, n: int) -> DataFrame:
    """(key, grams): sorted distinct 64-bit hashes of the character n-grams of each text, normalised for duplicates; a shorter text is one gram."""
    kind = df.schema[key].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, part in G.parts(batch.column(1).to_pylist()):
                own, bounds = G.codes(*G.normalised(part), n, G.hashed)
                rows += [G.distinct(own[low:high].view(np.int64)) for low, high in zip(bounds[:-1], bounds[1:], strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["key", "grams"])

    return df.select(F.col(key), F.lower(text).alias("_text")).mapInArrow(build, f"key {kind}, grams array<long>")


#: Grams of evaluation items, a gram counted for each item that holds it, up to which they go to every task (16 bytes each); beyond, the training grams are joined.
KNOWN_GRAMS = 2_000_000


def _known_items(posts: DataFrame) -> G.Items | None:
    """Of rows (_item, _size, gram), if they are few enough."""
    few = posts.select("_item", "_size", "gram").limit(KNOWN_GRAMS + 1).toPandas()
    if len(few) > KNOWN_GRAMS:
        return None
    number, names = few["_item"].factorize(use_na_sentinel=False)
    size = few["_size"].groupby(number).first().reindex(range(len(names))).to_numpy()
    return G.Items(few["gram"].to_numpy(np.int64), number, size)


def _against_items(train: DataFrame, key: str, text: Column, n: int, items: G.Items, best, schema: str) -> DataFrame:
    """(key, value) of each training row for which ``best`` gives one. best(text, item, count, distinct): arrays of the
    pairs of a part of the rows; ``distinct(texts)`` counts their own grams. It returns texts, each once, and values."""
    kind = train.schema[key].dataType.simpleString()
    shared = train.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            at, values = [np.zeros(0, np.int64)], [np.zeros(0)]
            for first, part in G.parts(batch.column(1).to_pylist()):
                own, bounds = G.codes(*G.normalised(part), n, G.hashed)
                sizes = lambda texts: np.array([len(G.distinct(own[bounds[i] : bounds[i + 1]])) for i in texts], dtype=np.int64)  # noqa: B023, E731
                text, value = best(*items.shared(own, bounds), items.size, sizes)
                at.append(first + text)
                values.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(at))), pa.array(np.concatenate(values), pa.float64())], ["key", "value"])

    return train.select(F.col(key), F.lower(text).alias("_text")).mapInArrow(count, f"key {kind}, value double").select(F.col("key").alias(key), F.col("value").alias(schema))


def _most(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text once, in order, with its largest value."""
    if not len(text):
        return text, value.astype(float)
    order = np.argsort(text, kind="stable")
    text, value = text[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    return text[first], np.maximum.reduceat(value, first)


def containment(train: DataFrame, evals: DataFrame, key: str, eval_key: str, train_text: Column, eval_text: Column, n: int = 5) -> DataFrame:
    """Extension: the largest share of an evaluation row's n-grams that each training row holds.

    Grams are 64-bit hashes.  Where the evaluation side has at most KNOWN_GRAMS
    of them, training rows are compared in the scan and only results leave it.
    """
    own = checkpointed(gram_hashes(evals, eval_key, eval_text, n))
    posts = own.select(F.col("key").alias("_item"), F.size("grams").alias("_size"), F.explode("grams").alias("gram"))
    items = _known_items(posts)
    if items is not None:
        shares = lambda text, item, count, size, _: _most(text, count / size[item])
        found = _against_items(train, key, train_text, n, items, shares, "_share")
        return found.groupBy(key).agg(F.max("_share").alias("containment"))
    held = gram_hashes(train, key, train_text, n)
    hits = held.select(F.col("key").alias(key), F.explode("grams").alias("gram")).join(posts, "gram").groupBy(key, "_item", "_size").agg(F.count("*").alias("_hits"))
    return hits.groupBy(key).agg(F.max(F.col("_hits").cast("double") / F.col("_size")).alias("containment"))
