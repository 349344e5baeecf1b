"""Embedding clusters: assignment, balance, representatives and labels."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.operators.sampling import sample

# The verdicts on balance and the Gini bounds below which they hold.
VERDICTS = (("均衡", 0.3), ("中等", 0.5), ("失衡", math.inf))


def balance(df: DataFrame, cluster: str = "cluster", noise: int = -1) -> DataFrame:
    """One row of balance figures; shares are of all rows, noise included. Without clusters the figures are null.

    What meets in the windows is one row per cluster, not per vector.
    """
    counts = df.groupBy(F.col(cluster).alias("_c")).agg(F.count("*").alias("_n"))
    marked = counts.select("_c", "_n", (F.col("_c") != noise).alias("_own"))
    place = F.row_number().over(Window.partitionBy("_own").orderBy("_n", "_c"))
    top = F.row_number().over(Window.partitionBy("_own").orderBy(F.desc("_n"), "_c"))
    ranked = marked.select("*", place.alias("_i"), top.alias("_top"))
    own = lambda x: F.sum(F.when(F.col("_own"), x))
    total, n, size = F.sum("_n"), F.count_if("_own"), own(F.col("_n"))
    gini = F.try_divide((2 * own(F.col("_i") * F.col("_n")) - (n + 1) * size).cast("double"), n * size)
    most, least = F.max(F.when(F.col("_own"), F.col("_n"))), F.min(F.when(F.col("_own"), F.col("_n")))
    noisy = F.coalesce(F.sum(F.when(~F.col("_own"), F.col("_n"))), F.lit(0))
    top3 = F.sum(F.when(F.col("_own") & (F.col("_top") <= 3), F.col("_n")))
    out = ranked.agg(
        total.alias("total_samples"), n.alias("n_clusters"), noisy.alias("noise_samples"), F.try_divide(noisy * 100.0, total).alias("noise_pct"),
        most.alias("max_cluster_size"), least.alias("min_cluster_size"), F.try_divide(most * 100.0, total).alias("max_cluster_pct"),
        F.try_divide(most.cast("double"), least).alias("max_min_ratio"), gini.alias("gini_coefficient"), F.try_divide(top3 * 100.0, total).alias("top3_pct"),
    )
    verdict = None
    for name, bound in VERDICTS:
        below = F.col("gini_coefficient") < bound
        verdict = F.when(below, name) if verdict is None else verdict.when(below, name)
    return out.withColumn("balance_verdict", verdict)


def sizes(df: DataFrame, cluster: str = "cluster", noise: int = -1) -> DataFrame:
    """Clusters by size with their share of all rows."""
    counts = df.groupBy(cluster).agg(F.count("*").alias("size"))
    total = F.sum("size").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percentage", F.col("size") * 100.0 / total).filter(F.col(cluster) != noise).orderBy(F.desc("size"), cluster)


def centroids(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean vector of each cluster, summed dimension by dimension on each side of the shuffle."""
    own = df.select(F.col(cluster).alias("_c"), F.posexplode(vector).alias("_d", "_x"))
    means = own.groupBy("_c", "_d").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    ordered = F.array_sort(F.collect_list(F.struct("_d", "_m")))
    return means.groupBy("_c").agg(F.transform(ordered, lambda s: s["_m"]).alias("centroid")).withColumnRenamed("_c", cluster)


def distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))


def representatives(df: DataFrame, key: str, vector: str, cluster: str, most: int = 5, noise: int = -1, centres: DataFrame | None = None) -> DataFrame:
    """The rows nearest to each cluster's centre: cluster, rank, key, distance."""
    own = df.filter(F.col(cluster) != noise)
    centres = centroids(own, vector, cluster) if centres is None else centres
    near = own.join(centres, cluster).withColumn("distance", distance(F.col(vector), F.col("centroid")))
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy("distance", key))
    return near.withColumn("rank", rank).filter(F.col("rank") <= most).select(cluster, "rank", key, "distance")


def keyword_labels(df: DataFrame, cluster: str, text: str, most: int = 5) -> DataFrame:
    """A label per cluster: the terms of highest TF-IDF, one document per cluster, joined by `` / ``.

    IDF is ln((1 + n) / (1 + df)) + 1; ties go to the later term in order, as a reversed ascending sort leaves them.
    """
    words = df.select(cluster, F.explode(F.transform(T.topic_tokens(T.text_of(text)), F.lower)).alias("term"))
    counts = words.groupBy(cluster, "term").agg(F.count("*").alias("tf"))
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))
    n = df.select(cluster).distinct().agg(F.count("*").alias("n"))
    scored = counts.join(spread, "term").join(F.broadcast(n)).withColumn("score", F.col("tf") * (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0))
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc("score"), F.desc("term")))
    top = scored.withColumn("rank", rank).filter(F.col("rank") <= most).groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t"))
    named = df.select(cluster).distinct().join(top, cluster, "left")
    label = F.coalesce(F.array_join(F.transform("_t", lambda s: s["term"]), " / "), F.concat(F.lit("Cluster "), F.col(cluster).cast("string")))
    return named.select(cluster, label.alias("label"))


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))


def kmeans(df: DataFrame, vector: str, k: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rows with ``cluster``, and the centres (cluster, centroid)."""
    from pyspark.ml.clustering import KMeans

    own = _vectors(df, vector)
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_predicted").fit(own)
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centroid array<double>")
    return model.transform(own).withColumn("cluster", F.col("_predicted")).drop("_features", "_predicted"), centres


#: Fits of the search for k that run at once.
FITS = 8


def best_k(df: DataFrame, vector: str, key: str, least: int = 5, most: int = 50, step: int = 2, sample_rows: int = 5000, seed: int = 42) -> tuple[int, dict[int, float]]:
    """The k of highest cosine silhouette over a sample in hash order, and all scores.

    The sample is one partition, so that a fit does not depend on the cluster;
    fits for several k run side by side.
    """
    from pyspark import inheritable_thread_target
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    own = _vectors(sample(df.select(key, vector), sample_rows, seed, key), vector).cache()
    own.count()  # else each of the first fits would read all rows
    judge = ClusteringEvaluator(featuresCol="_features", predictionCol="cluster", distanceMeasure="cosine")

    @inheritable_thread_target(df.sparkSession)
    def score(k: int) -> float:
        return judge.evaluate(KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(own).transform(own))

    tried = range(least, most + 1, step)
    with ThreadPool(FITS) as pool:
        scores = dict(zip(tried, pool.map(score, tried, chunksize=1), strict=True))
    own.unpersist()
    return max(scores, key=lambda k: (scores[k], -k)), scores


def auto_kmeans(df: DataFrame, vector: str, key: str, least: int = 5, most: int = 50, sample_rows: int = 5000, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """KMeans over all rows with the best k of the sample."""
    k, _ = best_k(df, vector, key, least, most, 2, sample_rows, seed)
    return kmeans(df, vector, k, seed)


def projected(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with x and y, the two principal directions around the mean, for a picture; of rows with a vector."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import vector_to_array

    own = _vectors(df.filter(F.col(vector).isNotNull()), vector)
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_features", outputCol="_centred").fit(own).transform(own)
    flat = PCA(k=2, inputCol="_centred", outputCol="_flat").fit(centred).transform(centred).withColumn("_xy", vector_to_array("_flat"))
    return flat.withColumns({"x": F.col("_xy")[0], "y": F.col("_xy")[1]}).drop("_features", "_centred", "_flat", "_xy")


def clustered(df: DataFrame, vector: str, key: str, given: str | None = None, least_clusters: int = 3, **search: int) -> DataFrame:
    """``given`` labels where they name enough clusters (noise -1), else automatic KMeans."""
    if given is not None and df.filter(F.col(given) != -1).select(given).distinct().count() >= least_clusters:
        return df.withColumn("cluster", F.col(given))
    return auto_kmeans(df, vector, key, **search)[0]


def density_parameters(n: int) -> tuple[int, int]:
    """Least cluster size and neighbours of a density clustering of ``n`` rows."""
    return max(50, int(math.sqrt(n) / 2)), 10


def density_clusters(df: DataFrame, key: str, vector: str, least_size: int | None = None, neighbours: int = 10, most_rows: int = 50_000) -> DataFrame:
    """Hierarchical density clustering (mutual-reachability tree, excess of mass) of a bounded table: (key, cluster), noise -1.

    The method is quadratic, so tables over ``most_rows`` raise; use :func:`auto_kmeans` for them.
    """
    import numpy as np

    n = df.count()
    if n > most_rows:
        raise ValueError(f"{n} rows are too many for density clustering; the bound is {most_rows}")
    kind = df.schema[key].dataType.simpleString()
    if not n:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, cluster int")
    rows = df.select(key, vector).orderBy(key).collect()
    labels = _hdbscan(np.array([r[1] for r in rows], dtype=float), least_size or density_parameters(n)[0], min(neighbours, n))
    return df.sparkSession.createDataFrame([(r[0], int(c)) for r, c in zip(rows, labels, strict=True)], f"`{key}` {kind}, cluster int")


def _hdbscan(x, least: int, neighbours: int):
    """Labels by Prim's tree over mutual reachability, condensed by ``least`` and cut by excess of mass."""
    import numpy as np

    n = len(x)
    square = (x**2).sum(axis=1)
    away = lambda i: np.sqrt(np.maximum(square[i] + square - 2 * (x @ x[i]), 0))
    core = np.array([np.partition(away(i), neighbours - 1)[neighbours - 1] for i in range(n)])
    inside, best, origin, edges, now = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int), [], 0
    for _ in range(n - 1):
        inside[now] = True
        reach = np.maximum(np.maximum(away(now), core), core[now])
        closer = ~inside & (reach < best)
        best[closer], origin[closer] = reach[closer], now
        best[inside] = np.inf
        now = int(best.argmin())
        edges.append((float(best[now]), int(origin[now]), now))
    edges.sort()
    top, size, kids, heights = list(range(n)), [1] * n, {}, {}
    root = list(range(2 * n))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for height, a, b in edges:
        a, b, new = find(a), find(b), len(size)
        root[a] = root[b] = new
        kids[new], heights[new] = (a, b), height
        size.append(size[a] + size[b])
    labels = np.full(n, -1)
    if n < 2:
        return labels

    def leaves(c: int) -> list[int]:
        out, stack = [], [c]
        while stack:
            d = stack.pop()
            stack.extend(kids[d]) if d in kids else out.append(d)
        return out

    # condensed tree: (cluster, parent, birth); stability adds (1 / height of leaving - 1 / height of birth)
    clusters, parent, birth, stability, born, stack = [], {}, {}, {}, {}, []
    top = len(size) - 1
    clusters.append(0)
    parent[0], birth[0], stability[0], born[0] = None, 0.0, 0.0, top
    stack.append((top, 0))
    while stack:
        node, own = stack.pop()
        if node not in kids:
            continue
        density = 1 / heights[node] if heights[node] > 0 else np.inf
        a, b = kids[node]
        big = [c for c in (a, b) if size[c] >= least]
        for c in (a, b):
            if c not in big:
                stability[own] += size[c] * (min(density, 1e12) - birth[own])
        if len(big) == 2:
            for c in big:
                stability[own] += size[c] * (min(density, 1e12) - birth[own])
                new = len(clusters)
                clusters.append(new)
                parent[new], birth[new], stability[new], born[new] = own, min(density, 1e12), 0.0, c
                stack.append((c, new))
        elif big:
            stack.append((big[0], own))
    chosen, value = {}, dict(stability)
    for c in reversed(clusters):
        below = [d for d in clusters if parent[d] == c]
        total = sum(value[d] for d in below)
        chosen[c] = c != 0 and (not below or stability[c] >= total)
        if not chosen[c]:
            value[c] = total
    number = 0
    for c in clusters:
        above, up = parent[c], False
        while above is not None:
            up |= chosen[above]
            above = parent[above]
        if chosen[c] and not up:
            labels[leaves(born[c])] = number
            number += 1
    return labels
