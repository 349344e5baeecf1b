"""Queries against their SQL on odd rows, and what their plans may not do."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import dedup
from corpusloom.operators import grams as G
from corpusloom.plans import catalog, extras

QUERIES, SQL = catalog.QUERIES, catalog.ORACLE_SQL | extras.ORACLE_SQL


def agrees(spark, folder, query, **tables):
    """The query's rows equal its SQL's over these tables, given as (rows, schema)."""
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    out = QUERIES[query](spark, str(folder))
    own, want = Counter(tuple(r) for r in out.collect()), Counter(con.sql(SQL[query]).fetchall())
    assert own == want, (list((own - want).items())[:3], list((want - own).items())[:3])
    return sum(own.values())


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(*texts):
    return [(i, x, "en", "src", len(x or "")) for i, x in enumerate(texts)], DOCS


def test_prompts_of_empty_and_missing_parts(spark, tmp_path):
    rows, schema = docs("plain", "", "  \n", " both ends ", None)
    rows += [(10, "text", "", "src", 4), (11, "text", "en", "", 4), (12, "text", None, "src", 4), (13, "text", "en", None, 4), (14, "", "", "", 0)]
    assert agrees(spark, tmp_path, "instruction_prompts", documents=(rows, schema)) == 10


def test_limited_exercises_come_from_several_files(spark, tmp_path, monkeypatch):
    """The rows are written by ranges: no file, and so no task, holds all of them."""
    rows, schema = docs(*[f"text {i} " + "x" * 2000 for i in range(400)])
    folder = {}
    monkeypatch.setattr(extras, "shared_path", lambda spark, purpose: folder.setdefault(purpose, f"{tmp_path}/{purpose}"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert agrees(spark, tmp_path, "limited_exercises", documents=(rows[::-1], schema)) == 25
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r[0] for r in spark.read.text(folder["limited"] + "/rows.jsonl").groupBy("_metadata.file_path").count().select("count").collect()]
    assert sum(sizes) == 400 and max(sizes) < 300


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def corpus():
    """Documents, some of which hold or bend items of a benchmark, with odd white space, repeats and empty texts."""
    pick = random.Random(4)
    words = ["".join(pick.choices("abcdeé", k=pick.randint(1, 7))) for _ in range(60)]
    said = lambda k: " ".join(pick.choices(words, k=k))
    items = [said(25) for _ in range(12)] + ["", "ab"]
    texts = [said(40) for _ in range(20)] + [said(9) + ", " + x + "  \n" + said(3) for x in items] + [x.upper() + "!" for x in items]
    texts += [x[:-4] + "zz" for x in items if len(x) > 9] + [texts[3], texts[3] + ".", texts[3], "", " ", "abc"]
    return docs(*texts), (list(enumerate(items)), "item_id long, text string")


def test_grams_at_once_are_those_of_each_text(spark):
    pick = random.Random(1)
    texts = ["".join(pick.choices("abÄ. ,-é字\U0001f600" + T.SPACES, k=pick.choice([0, 1, 2, 5, 9, 40]))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    want = [r for r in rows.select(F.lower("t").alias("l"), T.dup_normalised(F.col("t")).alias("n"), F.regexp_replace("t", rf"(?U)\A{T.SPACE}+|{T.SPACE}+\z", "").alias("s"), T.strip(F.col("t")).alias("own")).collect()]
    assert [r["own"] for r in want] == [r["s"] for r in want]
    points, bounds = G.normalised([r["l"] for r in want])
    assert [points[i:j].astype(np.uint32).tobytes().decode("utf-32-le") for i, j in zip(bounds, bounds[1:])] == [r["n"] for r in want]
    codes, bounds = G.codes(points, bounds, 3, G.hashed)
    sizes = [len({r["n"][i : i + 3] for i in range(max(1, len(r["n"]) - 2))}) if r["n"] else 0 for r in want]
    assert [len(G.distinct(codes[i:j])) for i, j in zip(bounds, bounds[1:])] == sizes


@pytest.mark.parametrize("known", [0, 10**6])
@pytest.mark.parametrize("query", ["decontam_containment", "decontam_jaccard", "decontam_report"])
def test_contamination_equals_its_sql(spark, tmp_path, monkeypatch, known, query):
    monkeypatch.setattr(dedup, "KNOWN_GRAMS", known)
    own, bench = corpus()
    assert agrees(spark, tmp_path, query, documents=own, benchmark=bench)


@pytest.mark.parametrize("query", ["decontam_containment", "decontam_jaccard", "decontam_report"])
def test_grams_of_training_rows_stay_in_the_scan(spark, tmp_path, query):
    """No gram of a training text becomes a row, and no training text is shuffled."""
    own, bench = corpus()
    for name, (rows, schema) in {"documents": own, "benchmark": bench}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert "Generate" not in plan(QUERIES[query](spark, str(tmp_path)))


def test_normalised_texts_of_bands_stay_in_python(spark, tmp_path):
    own, bench = corpus()
    for name, (rows, schema) in {"documents": own, "benchmark": bench}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert "regexp_replace" not in plan(QUERIES["decontam_lsh"](spark, str(tmp_path)))


def test_edges_read_their_bands_twice_but_sign_once(spark):
    (rows, schema), _ = corpus()
    seen = spark.sparkContext.accumulator(0)
    text = F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()(F.col("text"))
    dedup.near_components(spark.createDataFrame(rows, schema), "doc_id", text, 3, 0.9).collect()
    assert seen.value == len(rows)


def test_clusters_make_their_keys_once(spark, tmp_path):
    own, _ = corpus()
    assert agrees(spark, tmp_path, "dup_clusters_topk", documents=own)
    assert "sha" not in plan(QUERIES["dup_clusters_topk"](spark, str(tmp_path)))


@pytest.mark.parametrize("cell", [2, 64])
def test_pairs_of_large_groups_in_small_cells(spark, tmp_path, monkeypatch, cell):
    """Forty texts that are all alike: 780 pairs, and no cell needs much more than its own texts."""
    monkeypatch.setattr(dedup, "CELL", cell)
    pick = random.Random(2)
    base = "".join(pick.choices("abcdefghij ", k=600))
    texts = [base[:i] + "#" + base[i + 1 :] for i in range(10, 410, 10)] + [base.upper(), base + "!", "far away from them", ""]
    assert agrees(spark, tmp_path, "near_dup_pairs", documents=docs(*texts)) >= 780
    edges = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)], "a long, b long")
    keys = [r["n"] for r in dedup._cells(edges).select("cell", F.explode(F.array("a", "b")).alias("k")).groupBy("cell").agg(F.countDistinct("k").alias("n")).collect()]
    assert max(keys) <= max(8 * cell, 12) and (cell > 2 or sum(keys) < 2 * 780)


def test_repeated_blocks_are_counted_without_copies(spark, tmp_path):
    pick = random.Random(6)
    block = "".join(pick.choices("abcé 字", k=30))
    texts = [(block + "x" * (i % 3)) * (i % 5) + "".join(pick.choices("ab ", k=i * 9)) for i in range(30)] + ["aa" * 45, "a" * 89, "a" * 90, "é" * 120, "", "y" * 500 + block * 3, "z" * 7 + block * 3]
    texts += ["".join(pick.choices("abcdefgh", k=at)) + block * 3 for at in (490, 500, 510)] + ["word " * 40, "one two three. " * 9]
    own = docs(*texts)
    assert agrees(spark, tmp_path, "repetition_flags", documents=own)
    assert "exists(" not in plan(QUERIES["repetition_flags"](spark, str(tmp_path)))


def test_fits_of_the_search_run_side_by_side(spark, monkeypatch):
    import threading

    from pyspark.ml.clustering import KMeans

    from corpusloom.operators import cluster

    together = threading.Barrier(3, timeout=60)
    fit = KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, df: (together.wait(), fit(self, df))[1])
    pick = random.Random(3)
    rows = [(i, [10.0 * (d == i % 4) + pick.gauss(0, 0.1) for d in range(4)]) for i in range(80)]
    best, scores = cluster.best_k(spark.createDataFrame(rows, "i long, v array<double>"), "v", "i", 2, 6, 2)
    assert best == 4 and sorted(scores) == [2, 4, 6]
