"""Operators over small frames, and invariants over driver tables."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import cluster, convert, dedup, dialog, filters, model, sampling, stats
from corpusloom.plans import pipelines
from corpusloom.sources import readers, writers

SF = "/root/testdata/sf0.001"
TALK = "array<struct<from:string,value:string>>"


def talks(spark, rows):
    return spark.createDataFrame(rows, f"row_id string, conversations {TALK}")


def test_first_reason_and_report(spark):
    good = "这是一个完整的回答，内容足够长。" * 3
    rows = talks(spark, [
        ("a", [("human", "问题内容是什么"), ("gpt", good)]), ("b", [("human", "问")]), ("c", [("human", "短"), ("gpt", good)]), ("d", [("human", "问题内容是什么"), ("gpt", "短")]),
        ("e", [("human", "问题内容是什么"), ("gpt", "字" * 90)]), ("f", [("human", "问题内容是什么"), ("gpt", "<think>" + good)]), ("g", [("human", "问题内容是什么"), ("gpt", "根据参考文本" + good)]),
        ("h", [("human", "嗯，这个问题"), ("gpt", good)]), ("i", [("human", "english only"), ("gpt", "an answer in english")]), ("j", [("human", "问题内容是什么"), ("gpt", "".join(chr(0x4E00 + i) for i in range(60)) + ",")]),
    ])
    own = filters.judged(rows, filters.conversation_rules(rows))
    reasons = {r["row_id"]: r["reason"] for r in own.collect()}
    assert reasons == {"a": None, "b": "too_few_turns", "c": "human_too_short", "d": "gpt_too_short", "e": "gpt_repetition", "f": "thinking_tags", "g": "meta_content", "h": "human_thinking", "i": "not_chinese", "j": "truncated"}
    report = stats.kept_report(own).first()
    assert report["kept"] + report["dropped"] == report["total"] == 10
    assert sum(r["n"] for r in stats.reason_histogram(own).collect()) == report["dropped"]


def test_split_is_exact_and_stable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sampling.exact_split(docs, 0.05, 42, "doc_id").filter("split = 'valid'").select("doc_id")
    again = sampling.exact_split(docs.repartition(7), 0.05, 42, "doc_id").filter("split = 'valid'").select("doc_id")
    assert one.count() == 10 and not one.exceptAll(again).count()


def test_dialog_windows(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("assistant", "x"), ("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("user", "q3"), ("assistant", "a3"), ("user", "q4")])]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = [(r["instruction"], r["input"], r["output"], r["turn_index"]) for r in dialog.sliding_samples(turns, 1).orderBy("turn_index").collect()]
    assert got == [("q1", "助手：x", "a1", 0), ("q3", "助手：a1\n用户：q2", "a3", 1)]
    assert [r["input"] for r in dialog.sliding_samples(turns, 0).orderBy("turn_index").collect()] == ["", ""]
    prefixes = {r["question"]: [tuple(p) for p in r["history"]] for r in dialog.prompt_prefixes(turns).collect()}
    assert prefixes == {"q1": [], "q2": [("q1", "a1")], "q3": [("q1", "a1")], "q4": [("q1", "a1"), ("q3", "a3")]}


def test_dialog_repair(spark):
    cases = {
        "plain": [("human", "a"), ("gpt", "b")], "system": [("system", "s"), ("human", "a"), ("gpt", "b")], "stray": [("gpt", "x"), ("human", "a"), ("gpt", "b")],
        "unknown": [("human", "a"), ("gpt", "b"), ("tool", "t"), ("human", "c")], "odd": [("human", "a"), ("gpt", "b"), ("human", "c")], "short": [("human", "a")],
    }
    got = {r["row_id"]: r["p"] and [tuple(x) for x in r["p"]] for r in talks(spark, list(cases.items())).select("row_id", dialog.repaired_pairs(F.col("conversations")).alias("p")).collect()}
    assert got == {"plain": [("a", "b")], "system": [("a", "b")], "stray": [("a", "b")], "unknown": [("a", "b")], "odd": None, "short": None}


def test_history_policies(spark):
    rows = spark.createDataFrame([(1, [["a", "b"], ["c"]]), (2, None), (3, [])], "i int, history array<array<string>>")
    got = {r["i"]: (len(r["kept"]), len(r["all"])) for r in rows.select("i", convert.pairs_kept(F.col("history")).alias("kept"), convert.pairs_all_or_none(F.col("history")).alias("all")).collect()}
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 0)}


def test_strict_preferences_raise(spark):
    rows = spark.createDataFrame([("q", "c", "")], "question string, chosen string, rejected string")
    with pytest.raises(Exception, match="lacks its question"):
        convert.preference_to_dpo(rows).collect()
    assert convert.preference_to_dpo(rows, strict=False).count() == 0


def test_components_do_not_depend_on_partitions(spark):
    edges = [(1, 2), (2, 3), (7, 8), (3, 9), (20, 21), (21, 22), (22, 23), (23, 24)]
    for parts in (1, 5):
        got = {r["node"]: r["component"] for r in dedup.components(spark.createDataFrame(edges, "a long, b long").repartition(parts)).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}


def test_bands():
    assert dedup.bands_for(0.7) == (14, 9) and dedup.bands_for(0.9) == (5, 25)


def test_near_pairs_of_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    exact = docs.groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("n = 2").select("a", "b")
    found = dedup.near_pairs(docs, "doc_id", F.col("text"), 5, 0.9)
    assert not exact.join(found, ["a", "b"], "left_anti").count()
    assert found.filter("similarity < 0.9").isEmpty()


def test_near_pairs_of_classes(spark):
    """Copies are paired with the least key of their text alone, and texts that differ by their least keys."""
    (_, one), (_, two) = bent_texts(3, 0.004, n=1)
    rows = [(5, one), (3, one.upper()), (9, one + "!"), (4, two), (8, two), (4, two), (20, ""), (21, ""), (22, None), (None, one), (30, "far away from all of them")]
    found = dedup.near_pairs(spark.createDataFrame(rows, "i long, t string"), "i", F.col("t"), 5, 0.9).collect()
    assert sorted((r["a"], r["b"]) for r in found) == [(3, 4), (3, 5), (3, 9), (4, 8)]
    assert {(r["a"], r["b"]): r["similarity"] for r in found}[3, 4] == alike(one, two)
    assert dedup.near_pairs(spark.createDataFrame([], "i long, t string"), "i", F.col("t"), 5, 0.9).count() == 0


def bent_texts(seed, share, n=60):
    """Letters, and the same with some changed: pairs about as alike as a threshold, and the brute-force similarity by 5-grams."""
    pick, rows = random.Random(seed), []
    for i in range(n):
        text = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=400))
        bent = list(text)
        for at in pick.sample(range(400), round(share * pick.uniform(0.4, 1.2) * 400)):
            bent[at] = pick.choice("0123456789")
        rows += [(2 * i, text), (2 * i + 1, "".join(bent))]
    return rows


def alike(x, y):
    a, b = ({t[i : i + 5] for i in range(len(t) - 4)} for t in (x, y))
    return len(a & b) / len(a | b)


def test_verified_pairs_near_the_threshold(spark):
    rows = bent_texts(1, 0.01)
    want = {(rows[i][0], rows[i + 1][0]) for i in range(0, len(rows), 2) if alike(rows[i][1], rows[i + 1][1]) >= 0.9}
    got = {(r["a"], r["b"]) for r in dedup.near_pairs(spark.createDataFrame(rows, "i long, t string"), "i", F.col("t"), 5, 0.9).collect()}
    assert got == want and 20 < len(want) < 60
    for t in (0.5, 0.7, 0.9, 0.97):
        b, r = dedup.bands_for_recall(t)
        assert 1 - (1 - t**r) ** b >= 0.999999 and b * r <= 256


def test_verified_contamination_near_the_threshold(spark):
    rows = bent_texts(2, 0.045)
    evals = spark.createDataFrame([r for r in rows if r[0] % 2 == 0] + [(900, ""), (901, None)], "e long, t string")
    train = spark.createDataFrame([r for r in rows if r[0] % 2] + [(1000, ""), (1002, None), (1004, "abc"), (1, rows[3][1]), (None, rows[5][1])], "i long, t string")
    of = dict(rows)
    want = {i for i, t in [r for r in rows if r[0] % 2] if alike(t, of[i - 1]) >= 0.7}
    want |= {1} if alike(rows[3][1], rows[2][1]) >= 0.7 else set()
    want |= {None} if alike(rows[5][1], rows[4][1]) >= 0.7 else set()
    got = {r["i"] for r in dedup.approx_contaminated(train, evals, "i", "e", F.col("t"), F.col("t"), 5, 0.7, verified=True).collect()}
    assert got == want and 15 < len(want) < 60
    assert dedup.approx_contaminated(train, evals.limit(0), "i", "e", F.col("t"), F.col("t"), verified=True).count() == 0


def test_clean_and_contaminated_add_up(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    train = docs.select(F.col("doc_id").alias("id"), "text").unionByName(bench.select((F.col("item_id") + 1_000_000).alias("id"), "text"))
    report = dedup.contamination_report(dedup.contamination_flags(train, bench, "id", "item_id", F.col("text"), F.col("text"))).first()
    assert report["exact"] == 40 and report["clean"] + report["contaminated"] == report["total"] == 240


def test_distribution_with_ties_and_nulls(spark):
    """One value holds half of the rows; another metric has no value at all."""
    pick = random.Random(4)
    x = [0.0] * 300 + [pick.uniform(-5, 5) for _ in range(299)]
    rows = [(v, None, 7) for v in x] + [(None, None, 7)] * 5
    got = {r["metric"]: r for r in stats.distribution(spark.createDataFrame(rows, "x double, y double, z int").repartition(5), ["x", "y", "z"]).collect()}
    assert (got["x"]["count"], got["y"]["count"], got["z"]["count"]) == (599, 0, 604)
    assert got["x"]["mean"] == pytest.approx(sum(x) / len(x)) and got["x"]["max"] == max(x)
    for p in (50, 75, 90, 95):
        assert got["x"][f"p{p}"] == pytest.approx(np.percentile(x, p)) and got["y"][f"p{p}"] is None and got["z"][f"p{p}"] == 7
    few = spark.createDataFrame([(1.0,)] * 50 + [(2.0,)], "x double")
    assert stats.index_quantiles(few, "x", {"a": 0.5, "b": 0.99}).first().asDict() == {"a": 1.0, "b": 2.0}
    assert stats.index_quantiles(few.limit(0), "x", {"a": 0.5}).first().asDict() == {"a": None}
    assert stats.distribution(few.limit(0), ["x"]).count() == 0


def test_mixture_takes_the_first_of_each_source(spark):
    rows = [(i, "hot" if i % 3 else ("cold" if i % 2 else "short")) for i in range(3000)] + [(9000, None), (9001, "other")]
    df = spark.createDataFrame(rows, "i long, s string").repartition(6)
    got = sampling.mixture(df, "s", {"hot": 0.2, "cold": 0.0, "short": 0.8}, 1000, 7, "i").collect()
    order = lambda i: (hashlib.md5(f"7|{i}".encode()).hexdigest(), i)
    want = {i for name, n in (("hot", 200), ("short", 800)) for i in sorted((i for i, s in rows if s == name), key=order)[:n]}
    assert {r["i"] for r in got} == want and len(got) == 700  # all 500 of the short source


def test_group_advantages(spark):
    rows = [(1, "a", 1.0), (2, "a", 3.0), (3, "a", 2.0), (4, "b", 0.1), (5, "b", 0.1), (6, "b", 0.1), (7, None, 5.0), (8, None, 9.0), (9, "c", None), (10, "a", None)]
    got = {r["i"]: r["advantage"] for r in stats.with_group_advantage(spark.createDataFrame(rows, "i long, g string, r double"), "r", "g").collect()}
    assert got == pytest.approx({1: -(1.5**0.5), 2: 1.5**0.5, 3: 0, 4: 0, 5: 0, 6: 0, 7: -1, 8: 1, 9: 0, 10: 0})


def test_long_chains_settle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r["component"] for r in dedup.components(edges).collect()} == {0}


def test_quantiles_and_balance(spark):
    rows = spark.createDataFrame([(float(i),) for i in (5, 1, 3, 2, 4)], "x double")
    assert stats.index_quantiles(rows, "x", {"q": 0.5, "p": 0.9}).first().asDict() == {"q": 3.0, "p": 5.0}
    equal = spark.createDataFrame([(c,) for c in (0, 0, 1, 1, -1)], "cluster int")
    figures = cluster.balance(equal).first()
    assert figures["gini_coefficient"] == 0.0 and figures["balance_verdict"] == "均衡" and figures["noise_pct"] == 20.0
    assert cluster.balance(equal.filter("cluster = -1")).first()["gini_coefficient"] is None


def test_decision_bounds(spark):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.09, 0.1, 0.8, 0.81)], "r double").select(stats.transition(F.col("r"))).collect()]
    assert got == ["COLD_START_FAILURE", "READY_FOR_GRPO", "READY_FOR_GRPO", "TASKS_TOO_EASY"]


def test_density_clusters(spark):
    points = [(i, [float(i % 2) * 10 + (i % 7) * 0.01, (i % 5) * 0.01]) for i in range(60)] + [(99, [100.0, 100.0])]
    got = {r["id"]: r["cluster"] for r in cluster.density_clusters(spark.createDataFrame(points, "id int, v array<double>"), "id", "v", 5, 3).collect()}
    assert got[99] == -1 and len({got[i] for i in range(0, 60, 2)}) == 1 and got[0] != got[1] and got[0] >= 0 <= got[1]


def test_auto_k_searches_up_to_fifty(spark, tmp_path):
    from corpusloom.plans.catalog import QUERIES

    pick = random.Random(3)
    rows = [(i, i % 25, [10.0 * (d == i % 25) + pick.gauss(0, 0.1) for d in range(25)]) for i in range(500)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    sizes = [r["size"] for r in QUERIES["kmeans_auto_k"](spark, str(tmp_path)).collect()]
    assert sum(sizes) == 500 and len(sizes) > 15


def test_fitting_turns():
    ids, labels = model.fitted([([1, 2], [3, 4]), ([5], [6])], 20, 0)
    assert ids == [1, 2, 3, 4, 0, 5, 6, 0] and labels == [-100, -100, 3, 4, 0, -100, 6, 0]
    assert model.fitted([([1] * 10, [2] * 10)], 8, 0)[0] == [1] * 4 + [2] * 3 + [0]


def test_first_turn_opens_and_keeps_within_its_share():
    assert model.fitted([([1, 2], [3, 4]), ([5], [6])], 20, 0, begin=(9,))[0] == [9, 1, 2, 3, 4, 0, 5, 6, 0]
    assert model.fitted([([0, 1], [2, 0]), ([], []), ([3], [4])], 30, 0, on_inputs=True) == [[1, 2, 0, 3, 4, 0]] * 2
    assert model.fitted([([1] * 3, [2] * 3), ([3] * 3, [4] * 3)], 10, 0)[0] == [1, 1, 1, 2, 2, 2, 0]  # the second turn does not fit
    assert model.fitted([], 10, 0) == [[], []]


def test_keep_first_keeps_one_row_of_null_keys(spark):
    rows = spark.createDataFrame([(1, None), (2, "a b"), (3, "A b"), (4, None), (None, "c"), (5, "")], "i long, t string")
    assert {r["i"] for r in dedup.keep_first_question(rows, F.col("t"), "i").collect()} == {1, 2, None}
    assert {r["i"] for r in dedup.keep_first(rows, F.col("t"), "i").collect()} == {1, 2, 3, None, 5}


def test_blank_turns_do_not_answer(spark):
    turns = [("user", " hi "), ("assistant", "real"), ("user", "\n"), ("assistant", "  ")]
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id int, turn int, role string, text string")
    assert tuple(convert.last_answer(rows).select("prompt", "answer").first()) == ("hi", "real")
    talk = talks(spark, [("x", turns)])
    assert tuple(talk.select(*convert.prompt_and_answer(talk)).first()) == ("hi", "real")


def test_clusters_replace_a_column_of_that_name(spark):
    rows = spark.createDataFrame([(i, 7, [float(i % 5 == d) for d in range(5)]) for i in range(60)], "id int, cluster int, v array<double>")
    own, _ = cluster.kmeans(rows, "v", 5)
    assert set(own.columns) == set(rows.columns) and own.select("cluster").distinct().count() == 5
    assert cluster.clustered(rows, "v", "id", "cluster", 3, least=5, most=7).select("cluster").distinct().count() == 5


@pytest.mark.parametrize("known", [0, 10**6])
def test_containment_equals_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(dedup, "KNOWN_GRAMS", known)
    pick = random.Random(9)
    items = ["".join(pick.choices("abcd", k=pick.randint(1, 40))) for _ in range(12)] + [""]
    docs = ["".join(pick.choices("abcd", k=60)) + items[i % 12][: pick.randint(1, 40)] for i in range(40)] + ["", "ab", None]
    grams = lambda t: {t[i : i + 5] for i in range(len(t) - 4)} if len(t) > 5 else {t} if t else set()
    want = {}
    for i, t in enumerate(docs):
        shares = [len(grams(t or "") & grams(x)) / len(grams(x)) for x in items if x and grams(t or "") & grams(x)]
        if shares:
            want[i] = max(shares)
    frames = (spark.createDataFrame(list(enumerate(x)), "i long, t string") for x in (docs, items))
    got = {r["i"]: r["containment"] for r in dedup.containment(next(frames), next(frames).withColumnRenamed("i", "e"), "i", "e", F.col("t"), F.col("t")).collect()}
    assert got == pytest.approx(want)


def test_validation_files(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"prompt": "p"}\n')
    (tmp_path / "v.jsonl").write_text('{"prompt": "q"}\n')
    both = readers.train_and_validation(spark, str(tmp_path / "t.jsonl"), str(tmp_path / "v.jsonl"))
    assert {(r["prompt"], r["split"]) for r in both.collect()} == {("p", "train"), ("q", "valid")}
    (tmp_path / "e.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="no rows"):
        readers.limited(spark, str(tmp_path / "e.jsonl"))


def test_windows_score_each_token_once():
    seen = [t for start, end, first in model.windows(100, 20, 30, 10) for t in range(first, end)]
    assert seen == list(range(20, 100))


def test_model_pipelines(spark):
    def echo():
        return lambda prompts: ["Q: 这是一个由模型写出的长问题？" if p.endswith("个问题：") else "根据文本，答案是一段足够长的文字，超过三十个字符，用来通过长度的检查。" for p in prompts]

    corpus = spark.createDataFrame([("r", 0, "段落" * 60)], "row_id string, number int, paragraph string")
    made, extra = pipelines.self_qa(corpus, echo)
    assert extra is None and made.count() == 0  # the answer shares nothing with its source
    solve = lambda: lambda prompts: ["<answer>72</answer>"] * len(prompts)
    exercises = spark.createDataFrame([("p1", "72"), ("p2", "99")], "prompt string, ground_truth string")
    out = pipelines.readiness(exercises, solve, 4).first()
    assert (out["pass_rate"], out["mean_correct"], out["format_rate"]) == (0.5, 2.0, 1.0)
    assert pipelines.evaluated_exercises(exercises, solve)[1].first()["accuracy"] == 0.5


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"prompt": "p", "ground_truth": "1"}\n\nbroken\n{"prompt": "é"}\n')
    (tmp_path / "b.json").write_text(json.dumps([{"instruction": "i", "output": "o"}]))
    (tmp_path / "c.json").write_text(json.dumps({"data": [{"question": "q"}, {"question": "r"}]}))
    (tmp_path / "d.csv").write_text("question,answer\nq,A\n")
    a = str(tmp_path / "a.jsonl")
    assert [r["prompt"] for r in readers.jsonl(spark, a).orderBy("row_id").collect()] == ["p", "é"]
    assert readers.bad_rows(readers.jsonl(spark, a, bad="keep")).first().asDict() == {"good": 2, "bad": 1}
    with pytest.raises(Exception):  # noqa: B017
        readers.jsonl(spark, a, bad="fail").collect()
    assert readers.records(spark, [str(tmp_path / n) for n in ("a.jsonl", "b.json", "c.json", "d.csv")]).count() == 6
    assert readers.exercises(spark, a).count() == 1
    assert readers.evaluation_texts(spark, [str(tmp_path)]).count() == 6
    writers.raw_lines(readers.training_lines(spark, a), str(tmp_path / "out"), order="row_id")
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines == ['{"prompt": "p", "ground_truth": "1"}', '{"prompt": "é"}']
    with pytest.raises(FileNotFoundError):
        readers.files_under(spark, str(tmp_path), "parquet")


def test_prepared_pipeline(spark):
    good = "这是一个完整的回答，" + "".join(chr(0x4E00 + i) for i in range(40)) + "。"
    rows = talks(spark, [(f"r{i}", [("human", f"问题内容是什么{i // 2}"), ("gpt", good)]) for i in range(40)])
    evals = spark.createDataFrame([("e", "问题内容是什么3")], "row_id string, text string")
    out = pipelines.prepared(rows, evals, valid=0.1)
    splits = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sum(splits.values()) in range(1, 20) and "r6" not in {r["row_id"] for r in out.collect()}


def test_streams(spark, tmp_path):
    from corpusloom.streaming import live

    rows = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    live.first_within(stream, F.col("event_type"), "ts", "365 days").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).start().processAllAvailable()
    assert spark.table("firsts").count() == rows.select("event_type").distinct().count()
    for q in spark.streams.active:
        q.stop()


def test_filter_reaches_the_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select("doc_id")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan and "text" not in plan.split("ReadSchema")[1]
