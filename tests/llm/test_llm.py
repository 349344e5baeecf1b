"""The training-data operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import components, covertree, exact, golomb, licences, mixing, near, packing, pii, quality, urls, warc
from corpusloom.llm.store import Scratch

WORDS = [f"w{i}" for i in range(200)]


def texts(seed, n=60):
    pick = random.Random(seed)
    base = [" ".join(pick.choices(WORDS, k=pick.randint(5, 120))) for _ in range(n)]
    for i in range(0, n, 3):  # near and exact copies
        words = base[i].split()
        words[pick.randrange(len(words))] = "changed"
        base.append(" ".join(words))
        base.append(base[i])
    return [*base, None, "", " \n ", "one", "ONE", "two words", "x" * 20_000, "long " * 5000 + "tail"]


def frame(spark, values, extra=True):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    # names that the operators use inside
    return out.withColumns({c: F.lit(7) for c in ("n", "node", "part", "sha", "kept", "key", "t", "length")}) if extra else out


EMPTY = "doc_id long, text string, source string"


def brute_components(values, size, percent):
    sets = []
    for v in values:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), v or "")) if w]
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    top = list(range(len(values)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    values = texts(size)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(frame(spark, values), shingle=size).collect()}
    assert got == brute_components(values, size, 80)


def drifting(seed, n=70):
    pick, words, values = random.Random(seed), WORDS[:60], []
    for _ in range(n):
        words = list(words)
        words[pick.randrange(len(words))] = f"n{pick.randrange(10**6)}"
        values.append(" ".join(words))
    return values


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_dense_groups_equal_brute_force(spark, monkeypatch, few):
    """A chain of drifting copies: chunked nodes, visits, deeper levels, split centres and the cluster-wide component rounds."""
    for module, name, value in ((near, "LIMIT", 4), (near, "PIVOTS", 1), (near, "HOOKS", 1), (near, "FEW", few), (near, "MEMBERS", 2), (components, "ONE_TASK", 0)):
        monkeypatch.setattr(module, name, value)
    values = drifting(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(frame(spark, values, False), shingle=2).collect()}
    assert got == brute_components(values, 2, 80)


@pytest.mark.parametrize("percent", [60, 75])
def test_other_thresholds_equal_brute_force(spark, percent):
    """Small sets too: at 75 of 100, three shingles are linked with four."""
    values = [*texts(percent), "a b c d", "a b c d e", "a b c", "a b", *drifting(7, 30)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(frame(spark, values), shingle=2, percent=percent).collect()}
    assert got == brute_components(values, 2, percent)


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(40):
        whole = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
        n = int(rng.integers(1, 2500))
        sets = [np.unique(whole[: n + int(rng.integers(0, n // 2 + 1))]), np.unique(whole[int(rng.integers(0, n // 4 + 1)) : n])]
        odd = near._Parities([near._parities(x) for x in sets])
        apart = odd.apart(np.array([0, 1]), np.array([1, 0]))
        assert apart[0] == apart[1] <= len(np.setxor1d(*sets))


def test_too_high_a_recall_raises():
    with pytest.raises(ValueError, match="trees"):
        near.trees_for(12, 0.4, 0.999999999)


def test_texts_are_joined_where_the_filter_cannot_tell_ids_apart(spark, monkeypatch):
    """More ids than a filter of 64 bits holds: texts are joined before their sets are built."""
    monkeypatch.setattr(near, "_FILTER_BITS", 64)
    values = texts(2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near.near_duplicates(frame(spark, values), shingle=2).collect()}
    assert got == brute_components(values, 2, 80)


def test_near_stage_keeps_one_of_each_group(spark):
    docs = frame(spark, ["a b c d e f g h"] * 3 + ["other words stand here in this one", None])
    assert sorted(r["doc_id"] for r in near.without_near_duplicates(docs).collect()) == [0, 3, 4]
    long = " ".join(f"v{i}" for i in range(60_000))
    docs = frame(spark, [long, long + " more", "short text"])
    assert sorted(r["doc_id"] for r in near.without_near_duplicates(docs.unionByName(docs)).collect()) == [0, 2]
    assert near.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_near_stage_with_null_and_repeated_ids(spark):
    one, two, three = ("a b c d e f g h", "p q r s t u v w", "k l m n o k l m")
    rows = [(1, one), (None, one + " i"), (None, "a clean text of some more words"), (None, two), (None, two + " x"), (7, three), (7, three + " y"), (7, "the same id but quite other words"), (8, "one two three four five six"), (8, "one two three four five six"), (None, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("n", "node", "sha", "component", "kept")})
    left = near.without_near_duplicates(docs.repartition(3))
    assert left.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in left.collect())
    for group in ([(None, two), (None, two + " x")], [(7, three), (7, three + " y")]):
        assert sum(got.pop(g, 0) for g in group) == 1
    assert got == Counter([(1, one), (None, "a clean text of some more words"), (7, "the same id but quite other words"), (8, "one two three four five six"), (None, None), (9, "")])


def test_component_rounds_equal_one_task(spark):
    pick = random.Random(3)
    edges = spark.createDataFrame([(pick.randrange(300), pick.randrange(300)) for _ in range(220)], "a long, b long")
    scratch = Scratch(spark, "test")
    edges = scratch.table(edges, "edges")
    one = {tuple(r) for r in components.connected_components(edges, scratch, "one").collect()}
    many = {tuple(r) for r in components.connected_components(edges, scratch, "many", one_task=0).collect()}
    assert one == many


def test_recall_of_trees():
    for depth in (2, 3, 5):
        p = near.together(depth, 0.8)
        assert (1 - p) ** near.trees_for(depth, 0.8, 0.999) <= 0.001


def test_trees_reach_the_recall_at_the_last_level(spark, monkeypatch):
    grown, expand = [], near._expand
    monkeypatch.setattr(near, "_expand", lambda depth, trees, second: grown.append((depth, trees)) or expand(depth, trees, second))
    near.near_duplicates(frame(spark, ["a b c d e f g h", "a b c d e f g h i"], False), shingle=2)
    depth, trees = grown[0]
    assert (1 - near.together(depth + near.DEEPER, 0.8)) ** trees <= 1 - near.RECALL


def test_golomb_round_trip():
    rng = np.random.default_rng(0)
    for k in (0, 1, 7, 1000):
        for width in (k or 1, 1 << 20, 1 << 48):
            values = np.unique(rng.integers(5, 5 + width, k, dtype=np.uint64))
            assert (golomb.decode(golomb.encode(values, 5, width)) == values).all()


def test_exact_duplicates_equal_brute_force(spark):
    values = [*texts(9), None, "", "same"]
    rows = [(i, v) for i, v in enumerate(values)] + [(7, values[7]), (None, "same"), (None, "only null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sha", F.lit("x")).repartition(5)
    groups = defaultdict(list)
    for i, v in rows:
        groups[v or ""].append(i)
    key = lambda i: (i is not None, i or 0)
    want = Counter((i, max(ids, key=key), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    got = exact.exact_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len(groups)
    left = exact.without_duplicates(Scratch(spark, "t").table(docs, "docs"))
    assert Counter(r["text"] or "" for r in left.collect()) == Counter(groups.keys())
    assert left.columns == ["doc_id", "text", "sha"]
    assert exact.exact_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


# The base patterns as the contract states them.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
            fine = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_python(spark):
    pick = random.Random(4)
    parts = ["a.b@c.de", "x@y", "@", "a@b.c.d-e_f@g.hi", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "0000001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111", "41111111111111111111111", "4111  1111", "+1 (555) 010-9999", "+12", "é😀", " ", "\n", "5500005555555559", ".", "-", "12"]
    values = [None, "", "1 " * 30_000, "a" * 50_000, "+" + "1" * 30_000, "a@" + "b." * 20_000 + "c", *["".join(pick.choice(parts) for _ in range(12)) for _ in range(150)]]
    docs = frame(spark, values)
    got = {r["doc_id"]: r for r in pii.digest(pii.personal_data(docs)).collect()}
    for i, v in enumerate(values):
        want = base_spans(v or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (v or "")[:200]
        assert got[i]["spans"].startswith(",".join(want))
    assert pii.digest(pii.personal_data(spark.createDataFrame([], EMPTY))).count() == 0


def test_added_spans_and_redaction(spark):
    values = ["pay to DE89 3704 0044 0532 0130 00 now", "pay to DE89370400440532013001", "my ssn is 123-45-6789.", "part 123-45-6789", "mail a@b.co and 8.8.8.8"]
    found = {r["doc_id"]: [(e["kind"], e["text"]) for e in r["entities"]] for r in pii.personal_data(frame(spark, values)).collect()}
    assert found == {0: [("iban", "DE89 3704 0044 0532 0130 00")], 1: [], 2: [("ssn", "123-45-6789")], 3: [], 4: [("email", "a@b.co"), ("ip", "8.8.8.8")]}
    assert {r["doc_id"]: r["text"] for r in pii.redacted(frame(spark, values)).collect()}[4] == "mail <email> and <ip>"


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    x = np.vstack([centres[rng.integers(6, size=700)] + 0.2 * rng.normal(size=(700, 8)), np.tile(centres[0], (300, 1))]).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 8), (5150, [1.0, 2.0])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1))
    own = data.select(F.col("vec_id").alias("id"), covertree.integer_vectors(F.col("embedding"), 256).alias("v")).filter("v IS NOT NULL")
    got = defaultdict(list)
    for r in covertree.top_k(own, own.filter("id % 50 = 0"), 5, chunk=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ints = {i: np.array([math.floor(256 * c) for c in v] + [0] * (8 - len(v))) for i, v in rows if v is not None and None not in v and all(map(math.isfinite, v))}
    for q in [i for i in ints if i % 50 == 0]:
        want = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in want]
    assert set(got) == {i for i in ints if i % 50 == 0}
    assert covertree.search_every(data.limit(0), 50).count() == 0


def test_few_candidates(spark):
    data = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (0, [1.0])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["score"]) for r in covertree.search_every(data, 50).collect()] == [(1, 256 * 512)]


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/\r\n%", "é" * 5000), (4, "u", None), (5, "u", ""), (6, "u", "x"), (6, "u", "x"), (7, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1))
    scratch = Scratch(spark, "warc-test")
    index = scratch.table(warc.write_archives(pages, scratch.at("warc")), "index")
    got = warc.read_records(index, scratch.at("warc"), payloads=True).collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got) == Counter([(1, "revisit", 6), (2, "revisit", 6), (3, "response", None), (4, "revisit", 5), (5, "response", None), (6, "response", None), (6, "revisit", 6), (7, "response", None)])
    of = {r["page_id"]: r for r in got}
    assert of[3]["url"] == "http://b/\r\n%" and of[3]["payload"].decode() == "é" * 5000 and of[3]["payload_bytes"] == 10_000
    assert of[1]["payload_digest"] == base64.b32encode(hashlib.sha1(b"x").digest()).decode() and of[2]["url"] is None
    few = warc.read_records(index.filter("page_id = 3"), scratch.at("warc")).collect()
    assert [r["page_id"] for r in few] == [3]
    none = scratch.table(warc.write_archives(pages.limit(0), scratch.at("none")), "none-index")
    assert warc.read_records(none, scratch.at("none")).count() == 0


def brute_licence(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    places = sorted((i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


def test_licences_equal_brute_force(spark):
    pick = random.Random(8)
    parts = ["MIT License", "gnu general public license", "Apache License, Version 2.0", "CC BY-NC 4.0", "é", "中文", "-", " ", "the", "license", "Licensed under the ", "12", "mit", "\n"]
    values = [None, "", "word " * 20_000 + "MIT license", *[" ".join(pick.choice(parts) for _ in range(15)) for _ in range(120)]]
    for r in licences.scan(frame(spark, values)).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licence(values[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    notice = licences.TEMPLATES[0][2]
    got = licences.scan(frame(spark, ["x y z " + notice + " more", "Permission is hereby granted", "plain"])).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["mit", "", ""] and got[0]["score"] == 1.0 and got[0]["matches"][0]["start"] == 3
    assert licences.scan(spark.createDataFrame([], EMPTY)).count() == 0


def test_licences_of_several_notices_in_one_text(spark):
    plain = ["Copyright here, all rights reserved there"] * 40  # words of the short notice are common
    notices = {label: notice for label, _, notice in licences.TEMPLATES if label in ("bsd", "gpl", "mit", "isc", "mpl")}
    text = " ".join(f"{n} and so on." for n in notices.values()) + " Copyright. All rights reserved."
    got = {r["doc_id"]: r for r in licences.scan(frame(spark, [text, *plain])).collect()}
    assert set(got[0]["labels"].split(",")) >= {*notices, "proprietary"}
    pick = random.Random(2)
    values = [" ".join(pick.choice(licences.TEMPLATES)[pick.choice((1, 2))] for _ in range(pick.randint(1, 6))) for _ in range(40)]
    found = {r["doc_id"]: Counter((m["label"], m["start"]) for m in r["matches"]) for r in licences.scan(frame(spark, values)).collect()}
    for i, v in enumerate(values):
        words = v.split()
        whole = Counter((label, p) for label, _, notice in licences.TEMPLATES for p in range(len(words)) if words[p : p + len(notice.split())] == notice.split())
        assert not whole - found[i]


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"), "x://net/": ("net", "/", "net/", "block"), "http://a.net": ("a.net", "", None, None),
        "http://example.com/de/q": ("example.com", "/de/q", "example.com/de/", "block"), "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"), "no scheme": ("", "", None, None),
        "http://h?p/net/": ("h", "", None, None), "http://badexample.com/de/": ("badexample.com", "/de/", None, None),
    }
    rows = [(i, u, "<title>cheap pills blog</title>") for i, u in enumerate([*cases, None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("score", F.lit(1))
    for r in urls.judge(pages).collect():
        host, path, rule, verdict = cases.get(rows[r["page_id"]][1], ("", "", None, None))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ([verdict] if verdict else ["allow", "block"])
    assert urls.judge(pages.limit(0)).count() == 0


def test_segmentation_and_verdicts(spark):
    own = urls.Segmenter({"garden": 50, "green": 40, "cheap": 5})
    assert own.split("cheappills") == ("cheap", "pills") and own.split("greengarden") == ("green", "garden")
    good = [f"http://greengarden{i % 7}.example/en/{i}" for i in range(200)]
    bad = [f"http://cheappills{i % 5}.example/en/{i}" for i in range(20)]
    pages = spark.createDataFrame([(i, u, "<title>green garden</title>") for i, u in enumerate(good + bad)], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, rules=()).collect()}
    assert all(got[i] == "allow" for i in range(200)) and all(got[200 + i] == "block" for i in range(20))


def test_segmentation_knows_every_title_word(spark):
    common = ["q" + "".join("abcdefghijklmnopqrstuvwxyz"[i // 26**k % 26] for k in range(4)) for i in range(50_100)]
    title = " ".join(common * 2) + " zebra garden cheap"
    rows = [(1, "http://zebragarden.example/Path/zebracheap", f"<title>{title}</title>"), (2, "http://casinogarden.example/9", "<title>casino casino garden casino</title>"), (3, "http://" + "zebra" * 4000, None), (4, None, None)]
    got = {r["page_id"]: r["words"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1][:2] == ["zebra", "garden"] and got[3] == ["zebra"] * 4000 and got[4] == []
    full = urls.Segmenter(Counter(f"{title} casino casino garden casino".split()))
    assert got[1] == full.words("zebragarden.example", "/Path/zebracheap") and got[2] == full.words("casinogarden.example", "/9")


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = quality.score_quality(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.05


def test_quality_cases(spark):
    out = {r["doc_id"]: r for r in quality.score_quality(frame(spark, [None, "", "A plain text of several words, as one reads it.", "Hi."])).collect()}
    assert not out[0]["kept"] and not out[1]["kept"] and out[2]["kept"] and out[3]["kept"]
    assert quality.score_quality(spark.createDataFrame([], EMPTY)).count() == 0
    assert quality.fit_labellers({"11": 90, "00": 10})["00"] < 0.5 < quality.fit_labellers({"11": 90, "00": 10})["11"]


def test_mixing_stays_within_a_block(spark):
    sizes = {"a": 900, "b": 300, "c": 50, None: 10}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumn("block", F.lit(0))
    plan = mixing.schedule(docs, block=4, resolution=100).toPandas()
    assert set(plan.doc_id) == set(range(1260))
    slots = mixing.quantised(mixing.smoothed(sizes), 100)
    order = plan.drop_duplicates("slot").sort_values("slot")
    assert (order.slot >= order.release).all() and (order.slot < order.deadline).all()
    assert order.slot.tolist() == list(range(len(order))) or len(order) <= order.slot.max() + 1
    seen = order.source.where(order.source.notna(), None)
    for s, a in slots.items():
        hits = np.cumsum([x == s for x in seen])
        assert np.abs(100 * hits - (order.slot.to_numpy() + 1) * a).max() < 100
    twice = docs.unionByName(docs.filter("doc_id < 3"))
    full = mixing.mixed(twice, block=4)
    assert full.columns == docs.columns and full.count() == mixing.schedule(twice, block=4).count()
    with pytest.raises(ValueError):
        mixing.schedule(docs, weights={"a": 1.0})
    assert mixing.schedule(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_mixing_stays_within_a_block_of_the_true_weights(spark):
    names = [f"s{i:05d}" for i in range(10_500)]  # more than the slots of a rounded period
    weights = [100_000] + [1] * (len(names) - 1)
    seen, total = np.zeros(len(names)), sum(weights)
    for i, j, slot, release, deadline in mixing.slots(weights, [3000] + [0] * (len(names) - 1)):
        assert release <= slot < deadline and release == j * total // weights[i]
        seen[i] += 1
        if slot % 50 == 0:
            assert np.abs(seen - (slot + 1) * np.array(weights) / total).max() < 1
    sizes = {"a": 2500, **{n: 1 for n in names[:300]}}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    targets = {s: 1 / 3 if s == "a" else 2 / 900 for s in sizes}
    plan = mixing.schedule(spark.createDataFrame(rows, "doc_id long, source string"), weights=targets, block=1).toPandas()
    order = plan.sort_values("slot")
    assert order.slot.tolist() == list(range(len(order))) and set(plan.doc_id) == set(range(len(rows)))
    hits = np.cumsum(order.source.to_numpy() == "a")
    assert np.abs(3 * hits - (order.slot.to_numpy() + 1)).max() < 3


def test_schedule_equals_a_plain_simulation(spark):
    """Every slot by the definition: of the blocks released by then and not yet run, the one of earliest deadline, then first source."""
    sizes = {None: 3, "a": 90, "b": 41, "c": 7, "d": 1}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    plan = mixing.schedule(spark.createDataFrame(rows, "doc_id long, source string"), block=4).toPandas()
    weight = {s: Fraction(n**0.7) for s, n in sizes.items()}
    total, blocks = sum(weight.values()), {s: -(-n // 4) for s, n in sizes.items()}
    done, slot, want = dict.fromkeys(sizes, 0), 0, {}
    while any(done[s] < blocks[s] for s in sizes):
        free = [(math.ceil((done[s] + 1) * total / weight[s]), i, s) for i, s in enumerate(sizes) if math.floor(done[s] * total / weight[s]) <= slot]
        deadline, _, s = min(free)
        want[slot] = s, done[s] % blocks[s], done[s] // blocks[s], deadline
        done[s] += 1
        slot += 1
        for x in sizes:
            assert abs(done[x] - slot * weight[x] / total) < 1
    got = {r.slot: (None if r.source is None or r.source != r.source else r.source, r.block, r.epoch, r.deadline) for r in plan.itertuples()}
    assert got == {k: v for k, v in want.items() if k in got} and set(want) - set(got) == set()
    for (source, _, epoch), own in plan.groupby(["source", "block", "epoch"], dropna=False):
        assert len(own) <= 4 and own.slot.nunique() == 1 and (epoch > 0 or source is not None)
    assert all(len(own) == n for s, n in sizes.items() for own in [plan[(plan.source.isna() if s is None else plan.source == s) & (plan.epoch == 0)]])


def test_mixing_of_repeated_rows_with_a_map(spark):
    docs = spark.createDataFrame([(1, "a", {"x": 1}), (1, "a", {"x": 2}), (1, "a", {"x": 2}), (2, "b", None)], "doc_id long, source string, slot map<string,int>")
    out = mixing.mixed(docs, block=1)
    assert out.columns == docs.columns
    got, own = (Counter(str(r) for r in df.collect()) for df in (out, docs))
    assert set(got) == set(own) and all(got[r] >= n for r, n in own.items())


def test_packing_fits_and_keeps_everything(spark):
    values = [*texts(2), "y" * 5000]
    docs = frame(spark, values).unionByName(frame(spark, ["repeated"])).unionByName(frame(spark, ["repeated"]))
    plan = packing.packed(docs, capacities=(64, 256, 1024), shard_rows=40).toPandas()
    want = Counter(len((v or "").encode()) + 1 for v in [*values, "repeated", "repeated"])
    whole = plan[plan.doc_id != 0].groupby("doc_id").length.sum()
    assert all(whole[i] == len((v or "").encode()) + 1 for i, v in enumerate(values) if i)
    assert plan.length.sum() == sum(n * c for n, c in want.items())
    for _, own in plan.groupby("bin_id"):
        own = own.sort_values("bin_offset")
        assert own.bin_offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        size = own.capacity.iloc[0]
        assert own.length.sum() <= size and (size == 64 or own.length.sum() > {256: 64, 1024: 256}[size])
    assert packing.packed(docs.limit(0)).count() == 0
    single = frame(spark, values)
    parts = packing.sequences(single, packing.packed(single, capacities=(64, 256, 1024))).toPandas().sort_values(["doc_id", "start"])
    assert all(b"".join(bytes(x) for x in own.bytes) == (values[i] or "").encode() for i, own in parts.groupby("doc_id"))


def plain_plan(lengths, capacities, limit, cost):
    """Best fit decreasing by the definition: every open bin is looked at."""
    room, size, bins = [], [], []
    for i, n in enumerate(lengths):
        fit = min((r for r in room if r >= n), default=None)
        if fit is not None:
            at = max(b for b, r in enumerate(room) if r == fit)
        else:
            prices = []
            for c in capacities:
                if c >= n and (c <= limit or not prices):
                    rest = sum(x for x in lengths[i + 1 :] if x <= c - n)
                    prices.append((cost(c) / (n + min(c - n, rest)), c))
            at = len(room)
            room.append(min(prices)[1])
            size.append(0)
        room[at] -= n
        size[at] += n
        bins.append(at)
    down = [next(c for c in capacities if c >= s) for s in size]
    return down, sum(map(cost, down))


def test_packing_equals_plain_best_fit():
    pick = random.Random(6)
    for _ in range(40):
        lengths = sorted((pick.choice((pick.randint(1, 20), pick.randint(1, 200))) for _ in range(pick.randint(1, 60))), reverse=True)
        for limit in (32, 64, 200):
            bins, offsets, down, total = packing._plan(lengths, (32, 64, 200), limit, packing.cost_of)
            want, price = plain_plan(lengths, (32, 64, 200), limit, packing.cost_of)
            assert sorted(down) == sorted(want) and abs(total - price) < 1e-6


def test_segmentation_equals_brute_force():
    pick = random.Random(3)
    own = urls.Segmenter({"".join(pick.choices("ab", k=pick.randint(1, 4))): pick.randint(1, 30) for _ in range(12)} | {"ab" * 17: 9})
    price = lambda w: own.cost.get(w, own.total + 2.3 * len(w))
    for _ in range(60):
        name = "".join(pick.choices("abc", k=pick.randint(1, 9)))
        splits = ([name[i:j] for i, j in zip([0, *cut], [*cut, len(name)], strict=True)] for k in range(len(name)) for cut in map(list, combinations(range(1, len(name)), k)))
        got = own.split(name)
        assert "".join(got) == name and abs(sum(map(price, got)) - min(sum(map(price, s)) for s in splits)) < 1e-9
    assert own.split("c" * 30 + "ab" * 17)[-1] == "ab" * 17 and len(own.split("z" * 70)) == 4


def test_url_model_equals_plain_counts(spark):
    rows = [(i, u, "<title>green garden café</title>") for i, u in enumerate(["http://greengarden.example/a", "http://cheappills.example/a", "http://casino9.example/green", None, "http://garden.example/b/12"] * 5)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), rules=()).collect()
    seen, urls_of = [Counter(), Counter()], [0, 0]
    for r in got:
        bad = any(w in urls.BAD for w in r["words"])
        urls_of[bad] += 1
        seen[bad].update(map(urls._bucket, r["words"]))
    total = sum(sum(c.values()) for c in seen)
    def share(k, b):
        common = (seen[0][b] + seen[1][b] + 1) / (total + urls.BUCKETS)
        return (seen[k][b] + 50 * common) / (sum(seen[k].values()) + 50)
    for r in got:
        want = math.log((urls_of[1] + 1) / (urls_of[0] + 1)) + sum(math.log(share(1, b)) - math.log(share(0, b)) for b in map(urls._bucket, r["words"]))
        assert abs(r["score"] - want) < 1e-9 and r["verdict"] == ("block" if want > 0 else "allow")


def test_title_words_are_whole(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    rows = [(1, f"http://blue{long}.example/", f"<title>{long} Café blue</title>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts, most, total = urls.title_words(pages, pages.select(*[c.alias(n) for c, n in zip(urls.host_and_path(F.col("url")), ("host", "path"), strict=True)]))
    assert counts[long] == counts["blue"] == 1 and "caf" not in counts and total == 3
    assert urls.judge(pages).first()["words"][:2] == ["blue", long]


def test_em_equals_a_plain_version():
    counts = {"110": 40, "100": 9, "001": 7, "000": 30, "1-1": 12, "0-0": 6, "011": 3}
    patterns = sorted(counts)
    post = {p: 0.1 if "0" in p else 0.9 for p in patterns}
    for _ in range(100):
        n = sum(counts.values())
        prior = min(max(sum(counts[p] * post[p] for p in patterns) / n, 0.01), 0.99)
        new = {}
        for p in patterns:
            odds = prior / (1 - prior)
            for j, v in enumerate(p):
                chance = []
                for side in (lambda q: post[q], lambda q: 1 - post[q]):
                    cells = {x: 0.5 + sum(counts[q] * side(q) for q in patterns if q[j] == x) for x in "-01"}
                    chance.append(cells[v] / sum(cells.values()))
                odds *= chance[0] / chance[1]
            new[p] = odds / (1 + odds)
        post = new
    got = quality.fit_labellers(counts)
    assert all(abs(got[p] - post[p]) < 1e-6 for p in patterns)


def test_quality_stage_with_clashing_columns(spark, monkeypatch):
    import corpus_pipeline

    docs = frame(spark, ["A plain text of several words, as one reads it.", None, "||| @@@ ||| ### ||| $$$ ||| %%% |||"] * 2).withColumns({c: F.lit(3) for c in ("votes", "score", "posterior", "kept", "_text", "h", "x.y")})
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 200)
    out = corpus_pipeline.quality_stage(spark, docs.unionByName(docs), "")
    assert out.columns == docs.columns and Counter(r["doc_id"] for r in out.collect())[0] == 2
    assert corpus_pipeline.quality_stage(spark, docs.limit(0), "").count() == 0


def test_rows_and_answers_of_many_partitions_meet(spark):
    """Partitions without rows, null ids, and texts with quotes, line ends and characters beyond the first plane."""
    values = ['say "a" \\ b\r\n\t', "\U0001f600 \u2028 é", None, "", "\x00\x01", 'say "a" \\ b\r\n\t', "\U0001f600 \u2028 é"]
    docs = spark.createDataFrame([(None if i == 5 else i, v) for i, v in enumerate(values)], "doc_id long, text string")
    for parts in (1, 3, 40):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.exact_duplicates(docs.repartition(parts)).collect()}
        keep = {0: 0, 1: 6, 2: 3, 3: 3, 4: 4, None: 0, 6: 6}
        assert {d: g[0] for d, g in got.items()} == keep
        assert {d for d, g in got.items() if g[2]} == {0, 3, 4, 6}
        assert all(g[3] == hashlib.sha256((values[5 if d is None else d] or "").encode()).hexdigest() for d, g in got.items())


def test_suspects_leave_in_cells(spark, monkeypatch):
    """One group over several cells of a partition, with the largest id repeated and null ids."""
    monkeypatch.setattr(exact, "GATHERED", 40)
    monkeypatch.setattr(exact, "OWNED", 3)
    part = iter([((i, t), (9, 0, b"") if not k else None) for k, (i, t) in enumerate([(5, "same text of a group")] * 7 + [(None, "other"), (None, "other")])])
    prints = [exact._fingerprint(hashlib.sha256(t.encode()).digest()) for t in ("same text of a group", "other")]
    check = prints[0]
    code = golomb.encode(np.sort(np.array(prints, np.uint64)), 0, 1 << exact.FINGERPRINT_BITS)
    cells = list(exact._split(3, (((i, t), (9, check, code)) if head else ((i, t), None) for (i, t), head in part)))
    assert len({c[0] for c in cells}) > 1 and sum(len(c[3]) for c in cells) == 9
    docs = spark.createDataFrame([(5, "same text of a group")] * 7 + [(None, "other")] * 3 + [(4, "same text of a group")], "doc_id long, text string").repartition(2)
    docs = Scratch(spark, "t").table(docs, "docs")
    kept = [r for r in exact.exact_duplicates(docs).collect() if r["kept"]]
    assert sorted((r["keep_id"] or 0, r["group_size"]) for r in kept) == [(0, 3), (5, 8)] and exact.without_duplicates(docs).count() == 2


def test_archives_need_a_known_store():
    assert warc._opened("/tmp/x")[1] == "/tmp/x"
    with pytest.raises(ValueError, match="cannot be kept"):
        warc._opened("dbfs://x/y")


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scratch, stages = Scratch(spark, "pipeline-test"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        stages.append(scratch.table(stage(spark, stages[-1], folder), name.replace(" ", "-")))
    assert all(s.columns == docs.columns for s in stages[:-1])
    first, second, third, fourth = (s.toPandas() for s in stages[1:5])
    kept = {r["doc_id"] for r in quality.score_quality(docs).filter("kept").collect()}
    assert set(first.doc_id) == kept
    assert sorted(second.doc_id) == sorted(first.groupby("text").doc_id.max())
    own = second.sort_values("doc_id").reset_index(drop=True)
    groups = brute_components(own.text.tolist(), 5, 80)
    assert sorted(third.doc_id) == sorted(own.doc_id[i] for i, (_, top) in groups.items() if top == i)
    assert set(fourth.doc_id) == set(third.doc_id)
    packed = stages[5].toPandas()
    assert packed.length.sum() == sum(len(t.encode()) + 1 for t in fourth.text)
