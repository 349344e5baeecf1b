"""Text, metric, answer and template builders against plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from corpusloom.functions import answers as A
from corpusloom.functions import metrics as M
from corpusloom.functions import templates as P
from corpusloom.functions import text as T

SPACES = re.compile(r"\s+")


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("x")).alias("y")).collect()]


def strange(seed, n=60):
    pick = random.Random(seed)
    letters = "aB1 .,!?。，\t\n 　\x1c中文😀é_-()（）[]"
    return ["", " ", "a", *["".join(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(n)]]


def test_strip_and_normalisers_agree_with_python(spark):
    texts = strange(1)
    assert column(spark, texts, T.strip) == [x.strip() for x in texts]
    assert column(spark, texts, T.compacted) == [SPACES.sub("", x.lower().strip()) for x in texts]
    gone = re.compile("[" + re.escape(T.DUP_PUNCTUATION) + "]+")
    assert column(spark, texts, T.dup_normalised) == [gone.sub("", SPACES.sub(" ", x.strip().lower())) for x in texts]


def test_ngrams_keep_characters_beyond_the_plane(spark):
    texts = [*strange(2), "😀bc\nd"]
    for n in (3, 5):
        want = [[] if not x else [x] if len(x) <= n else [x[i : i + n] for i in range(len(x) - n + 1)] for x in texts]
        assert column(spark, texts, lambda c: T.ngrams(c, n)) == want  # noqa: B023


def test_tokens_sentences_keywords(spark):
    assert column(spark, ["Ab_1 中文。x"], T.tokens) == [["ab_1", "中", "文", "x"]]
    assert column(spark, ["一。 two. three；\n"], T.sentences) == [["一", "two. three"]]
    assert column(spark, ["什么 Price price a 利润率"], T.prompt_keywords) == [["price", "利润率"]]


def test_paragraphs_pack_sentences(spark):
    long = "。".join(["字" * 400] * 6) + "。"
    out = column(spark, ["短\n\n" + "中" * 120, long, "x" * 2000], T.paragraphs)
    assert out[0] == ["中" * 120]
    assert [len(p) for p in out[1]] == [1203, 1203]
    assert out[2] == ["x" * 2000]


def test_metrics(spark):
    texts = ["a b a b a b", "one two", "", "同。同。不同。"]
    assert column(spark, texts, lambda c: M.ngram_repetition(c, 2)) == [3 / 5, 0.0, 0.0, 0.0]
    assert column(spark, texts, M.sentence_repetition)[3] == 1 / 3
    block = "0123456789abcdefghijklmnopqrst"
    cases = [block * 3, block * 2 + "x" * 40, "y" * 89, "z" * 90]
    assert column(spark, cases, M.block_repeated) == [True, False, False, True]
    rows = spark.createDataFrame([("abcabc", "abc"), ("", "x"), ("ab", "ab")], "a string, s string")
    got = [r[0] for r in rows.select(M.ngram_overlap(F.col("a"), F.col("s"))).collect()]
    own = Counter(["abc", "bca", "cab", "abc"])
    assert got == [(own & Counter(["abc"])).total() / 4, 0.0, 1.0]


def test_numbers(spark):
    texts = ["1,200", "2.5万亿", "增长5%，达到3万", "-5", ".7", "none", ""]
    assert column(spark, texts, A.number) == [1200.0, 2.5e12, 50000.0, -5.0, 0.7, None, None]
    assert column(spark, ["1,200"], A.number_of_generated) == [1.0]


def test_rewards_follow_the_table(spark):
    closed, bare = "<think>" + "t" * 30 + "</think>", "<think>t</think>"
    texts = [closed + "答案72", bare, "<think>" + "t" * 60, "x" * 60, "", "x" * 19, "x" * 20, "<think>" + "t" * 2001 + "</think>a"]
    assert column(spark, texts, A.format_reward) == [1.0, 0.3, 0.0, 0.2, 0.0, 0.2, 0.2, 1.0]
    assert column(spark, texts, A.length_reward) == [1.0, 0.2, 0.3, 0.3, 0.0, 0.0, 0.1, 0.3]
    assert column(spark, ["</think>72", "72万元", "约 72.3"], lambda c: A.accuracy_reward(c, F.lit("72"))) == [1.0, 1.0, 1.0]
    assert column(spark, ["72万元"], lambda c: A.accuracy_reward(c, F.lit("72万元"))) == [0.0]


def test_matches(spark):
    rows = spark.createDataFrame([("72", "72.4"), ("100", "104"), ("abc", "xabcx"), ("", "1"), ("a", "ab")], "a string, b string")
    assert [r[0] for r in rows.select(A.same_answer(F.col("a"), F.col("b"))).collect()] == [True, True, True, False, False]
    assert column(spark, ["100", None, "x 50%"], lambda c: A.check_matches(c, F.lit("101"))) == [True, False, False]


def test_choices(spark):
    texts = ["A.", "答案是B", "AB 都对，故C正确", "A 和 B，B正确 ", "只有D", "</think>C"]
    letters = column(spark, texts, lambda c: A.choice(c, F.lit(1))[0])
    assert letters == ["A", "B", "A", "A", "D", "C"]
    assert column(spark, ["none", "或 A 或 B"], lambda c: A.choice(c, F.lit(1))[1]) == [True, True]


def test_parsers(spark):
    assert column(spark, ["Q: 这是一个足够长的问题吗？\n1. short\n2) another question here"], A.generated_questions)[0] == ["这是一个足够长的问题吗？", "another question here"]
    assert column(spark, ["题目：算一算\n答案：72\n"], lambda c: F.concat_ws("|", *A.generated_pair(c))) == ["算一算|72"]
    assert column(spark, ["问题：甲？\n回答：乙。\n好的，我"], lambda c: F.concat_ws("|", *A.translated_pair(c))) == ["甲？|乙。"]
    assert column(spark, ["<think>算 12元 和 13.5万"], A.without_thinking) == ["13.5万"]


def test_templates(spark):
    pairs = F.array(F.struct(F.lit("q").alias("q"), F.lit("a").alias("a")), F.struct(F.lit("r").alias("q"), F.lit("").alias("a")))
    shown = lambda name, system=None: spark.range(1).select(P.prompt(P.TEMPLATES[name], pairs, system)).first()[0]
    assert shown("ziya") == "<human>:q\n<bot>:a\n<human>:r\n<bot>:"
    assert shown("chatml").startswith("You are a helpful assistant.<|im_end|>\n<|im_start|>user\nq")
    assert shown("base", F.lit("S")) == "S</s>qa</s>r"
    assert len(P.TEMPLATES) == 29
    text = spark.range(1).select(P.request("answer", text=F.lit("{question}"), question=F.lit("Q"))).first()[0]
    assert "参考文本：\n{question}\n" in text and "问题：Q\n" in text
