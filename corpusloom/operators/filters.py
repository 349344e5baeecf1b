"""Quality filters. A rule is a name and a condition for dropping; one CASE names the first that holds."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import metrics as M
from corpusloom.functions import text as T
from corpusloom.functions.schema import field, first_value
from corpusloom.operators.convert import source_and_qa


class Rule(NamedTuple):
    """Rows on which ``drops`` is true are dropped for ``name``; null is false."""

    name: str
    drops: Column


def first_reason(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that drops the row, null if it stays. Later rules are not evaluated."""
    out = None
    for name, drops in rules:
        out = F.when(drops, name) if out is None else out.when(drops, name)
    return out


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn("reason", first_reason(rules))


def kept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return judged(df, rules).filter("reason IS NULL").drop("reason")


def score_rules(df: DataFrame, quality: float = 5.0, reward: float = 0.0, lang: str | None = None, human: int = 5, gpt: int = 20, turns: int = 2) -> list[Rule]:
    """Scores (null counts as 0, NaN passes), language, content."""
    talk = field(df, "conversations")
    asked, told = first_value(talk, "human"), first_value(talk, "gpt")
    out = [Rule("score", (F.coalesce(field(df, "deita_score"), F.lit(0.0)) < quality) | (F.coalesce(field(df, "rw_score"), F.lit(0.0)) < reward))]
    if lang:
        out.append(Rule("lang", F.coalesce(field(df, "lang") != lang, F.lit(True))))
    return [*out, Rule("content", (F.coalesce(F.size(talk), F.lit(0)) < turns) | (F.length(told) < gpt) | (F.length(T.strip(asked)) < human))]


# Phrases of answers that do not answer.
FILLERS = ("根据提供的信息无法", "无法确定", "没有足够的信息", "请提供更多", "无法回答", "不在文中提及", "作为AI", "作为一个AI", "我无法")
# Phrases that speak of the source text, and openings of thinking aloud.
META = ("根据参考文本", "参考文本：", "分析解释：", "知识点】", "考点】", "考察方向】")
THINKING = ("嗯，", "好的，我", "用户让我", "我现在需要", "问题应覆盖", "第二个要求")
# Characters a finished text may end on, besides letters and digits.
TERMINALS = "。！？）」】\"'\n"


def contains_any(x: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(x, F.lit(p))
    return out


def truncated(x: Column, terminals: str = TERMINALS, least: int = 50) -> Column:
    """Longer than ``least`` and ending on neither a terminal nor a letter or digit."""
    return (F.length(x) > least) & ~F.regexp_like(F.right(x, F.lit(1)), F.lit(rf"(?U)[\p{{L}}\p{{N}}{T.escaped(terminals)[1:-1]}]"))


def global_rules(turns: Column, asked: Column, told: Column, share: float = 0.15, script: Column | None = None) -> list[Rule]:
    """The nine rules over a dialogue, cheap ones first; ``script`` replaces the test for the wanted script."""
    wanted = T.cjk_share_over(F.concat(asked, told), share) if script is None else script
    starts = F.lit(False)
    for p in THINKING:
        starts = starts | F.startswith(T.strip(asked), F.lit(p))
    return [
        Rule("too_few_turns", turns < 2),
        Rule("human_too_short", F.length(T.strip(asked)) < 5),
        Rule("gpt_too_short", F.length(T.strip(told)) < 5),
        Rule("gpt_repetition", M.block_repeated(told)),
        Rule("thinking_tags", contains_any(told, ("<think>", "</think>"))),
        Rule("meta_content", contains_any(told, META)),
        Rule("human_thinking", starts),
        Rule("not_chinese", ~wanted),
        Rule("truncated", truncated(told)),
    ]


def conversation_rules(df: DataFrame) -> list[Rule]:
    talk = field(df, "conversations")
    return global_rules(F.coalesce(F.size(talk), F.lit(0)), first_value(talk, "human"), first_value(talk, "gpt"))


def self_qa_rules(df: DataFrame, question: int = 10, answer: int = 30, most: int = 2000, overlap: float = 0.3, n: int = 3, fillers: Sequence[str] = FILLERS) -> list[Rule]:
    """Length, filler and, where a row has its source, overlap with it."""
    source, q, a = source_and_qa(df)
    return [
        Rule("length", (F.length(q) < F.greatest(F.lit(question), F.lit(1))) | (F.length(a) < F.greatest(F.lit(answer), F.lit(1))) | (F.length(a) > most)),
        Rule("filler", contains_any(a, fillers)),
        Rule("overlap", F.when(source != "", M.ngram_overlap(a, source, n) < overlap).otherwise(F.lit(False))),
    ]


def token_range(prompt: Column, completion: Column, least: int = 10, most: int = 2048, count: T.TokenLength = T.token_length) -> Column:
    """Both sides hold text and their tokens are within the range."""
    return (prompt != "") & (completion != "") & (count(prompt) + count(completion)).between(least, most)


def pair_chars(prompt: Column, chosen: Column, rejected: Column, most: int) -> Column:
    """Characters of prompt and either side within (0, most]."""
    fits = lambda x: (F.length(F.concat(prompt, x)) > 0) & (F.length(F.concat(prompt, x)) <= most)
    return fits(chosen) & fits(rejected)


def pair_tokens(chosen: Column, rejected: Column, most: int) -> Column:
    """Token arrays of either side within (0, most]."""
    fits = lambda x: (F.size(x) > 0) & (F.size(x) <= most)
    return fits(chosen) & fits(rejected)


def some_label(labels: Column, ignored: int = -100) -> Column:
    return F.exists(labels, lambda x: x != ignored)


def answered(answer: Column) -> Column:
    return (F.length(T.strip(answer)) >= 20) & ~F.contains(answer, F.lit("无法回答"))


def translated(question: Column, answer: Column) -> Column:
    return (F.length(question) > 5) & (F.length(answer) > 1)


def generated(prompt: Column, answer: Column) -> Column:
    return (F.length(prompt) > 15) & (F.length(answer) > 0) & (F.length(answer) < 30)


def answer_route(truth: Column) -> Column:
    """short, long or null for no answer at all."""
    own = T.strip(T.text_of(truth))
    return F.when(own == "", None).when(F.length(own) < 30, "short").otherwise("long")


def language_route(question: Column, answer: Column) -> Column:
    return F.when(T.cjk_share_over(F.concat(question, answer), 0.3), "pass").otherwise("translate")


def repetition_flags(df: DataFrame, rep: float = 0.10, sentence: float = 0.15, empty: float = 0.08) -> DataFrame:
    """Flags over the columns of the metric bundle."""
    return df.withColumns({"high_rep": (F.col("rep3") >= rep) | (F.col("sent_rep") >= sentence), "high_empty": F.col("empty_score") >= empty})
