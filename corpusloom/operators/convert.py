"""Conversions between record shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.schema import either, field, first_value, values_of

TURNS = "array<struct<from:string,value:string>>"


def human_text(instruction: Column, extra: Column) -> Column:
    """Instruction, a line end and input, each stripped and optional."""
    parts = [F.nullif(T.strip(T.text_of(x)), F.lit("")) for x in (instruction, extra)]
    return F.concat_ws("\n", *parts)


def turn(role: str, value: Column) -> Column:
    return F.struct(F.lit(role).alias("from"), value.alias("value"))


def alpaca_to_conversations(df: DataFrame) -> DataFrame:
    """Adds ``conversations``; rows without a human or assistant text go."""
    human, gpt = human_text(field(df, "instruction"), field(df, "input")), T.strip(T.text_of(field(df, "output")))
    return df.withColumn("conversations", F.array(turn("human", human), turn("gpt", gpt))).filter((human != "") & (gpt != ""))


def pairs_kept(history: Column) -> Column:
    """History as array of struct(q, a): entries that are no pair are left out."""
    return F.transform(F.filter(F.coalesce(history, F.array().cast("array<array<string>>")), lambda h: F.size(h) == 2), _pair)


def pairs_all_or_none(history: Column) -> Column:
    """History as array of struct(q, a): one entry that is no pair empties it."""
    own = F.coalesce(history, F.array().cast("array<array<string>>"))
    fine = F.forall(own, lambda h: h.isNotNull() & (F.size(h) == 2))
    return F.when(fine, F.transform(own, _pair)).otherwise(F.array().cast("array<struct<q:string,a:string>>"))


def _pair(h: Column) -> Column:
    return F.struct(h[0].alias("q"), h[1].alias("a"))


def _dialogue(history: Column, question: Column) -> Column:
    past = F.flatten(F.transform(history, lambda p: F.array(turn("human", p["q"]), turn("gpt", p["a"]))))
    return F.concat(past, F.array(turn("human", question)))


def preference_fields(df: DataFrame) -> DataFrame:
    """system, history, question, response_chosen and response_rejected with their other names; rows without a question go."""
    return df.select(
        "*" if "row_id" not in df.columns else "row_id",
        either(field(df, "system"), field(df, "system_prompt")).alias("_system"),
        pairs_kept(field(df, "history")).alias("_history"),
        T.text_of(field(df, "question")).alias("_question"),
        either(field(df, "response_chosen"), field(df, "chosen")).alias("_chosen"),
        either(field(df, "response_rejected"), field(df, "rejected")).alias("_rejected"),
    ).filter("_question <> ''")


def preference_to_prompts(df: DataFrame) -> DataFrame:
    """Dialogues that end on the question."""
    own = preference_fields(df)
    return own.select(*_id(own), F.col("_system").alias("system_prompt"), _dialogue(F.col("_history"), F.col("_question")).alias("conversations"))


def preference_to_sft(df: DataFrame) -> DataFrame:
    """Dialogues that end on the chosen answer; rows without one go."""
    own = preference_fields(df).filter("_chosen <> ''")
    full = F.concat(_dialogue(F.col("_history"), F.col("_question")), F.array(turn("gpt", F.col("_chosen"))))
    return own.select(*_id(own), F.col("_system").alias("system_prompt"), full.alias("conversations"))


def preference_pairs(df: DataFrame) -> DataFrame:
    """Chosen and rejected side by side; rows without both go."""
    own = preference_fields(df).filter("_chosen <> '' AND _rejected <> ''")
    return own.select(*_id(own), *[F.col(f"_{c}").alias(n) for c, n in (("system", "system"), ("history", "history"), ("question", "question"), ("chosen", "response_chosen"), ("rejected", "response_rejected"))])


def _id(df: DataFrame) -> list[str]:
    return [c for c in ("row_id",) if c in df.columns]


def preference_to_dpo(df: DataFrame, question: str = "question", chosen: str = "chosen", rejected: str = "rejected", system: str = "", strict: bool = True) -> DataFrame:
    """DPO rows from configurable fields; a bad row raises, or goes when not ``strict``."""
    own = df.select(
        *_id(df),
        either(field(df, "system"), F.lit(system)).alias("system"),
        pairs_all_or_none(field(df, "history")).alias("history"),
        *[T.text_of(field(df, c)).alias(n) for c, n in ((question, "question"), (chosen, "response_chosen"), (rejected, "response_rejected"))],
    )
    fine = (F.col("question") != "") & (F.col("response_chosen") != "") & (F.col("response_rejected") != "")
    if strict:
        return own.withColumn("question", F.when(fine, F.col("question")).otherwise(F.raise_error(F.lit("a preference row lacks its question or an answer"))))
    return own.filter(fine)


def role_of(role: Column) -> Column:
    """Role synonyms to user, assistant and system; others pass."""
    low = F.lower(T.strip(T.text_of(role)))
    return F.when(low.isin("human", "user"), "user").when(low.isin("gpt", "assistant", "bot"), "assistant").when(low == "system", "system").otherwise(low)


def clean_turns(df: DataFrame) -> Column:
    """Array of struct(role, text) of user and assistant turns, normalised; other roles and blank texts are left out."""
    empty = F.array().cast("array<struct<role:string,text:string>>")

    def cleaned(turns: Column, role: str, value: str, users: tuple, bots: tuple) -> Column:
        named = lambda m: F.when(m[role].isin(*users), "user").when(m[role].isin(*bots), "assistant")
        out = F.transform(turns, lambda m: F.struct(named(m).alias("role"), T.newline_normalised(T.text_of(m[value])).alias("text")))
        return F.filter(out, lambda m: m["role"].isNotNull() & (m["text"] != ""))

    share = cleaned(field(df, "conversations"), "from", "value", ("human", "user"), ("gpt", "assistant", "bot"))
    chat = cleaned(field(df, "messages"), "role", "content", ("user",), ("assistant",))
    return F.coalesce(share, chat, empty)


def last_answer(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: the last assistant turn as answer, and all earlier user turns, joined by line ends, as prompt. Texts are stripped, blank turns left out."""
    own = turns.select(conv, F.col(order).alias("_at"), role_of(F.col(role)).alias("_role"), T.strip(T.text_of(text)).alias("_text")).filter("_text <> ''")
    last = F.max(F.when(F.col("_role") == "assistant", F.struct("_at", "_text")))
    users = F.array_sort(F.collect_list(F.when(F.col("_role") == "user", F.struct("_at", "_text"))))
    found = own.groupBy(conv).agg(last.alias("_last"), users.alias("_users")).filter("_last IS NOT NULL")
    before = F.filter("_users", lambda u: u["_at"] < F.col("_last._at"))
    return found.select(conv, F.array_join(F.transform(before, lambda u: u["_text"]), "\n").alias("prompt"), F.col("_last._text").alias("answer"))


def dedup_fields(df: DataFrame) -> tuple[Column, Column, Column]:
    """Instruction, input and output for duplicate reports; the shape is that of the frame, instruction first."""
    if "instruction" in df.columns:
        return tuple(T.text_of(field(df, c)) for c in ("instruction", "input", "output"))
    if "conversations" in df.columns:
        joined = lambda role: F.array_join(values_of(F.col("conversations"), role), " ")
        return joined("human"), F.lit(""), joined("gpt")
    if "prompt" in df.columns:
        return T.text_of("prompt"), F.lit(""), either(field(df, "completion"), field(df, "ground_truth"))
    return F.to_json(F.struct("*")), F.lit(""), F.lit("")


def contamination_text(df: DataFrame) -> Column:
    """What a row asks: instruction and input, else human turns, else prompt, else question."""
    joined = lambda *parts: T.strip(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))
    asked = F.array_join(F.filter(values_of(field(df, "conversations"), "human"), lambda v: v != ""), " ")
    return (
        F.when(field(df, "instruction").isNotNull(), joined(T.text_of(field(df, "instruction")), T.text_of(field(df, "input"))))
        .when(field(df, "conversations").isNotNull(), T.strip(asked))
        .when(field(df, "prompt").isNotNull(), T.strip(field(df, "prompt")))
        .otherwise(T.strip(T.text_of(field(df, "question"))))
    )


def instruction_and_output(df: DataFrame) -> tuple[Column, Column]:
    """Question and answer to translate; null where a row has neither shape."""
    s = lambda c: T.strip(T.text_of(c))
    human, gpt = first_value(field(df, "conversations"), "human"), first_value(field(df, "conversations"), "gpt")
    shapes = [
        (field(df, "instruction").isNotNull(), human_text(field(df, "instruction"), field(df, "input")), s(field(df, "output"))),
        ((human != "") & (gpt != ""), s(human), s(gpt)),
        (field(df, "user_prompt").isNotNull(), s(field(df, "user_prompt")), s(field(df, "answer"))),
        (field(df, "question").isNotNull() & field(df, "answer").isNotNull(), s(field(df, "question")), s(field(df, "answer"))),
    ]
    pick = lambda i: F.coalesce(*[F.when(has, (q, a)[i]) for has, q, a in shapes])
    return pick(0), pick(1)


def prompt_and_answer(df: DataFrame) -> tuple[Column, Column]:
    """Prompt and answer of dialogues, chats and flat rows: of a dialogue, the last assistant turn and the user turns before it."""
    def of(turns: Column, role: str, value: str) -> tuple[Column, Column]:
        named = F.transform(turns, lambda m, i: F.struct(role_of(m[role]).alias("r"), T.strip(T.text_of(m[value])).alias("v"), i.alias("i")))
        named = F.filter(named, lambda m: m["v"] != "")
        last = F.try_element_at(F.filter(named, lambda m: m["r"] == "assistant"), F.lit(-1))
        asked = F.filter(named, lambda m: (m["r"] == "user") & (m["i"] < last["i"]))
        return F.array_join(F.transform(asked, lambda m: m["v"]), "\n"), last["v"]

    shapes = [(field(df, "conversations").isNotNull(), *of(field(df, "conversations"), "from", "value")), (field(df, "messages").isNotNull(), *of(field(df, "messages"), "role", "content"))]
    shapes += [(field(df, "prompt").isNotNull() & field(df, c).isNotNull(), field(df, "prompt"), field(df, c)) for c in ("answer", "response")]
    return tuple(F.coalesce(*[F.when(has, (q, a)[i]) for has, q, a in shapes], F.lit("")) for i in (0, 1))


def source_and_qa(df: DataFrame) -> tuple[Column, Column, Column]:
    """Source paragraph, first human and first assistant text; empty texts with fewer than two turns."""
    turns = field(df, "conversations")
    enough = F.coalesce(F.size(turns) >= 2, F.lit(False))
    of = lambda role: F.when(enough, first_value(turns, role)).otherwise(F.lit(""))
    return T.text_of(field(df, "_source_paragraph")), of("human"), of("gpt")


def corpus_text(df: DataFrame, name: str = "text") -> Column:
    """The configured text field, else content, else passage."""
    return either(field(df, name), field(df, "content"), field(df, "passage"))
