"""Dialogue windows over exploded turns (conversation, turn, role, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.functions.schema import either, field
from corpusloom.operators.convert import role_of

# How history names its speakers.
USER, ASSISTANT = "用户：", "助手："


def tail(x: Column, most: int) -> Column:
    """The last ``most`` characters, left-stripped when something was cut; 0 or less keeps all."""
    if most <= 0:
        return x
    return F.when(F.length(x) > most, F.regexp_replace(F.substring(x, -most, most), rf"(?U)\A{T.SPACE}+", "")).otherwise(x)


def said(role: Column, text: Column) -> Column:
    return F.concat(F.when(role == "user", F.lit(USER)).otherwise(F.lit(ASSISTANT)), text)


def conversation_id(df: DataFrame, position: Column) -> Column:
    named = either(*[field(df, c).cast("string") for c in ("id", "conversation_id", "uuid")])
    return F.when(named == "", F.concat(F.lit("sharegpt_"), position.cast("string"))).otherwise(named)


def cleaned_turns(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """User and assistant turns with normalised, non-blank text."""
    own = turns.select(conv, order, role_of(F.col(role)).alias("role"), T.newline_normalised(T.text_of(text)).alias("text"))
    return own.filter(F.col("role").isin("user", "assistant") & (F.col("text") != ""))


def sliding_samples(turns: DataFrame, history_turns: int = 3, most_chars: int = 2000, include_user: bool = False, least_output: int = 0, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """A sample for every user turn that an assistant turn follows, with up to ``history_turns`` earlier exchanges as input.

    A turn that answers can never ask, so the pairs are the neighbours (user,
    assistant), and a pair's history is simply what precedes it.
    """
    by = Window.partitionBy(conv).orderBy(order)
    keep = 2 * max(history_turns, 0)
    past = F.collect_list(said(F.col("role"), F.col("text"))).over(by.rowsBetween(-keep, -1)) if keep else F.array().cast("array<string>")
    own = cleaned_turns(turns, conv, order).select(conv, order, "role", "text", past.alias("_past"), F.lead("role").over(by).alias("_next"), F.lead("text").over(by).alias("output"))
    own = own.filter("role = 'user' AND _next = 'assistant'")
    history = T.strip(F.array_join("_past", "\n"))
    if include_user:
        now = F.concat(F.lit(USER), F.col("text"))
        history = F.when(history != "", F.concat(history, F.lit("\n"), now)).otherwise(now)
    numbered = own.select(
        conv, F.col("text").alias("instruction"), tail(history, most_chars).alias("input"), "output",
        (F.row_number().over(by) - 1).alias("turn_index"),
    )
    return numbered.filter(F.length(T.newline_normalised(F.col("output"))) >= least_output)


def prompt_prefixes(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """For every user turn: the exchanges completed before it (array of struct(q, a)) and the turn itself."""
    by = Window.partitionBy(conv).orderBy(order)
    own = turns.select(conv, order, role_of(F.col(role)).alias("role"), F.col(text).alias("text")).filter("role IN ('user', 'assistant') AND text IS NOT NULL")
    answered = F.when((F.col("role") == "user") & (F.lead("role").over(by) == "assistant"), F.struct(F.col("text").alias("q"), F.lead("text").over(by).alias("a")))
    own = own.withColumn("_pair", answered)
    own = own.withColumn("history", F.collect_list("_pair").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    return own.filter("role = 'user'").select(conv, order, "history", F.col("text").alias("question"))


def repaired_pairs(turns: Column) -> Column:
    """Exchanges (array of struct(q, a)) of a dialogue: a leading system turn and one leading stray turn go, everything from the
    first unknown role on goes, a turn out of its place goes, and an odd rest makes the dialogue null."""
    whole = F.coalesce(turns, F.array().cast("array<struct<from:string,value:string>>"))
    rest = lambda x: F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0)))
    body = F.when(F.get(whole, F.lit(0))["from"] == "system", rest(whole)).otherwise(whole)
    body = F.when(F.coalesce(F.get(body, F.lit(0))["from"] != "human", F.lit(True)), rest(body)).otherwise(body)
    known = F.transform(body, lambda m: F.coalesce(m["from"].isin("human", "gpt"), F.lit(False)))
    stop = F.array_position(known, F.lit(False))
    body2 = F.when(stop > 0, F.slice(body, F.lit(1), (stop - 1).cast("int"))).otherwise(body)
    kept = F.filter(body2, lambda m, j: m["from"] == F.when(j % 2 == 0, "human").otherwise("gpt"))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest((F.size(kept) / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.get(kept, (2 * i).cast("int"))["value"].alias("q"), F.get(kept, (2 * i + 1).cast("int"))["value"].alias("a")))
    enough = (F.size(whole) >= 2) & (F.size(body) >= 2) & (F.size(kept) % 2 == 0) & (F.size(kept) >= 2)
    return F.when(enough, pairs)


def dialogue_system(turns: Column, given: Column) -> Column:
    """The leading system turn, else the row's own system prompt."""
    first = F.get(turns, F.lit(0))
    return either(F.when(first["from"] == "system", first["value"]), given)
