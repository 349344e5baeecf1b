"""The library's own end-to-end plans, each one lazy chain of operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import answers as A
from corpusloom.functions import metrics as M
from corpusloom.functions import templates as P
from corpusloom.functions import text as T
from corpusloom.functions.schema import field, first_value
from corpusloom.operators import cluster, dedup, filters, model, sampling, stats
from corpusloom.operators.convert import prompt_and_answer


def prepared(df: DataFrame, evals: DataFrame, ratios: Mapping[str, float] | None = None, total: int = 50_000, valid: float = 0.05, seed: int = 42, tokens: tuple[int, int] = (10, 2048), source: str = "source") -> DataFrame:
    """Fine-tuning data from raw conversations (row_id, conversations, optional scores and source).

    Score filter, mixture, nine-rule filter, keep-first dedup, token range,
    decontamination against ``evals`` (row_id, text), split.
    """
    own = filters.kept(df, filters.score_rules(df)) if "deita_score" in df.columns else df
    if ratios:
        own = sampling.mixture(own, source, ratios, total, seed, "row_id")
    own = filters.kept(own, filters.conversation_rules(own))
    talk = field(own, "conversations")
    own = own.withColumns({"_asked": first_value(talk, "human"), "_told": first_value(talk, "gpt")})
    own = dedup.keep_first_question(own, F.col("_asked"), "row_id")
    own = own.filter(filters.token_range(F.col("_asked"), F.col("_told"), *tokens))
    flagged = dedup.contamination_flags(own, evals.withColumnRenamed("row_id", "eval_id"), "row_id", "eval_id", F.col("_asked"), F.col("text"))
    clean = flagged.filter("contamination IS NULL").drop("contamination", "_asked", "_told")
    return sampling.exact_split(clean, valid, seed, "row_id")


def analysed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the metric bundle and flags, and the distribution of each metric."""
    prompt, answer = prompt_and_answer(df)
    own = df.withColumns({"_prompt": prompt, "_answer": answer}).filter("_prompt <> '' AND _answer <> ''")
    rows = filters.repetition_flags(M.with_answer_metrics(own, F.col("_prompt"), F.col("_answer")))
    return rows, stats.distribution(rows, ["rep2", "rep3", "sent_rep", "empty_score", "kw_cov", "length", "uniq_ratio"])


def self_qa(corpus: DataFrame, make: Callable, questions: int = 3, seed: int = 42, most: int | None = None, reasoning: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Filtered question-answer rows of paragraphs, and reasoning exercises of the first third if wanted."""
    own = sampling.shuffled(corpus.withColumn("key", F.concat_ws("#", "row_id", "number")), seed, "key")
    own = own.limit(most) if most else own
    made = model.self_qa(own, "key", "paragraph", make, questions)
    extra = model.reasoning_qa(own.limit(own.count() // 3), "key", "paragraph", make) if reasoning else None
    return filters.kept(made, filters.self_qa_rules(made)), extra


def evaluated_choices(questions: DataFrame, make: Callable, shots: DataFrame | None = None, most_shots: int = 5) -> tuple[DataFrame, DataFrame]:
    """Choice questions (subject, position, question, A to D, answer) answered and their accuracy by subject and overall."""
    options = [F.col(c) for c in "ABCD"]
    own = questions
    if shots is not None:
        example = P.choice_example(F.col("question"), options, F.col("answer"))
        few = shots.select("subject", F.struct("position", example.alias("_e")).alias("_s")).groupBy("subject").agg(F.slice(F.array_sort(F.collect_list("_s")), 1, most_shots).alias("_few"))
        own = own.join(F.broadcast(few), "subject", "left")  # a row per subject
    worked = F.transform(F.coalesce("_few", F.array().cast("array<struct<position:bigint,_e:string>>")), lambda s: s["_e"]) if shots is not None else None
    own = own.withColumn("_prompt", P.choice_prompt(F.col("subject"), P.choice_example(F.col("question"), options), worked))
    told = model.choice_evaluation(own.withColumn("_key", F.concat_ws("#", "subject", "position")), "_key", "_prompt", make)
    return told, stats.choice_accuracy(told, "subject", "predicted", "answer")


def evaluated_exercises(exercises: DataFrame, make: Callable) -> tuple[DataFrame, DataFrame]:
    """Exercises (prompt, ground_truth) solved once and their accuracy."""
    own = exercises.withColumn("_ask", P.chat_prompt(F.col("prompt"), F.lit(model.EXERCISE_SYSTEM)))
    told = model.generate(own, "_ask", make).drop("attempt", "_ask")
    told = told.withColumn("correct", A.prediction_matches(F.col("response"), F.col("ground_truth")))
    return told, stats.accuracy(told, "correct")


def readiness(exercises: DataFrame, make: Callable, completions: int = 8) -> DataFrame:
    """pass@K of exercises and whether reinforcement can start."""
    return stats.pass_at_k(model.attempts(exercises, "prompt", "ground_truth", make, completions), "prompt", "attempt", "correct", "formatted")


def perplexity(df: DataFrame, make: Callable) -> DataFrame:
    """Perplexity of answers given their instruction prompts; raises where no row has an answer."""
    own = df.withColumns({"_prompt": P.instruction_prompt(field(df, "instruction"), field(df, "input")), "_answer": T.strip(T.text_of(field(df, "output")))}).filter("_answer <> ''")
    if own.isEmpty():
        raise ValueError("no row has an answer")
    return stats.perplexity(model.scored(own.select("_prompt", "_answer"), "_prompt", "_answer", make), "nll", "tokens")


def reward_comparison(df: DataFrame, make: Callable) -> DataFrame:
    """Pairwise accuracy of a reward scorer over chosen and rejected answers."""
    question = T.text_of(field(df, "question"))
    sides = {"chosen": T.text_of(field(df, "response_chosen")), "rejected": T.text_of(field(df, "response_rejected"))}
    own = df.select(*[F.coalesce(field(df, f"{s}_prompt"), F.concat(question, F.lit("\n"), x)).alias(s) for s, x in sides.items()]).withColumn("_none", F.lit(""))
    one = model.scored(own, "chosen", "_none", make).withColumnRenamed("nll", "chosen_score").drop("tokens")
    two = model.scored(one, "rejected", "_none", make).withColumnRenamed("nll", "rejected_score")
    return stats.pairwise_accuracy(two, "chosen_score", "rejected_score")


def cluster_analysis(df: DataFrame, key: str, vector: str, text: str, given: str | None = None, make: Callable | None = None, **search: int) -> dict[str, DataFrame]:
    """Clusters, balance, sizes, representatives and labels: by keywords, or by a model where one is given."""
    own = cluster.clustered(df, vector, key, given, **search).persist()
    near = cluster.representatives(own, key, vector, "cluster").join(own.select(key, F.col(text).alias("text")), key)
    if make is None:
        named = cluster.keyword_labels(near, "cluster", "text")
    else:
        cut = F.struct("rank", F.concat(F.col("rank").cast("string"), F.lit(". "), F.substring("text", 1, 200)).alias("_line"))
        asked = near.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(cut)), lambda s: s["_line"]), "\n").alias("_text"))
        told = model.generate(asked.withColumn("_ask", P.request("label", text=F.col("_text"))), "_ask", make)
        named = told.select("cluster", F.substring(T.strip(F.get(F.split(A.without_thinking(F.col("response")), "\n"), 0)), 1, 30).alias("label"))
    return {"rows": own, "balance": cluster.balance(own), "sizes": cluster.sizes(own), "representatives": near, "labels": named}
