"""Seams to language models and tokenizers, and the relational shell around them.

A generator is any function from a list of prompts to a list of texts.  It runs
in mapInPandas, once set up per task; rows keep their ids, so nothing depends on
order.  Its output is written or checkpointed before it is used again, because
generation is costly and may not repeat itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain, takewhile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import answers as A
from corpusloom.functions import templates as P
from corpusloom.functions import text as T
from corpusloom.operators import dedup, filters
from corpusloom.operators.sampling import pick

Generator = Callable[[Sequence[str]], Sequence[str]]
Scorer = Callable[[Sequence[str], Sequence[str]], Sequence[tuple[float, int]]]
Encoder = Callable[[str], Sequence[int]]

# The system text of exercises.
EXERCISE_SYSTEM = "你是一个专业的金融分析助手。请仔细分析问题并给出准确的答案。"


def generate(df: DataFrame, prompt: str, make: Callable[[], Generator], out: str = "response", completions: int = 1) -> DataFrame:
    """``df`` with a generated text per prompt; with several completions, a row for each, numbered by ``attempt``."""
    names = [c for c in df.columns if c != "attempt"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            for attempt in range(completions):
                texts = list(model([p if p is not None else "" for p in frame[prompt]]))
                yield frame[names].assign(attempt=attempt, **{out: texts})

    return df.select(*names).mapInPandas(run, f"{fields}, attempt int, `{out}` string")


def embedded(df: DataFrame, text: str, make: Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]], out: str = "embedding") -> DataFrame:
    """``df`` with unit vectors of its texts."""
    import numpy as np

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            x = np.asarray(model(list(frame[text].fillna(""))), dtype=np.float32).reshape(len(frame), -1)
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            yield frame.assign(**{out: list(x)})

    return df.mapInPandas(run, f"{fields}, `{out}` array<float>")


def cached(df: DataFrame, folder: str, key: str, text: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make(df)``, written under ``folder`` by the content of key and text, and read back if it is already there."""
    mark = df.select(F.xxhash64(key, text).cast("decimal(38,0)").alias("h")).agg(F.sum("h"), F.count("*")).first()
    path = f"{folder}/{mark[0]}-{mark[1]}"
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        make(df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def tokenized(df: DataFrame, text: str, make: Callable[[], Encoder], out: str = "input_ids") -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make()
        for frame in frames:
            yield frame.assign(**{out: [list(encode(x or "")) for x in frame[text]]})

    return df.mapInPandas(run, f"{fields}, `{out}` array<int>")


def _within(question: Sequence[int], answer: Sequence[int], most: int, end: int) -> tuple[list[int], list[int]]:
    """A turn whose sides share ``most`` tokens in proportion to their lengths; the answer leaves room for its end mark and carries it."""
    whole = len(question) + len(answer)
    asked = list(question[: most * len(question) // whole])
    told = list(answer[: max(most * len(answer) // whole - 1, 0)])
    return asked[asked[:1] == [end] :], [*told[: len(told) - (told[-1:] == [end])], end]


def fitted(turns: Sequence[tuple[Sequence[int], Sequence[int]]], most: int, end: int, on_inputs: bool = False, ignored: int = -100, begin: Sequence[int] = ()) -> tuple[list[int], list[int]]:
    """Ids and labels of a dialogue of (question, answer) turns: as many whole turns as fit in ``most`` tokens. ``begin`` opens the first question."""
    opened = [([*begin, *q] if i == 0 else q, a) for i, (q, a) in enumerate(turns)]
    cut = [_within(q, a, most, end) for q, a in opened if len(q) or len(a)]
    ends = accumulate(len(q) + len(a) for q, a in cut)
    kept = [turn for turn, _ in takewhile(lambda pair: pair[1] <= most, zip(cut, ends, strict=True))]
    hidden = [(q if on_inputs else [ignored] * len(q), a) for q, a in kept]
    return [list(chain.from_iterable(chain.from_iterable(side))) for side in (kept, hidden)]


def sft_samples(df: DataFrame, dialog: str, make: Callable[[], Encoder], most: int, end: int, on_inputs: bool = False, begin: Sequence[int] = ()) -> DataFrame:
    """input_ids, attention_mask and labels of rendered dialogues (array of query, answer, …); samples without a label go."""
    names = [f for f in df.schema if f.name != dialog]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make()
        for frame in frames:
            both = [fitted([(encode(d[i]), encode(d[i + 1])) for i in range(0, len(d) - 1, 2)], most, end, on_inputs, begin=begin) for d in frame[dialog]]
            yield frame[[f.name for f in names]].assign(input_ids=[b[0] for b in both], attention_mask=[[1] * len(b[0]) for b in both], labels=[b[1] for b in both])

    out = df.mapInPandas(run, (fields + ", " if fields else "") + "input_ids array<int>, attention_mask array<int>, labels array<int>")
    return out.filter(filters.some_label(F.col("labels")))


def padded(ids: Column, width: Column, value: int) -> Column:
    """An array, filled up to ``width`` on the right."""
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(width - F.size(ids), F.lit(0)).cast("int")))


def pair_samples(df: DataFrame, chosen: str, rejected: str, make: Callable[[], Encoder], most: int, pad: int = 0) -> DataFrame:
    """``df`` with input_ids and attention_mask of both sides, padded to the longer one; pairs with a side of no or more than ``most`` tokens go."""
    own = tokenized(tokenized(df, chosen, make, "_chosen"), rejected, make, "_rejected")
    own = own.filter(filters.pair_tokens(F.col("_chosen"), F.col("_rejected"), most))
    width = F.greatest(F.size("_chosen"), F.size("_rejected"))
    sides = {name: F.col(f"_{name}") for name in ("chosen", "rejected")}
    ids = {f"input_ids_{name}": padded(x, width, pad) for name, x in sides.items()}
    masks = {f"attention_mask_{name}": padded(F.array_repeat(F.lit(1), F.size(x)), width, 0) for name, x in sides.items()}
    return own.withColumns(ids | masks).drop("_chosen", "_rejected")


def self_qa(paragraphs: DataFrame, key: str, text: str, make: Callable[[], Generator], questions: int = 3) -> DataFrame:
    """Question and answer rows of paragraphs, as conversations with their source."""
    asked = generate(paragraphs.withColumn("_ask", P.request("questions", n=F.lit(questions), text=F.col(text))), "_ask", make).drop("attempt", "_ask")
    each = asked.select(key, text, F.posexplode(A.generated_questions(F.col("response"), questions)).alias("number", "question"))
    told = generate(each.withColumn("_ask", P.request("answer", text=F.col(text), question=F.col("question"))), "_ask", make)
    told = told.withColumn("response", T.strip(F.col("response"))).filter(filters.answered(F.col("response")))
    talk = F.array(F.struct(F.lit("human").alias("from"), F.col("question").alias("value")), F.struct(F.lit("gpt").alias("from"), F.col("response").alias("value")))
    return told.select(key, "number", talk.alias("conversations"), F.col(text).alias("_source_paragraph"))


def reasoning_qa(paragraphs: DataFrame, key: str, text: str, make: Callable[[], Generator]) -> DataFrame:
    """Prompt and ground truth of reasoning responses; those without both go. Give it the first third of the paragraphs."""
    told = generate(paragraphs.withColumn("_ask", P.request("reasoning", text=F.col(text))), "_ask", make)
    q, a = A.reasoning_pair(F.col("response"))
    return told.select(key, q.alias("prompt"), a.alias("ground_truth")).filter("prompt IS NOT NULL")


def translate(df: DataFrame, key: str, question: str, answer: str, make: Callable[[], Generator]) -> DataFrame:
    """Rows in the wanted script pass first; the others are translated, parsed and gated."""
    routed = df.withColumn("_route", filters.language_route(F.col(question), F.col(answer)))
    ready = routed.filter("_route = 'pass'").select(key, F.col(question).alias("question"), F.col(answer).alias("answer"), F.lit(0).alias("part"))
    told = generate(routed.filter("_route = 'translate'").withColumn("_ask", P.request("translate", instruction=F.col(question), output=F.col(answer))), "_ask", make)
    q, a = A.translated_pair(F.col("response"))
    done = told.select(key, q.alias("question"), a.alias("answer"), F.lit(1).alias("part")).filter(filters.translated(F.col("question"), F.col("answer")))
    return ready.unionByName(done)


def exercises(df: DataFrame, key: str, make: Callable[[], Generator], number: int = 0, seed: int = 42) -> DataFrame:
    """Exercises with short answers: taken from ``df`` (prompt, ground_truth), extracted from its long answers, and ``number`` generated ones; deduplicated and verified by solving them again."""
    routed = df.withColumn("_route", filters.answer_route(F.col("ground_truth")))
    short = routed.filter("_route = 'short'").select(F.col(key).cast("string").alias("key"), "prompt", T.strip(F.col("ground_truth")).alias("ground_truth"), F.lit(0).alias("part"))
    told = generate(routed.filter("_route = 'long'").withColumn("_ask", P.request("extract", text=F.col("ground_truth"))), "_ask", make)
    answer = A.without_thinking(F.col("response"))
    cut = told.select(F.col(key).cast("string").alias("key"), "prompt", answer.alias("ground_truth"), F.lit(1).alias("part")).filter("length(ground_truth) BETWEEN 1 AND 29")
    wanted = df.sparkSession.range(number).select(F.col("id").cast("string").alias("key"))
    wanted = wanted.withColumn("_ask", P.request("generate", topic=pick(P.TOPICS, seed, "key")))
    made = generate(wanted, "_ask", make).withColumn("response", A.without_thinking(F.col("response")))
    q, a = A.generated_pair(F.col("response"))
    new = made.select("key", q.alias("prompt"), a.alias("ground_truth"), F.lit(2).alias("part")).filter(filters.generated(F.col("prompt"), F.col("ground_truth")))
    pool = short.unionByName(cut).unionByName(new).withColumn("place", F.concat_ws(":", F.col("part").cast("string"), F.lpad("key", 20, "0")))
    return verified(dedup.keep_first_prompt(pool, F.col("prompt"), "place"), make).select("place", "prompt", "ground_truth")


def verified(df: DataFrame, make: Callable[[], Generator]) -> DataFrame:
    """Exercises (prompt, ground_truth) whose second solution agrees."""
    told = generate(df.withColumn("_ask", P.request("verify", prompt=F.col("prompt"))), "_ask", make)
    return told.filter(A.same_answer(F.col("ground_truth"), A.without_thinking(F.col("response")))).drop("attempt", "_ask", "response")


def attempts(df: DataFrame, prompt: str, truth: str, make: Callable[[], Generator], completions: int = 8) -> DataFrame:
    """Attempts at each prompt with ``correct`` and ``formatted``, ready for pass@K."""
    told = generate(df.withColumn("_ask", P.chat_prompt(F.col(prompt), F.lit(EXERCISE_SYSTEM))), "_ask", make, completions=completions).drop("_ask")
    own = told.withColumn("answer", A.tagged_answer(F.col("response")))
    return own.withColumns({"correct": A.check_matches(F.col("answer"), F.col(truth)), "formatted": F.col("answer").isNotNull()})


def choice_evaluation(questions: DataFrame, key: str, prompt: str, make: Callable[[], Generator]) -> DataFrame:
    """Questions with the letter that the model chose and whether it was a guess."""
    told = generate(questions, prompt, make).drop("attempt")
    letter, guess = A.choice(F.col("response"), F.col(key))
    return told.withColumns({"predicted": letter, "is_guess": guess})


def side_by_side(df: DataFrame, prompt: str, one: Callable[[], Generator], two: Callable[[], Generator]) -> DataFrame:
    first = generate(df, prompt, one, "response_one").drop("attempt")
    return generate(first, prompt, two, "response_two").drop("attempt")


def windows(length: int, answer_from: int, most: int, stride: int, parity: bool = False) -> list[tuple[int, int, int]]:
    """(start, end, first scored token) of a sliding evaluation; each token from ``answer_from`` is scored once.

    With ``parity``, windows after the last new token score it again.
    """
    out, done = [], answer_from
    for start in range(0, length - 1, stride):
        end = min(start + most, length)
        first = max(done, answer_from, start + 1) if not parity else max(answer_from, start + (min(most - stride, end - start - 1) if start else 0), start + 1)
        if first < end:
            out.append((start, end, first))
        done = max(done, end)
    return out


def scored(df: DataFrame, prompt: str, answer: str, make: Callable[[], Scorer]) -> DataFrame:
    """``df`` with the summed loss and number of answer tokens."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = make()
        for frame in frames:
            both = list(score(list(frame[prompt]), list(frame[answer])))
            yield frame.assign(nll=[float(b[0]) for b in both], tokens=[int(b[1]) for b in both])

    return df.mapInPandas(run, f"{fields}, nll double, tokens long")
