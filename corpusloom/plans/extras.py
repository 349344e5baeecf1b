"""Further queries over whole tables: readers and writers by round trips, gates, parsers, prompts and model seams.

Round trips write to a folder of their own under the shared checkpoint folder.
Model seams run with stand-ins that answer by rule, so that SQL can tell what
comes out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import answers as A
from corpusloom.functions import metrics as B
from corpusloom.functions import templates as P
from corpusloom.functions import text as T
from corpusloom.operators import cluster, convert, dedup, filters, model, sampling, stats

from corpusloom.plans.catalog import _answers, _bench, _docs, _talks, _vectors, query
from corpusloom.plans.oracles import _ANSWERS, _COMMAS, _METRICS, _NUMBER, _TALK, _first, _q, _strip, _value
from corpusloom.session import shared_path
from corpusloom.sources import readers, writers


def _json_line(*names: str):
    """A row as a JSON line with these keys and text columns of the same names."""
    return F.to_json(F.struct(*names))


def _exercises(spark, d):
    """Documents as exercises; every third lacks its ground truth."""
    return _docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("prompt"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("ground_truth"))


def _written_lines(spark, d, name):
    """JSON lines of the exercises; every tenth document is followed by a broken line and a blank one."""
    own = _exercises(spark, d)
    line = _json_line("id", "prompt", "ground_truth")
    broken = F.when(F.col("id").cast("long") % 10 == 0, F.array(line, F.lit('{"prompt": '), F.lit("  "))).otherwise(F.array(line))
    path = shared_path(spark, name) + "/lines.jsonl"
    own.select(F.explode(broken).alias("value")).write.text(path)
    return path


@query
def jsonl_lenient(spark, d):
    """SRC1 SRC7"""
    rows = readers.jsonl(spark, _written_lines(spark, d, "lenient"))
    return rows.select(F.col("id").cast("long").alias("doc_id"), F.md5("prompt").alias("hash"))


@query
def jsonl_counted(spark, d):
    """SRC2"""
    return readers.bad_rows(readers.jsonl(spark, _written_lines(spark, d, "counted"), bad="keep"))


@query
def jsonl_strict(spark, d):
    """SRC3 SRC23 SNK1"""
    path = shared_path(spark, "strict")
    writers.jsonl(_exercises(spark, d), path + "/lines.jsonl")
    return readers.jsonl(spark, path + "/lines.jsonl", bad="fail").select(F.col("id").cast("long").alias("doc_id"), F.md5("prompt").alias("hash"), "ground_truth")


@query
def json_arrays(spark, d):
    """SRC4 SRC5 SRC12 SRC18: files of at most 500 records, as a list or in ``data``"""
    path = shared_path(spark, "arrays")
    group = F.expr("cast(id AS long) div 500")
    rows = _exercises(spark, d).withColumn("at", group).groupBy("at").agg(F.collect_list(F.struct("id", "prompt")).alias("data"))
    value = F.when(F.col("at") % 2 == 0, F.to_json("data")).otherwise(F.to_json(F.struct("data")))
    rows.select("at", value.alias("value")).write.partitionBy("at").text(path)
    return readers.json_documents(spark, path).select(F.col("id").cast("long").alias("doc_id"), F.md5("prompt").alias("hash"))


@query
def mixed_formats(spark, d):
    """SRC8 SRC9 SRC13: a file of each kind, read as one"""
    path, own = shared_path(spark, "formats"), _docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.col("lang"), F.md5("text").alias("text"))
    of = lambda lang: own.filter(F.col("lang") == lang)
    of("en").write.parquet(path + "/en.parquet")
    of("fr").write.json(path + "/fr.jsonl")
    of("de").write.option("header", "true").csv(path + "/de.csv")
    of("es").write.json(path + "/es.jsonl")
    return readers.records(spark, [f"{path}/{n}" for n in ("en.parquet", "fr.jsonl", "de.csv", "es.jsonl")]).select(F.col("id").cast("long").alias("doc_id"), "lang", F.col("text").alias("hash"))


@query
def split_sources(spark, d):
    """SRC13: named files per split, and one cut from train where there is none"""
    path, own = shared_path(spark, "splits"), _exercises(spark, d)
    writers.jsonl(own, path + "/train.jsonl")
    both = readers.train_and_validation(spark, path + "/train.jsonl", None, 10, "id")
    return both.select(F.col("id").cast("long").alias("doc_id"), "split")


@query
def raw_lines_kept(spark, d):
    """SRC7 SNK2: malformed lines go, the others come out byte for byte"""
    path = shared_path(spark, "raw")
    line = F.concat(F.lit('{ "id" :"'), F.col("doc_id").cast("string"), F.lit('",  "prompt": "é '), F.md5("text"), F.lit('"}'))
    _docs(spark, d).select(F.explode(F.array(line, F.lit("[broken"))).alias("value")).write.text(path + "/in")
    writers.raw_lines(readers.training_lines(spark, path + "/in"), path + "/out", order="row_id")
    return spark.read.text(path + "/out").select(F.md5("value").alias("hash"))


@query
def routed_output(spark, d):
    """SNK3 DEC3"""
    path = shared_path(spark, "routed")
    own = _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("raw"), "lang")
    writers.routed(own, F.when(F.col("lang") == "en", "clean").otherwise("removed"), {n: f"{path}/{n}" for n in ("clean", "removed")})
    read = lambda n: spark.read.text(f"{path}/{n}").select(F.col("value").cast("long").alias("doc_id"), F.lit(n).alias("route"))
    return read("clean").unionByName(read("removed"))


@query
def report_file(spark, d):
    """SNK4 AGG5"""
    path = shared_path(spark, "report")
    writers.report(stats.kept_report(_docs(spark, d).withColumn("reason", F.when(F.col("n_chars") < 200, "short"))), path)
    return spark.read.schema("total long, kept long, dropped long").json(path)


@query
def clusters_dump(spark, d):
    """SNK5 DUP3: lines of the dump of the largest clusters"""
    path = shared_path(spark, "clusters")
    own = _docs(spark, d).select("doc_id", dedup.identity(T.dup_normalised(F.col("text"))).alias("hash"), F.col("source").alias("i"), F.lit("").alias("x"), F.translate("text", "\n\r", "  ").alias("o"))
    top = dedup.top_clusters(own, "hash", "doc_id", columns=("i", "x", "o"))
    writers.clusters_text(top, path, "hash", "doc_id", "i", "x", "o", cut=400)
    lines = spark.read.text(path)
    heads = F.regexp_extract("value", r"^--- example (\d+) \(idx=(\d+)\) ---$", 2)
    return lines.select(heads.alias("head")).filter("head <> ''").select(F.col("head").cast("long").alias("doc_id"))


@query
def flagged_files(spark, d):
    """SNK8 FLT19 MET7: rows of the three files"""
    path = shared_path(spark, "flagged")
    own = B.with_answer_metrics(_docs(spark, d).select("doc_id", "source", "text"), F.col("source"), F.col("text"))
    writers.flagged(filters.repetition_flags(own).select("doc_id", "high_rep", "high_empty"), path)
    read = lambda n: spark.read.schema("doc_id long").json(f"{path}/{n}").select("doc_id", F.lit(n).alias("file"))
    return read("all").unionByName(read("high_rep")).unionByName(read("high_empty"))


@query
def labels_file(spark, d):
    """SNK9"""
    path = shared_path(spark, "labels")
    writers.labels(_vectors(spark, d), path, "vec_id")
    return spark.read.parquet(path).select("vec_id", "cluster")


@query
def conversation_files(spark, d):
    """CNV18 SRC20: only the conversations are written; the first question of each is read back"""
    path = shared_path(spark, "talks")
    writers.conversations(_talks(spark, d), path + "/talks.jsonl")
    return readers.first_questions(spark, path + "/talks.jsonl").select(F.md5("text").alias("hash"))


@query
def complete_exercises(spark, d):
    """SRC14 SRC15 SRC19"""
    return readers.exercises(spark, _written_lines(spark, d, "exercises")).select(F.col("id").cast("long").alias("doc_id"), "ground_truth")


@query
def limited_exercises(spark, d):
    """SRC17 SMP9: the first rows by position, of a file that must have some"""
    path = shared_path(spark, "limited")
    _exercises(spark, d).orderBy(F.col("id").cast("long").asc_nulls_last()).write.json(path + "/rows.jsonl")  # files of one range each, named in their order
    return readers.limited(spark, path + "/rows.jsonl", 25).select(F.col("id").cast("long").alias("doc_id"))


@query
def evaluation_files(spark, d):
    """SRC6 SRC11 DEC4: evaluation texts of a folder, and rows per evaluation source"""
    path = shared_path(spark, "evals")
    for part in (0, 1):
        _bench(spark, d).filter(F.col("item_id") % 2 == part).select(F.col("text").alias("question")).write.json(f"{path}/set{part}")
    texts = readers.evaluation_texts(spark, [f"{path}/set{part}" for part in (0, 1)])
    return dedup.evaluation_sources(texts, "source").select(F.element_at(F.split("source", "/"), -1).alias("source"), "rows", "distinct_texts")


@query
def cached_vectors(spark, d):
    """SRC21 CLU1: embedded once, read back the second time"""
    own, folder = _docs(spark, d).select("doc_id", "text", "n_chars"), shared_path(spark, "cache")
    for _ in range(2):
        out = model.cached(own, folder, "doc_id", "text", lambda df: model.embedded(df, "text", length_vectors))
    return out.select("doc_id", F.round(F.col("embedding")[0].cast("double"), 4).alias("x"), F.round(F.col("embedding")[1].cast("double"), 4).alias("y"))


@query
def gates(spark, d):
    """FLT11 FLT12 FLT13 FLT15 FLT16 FLT17 FLT18"""
    own, text, source = _docs(spark, d), F.col("text"), F.col("source")
    words = lambda x: F.split(x, " ")
    labels = F.array(F.when(F.col("doc_id") % 4 == 0, F.lit(-100)).otherwise(F.col("n_chars").cast("int")), F.lit(-100))
    said = F.when(F.col("doc_id") % 5 == 0, F.concat(text, F.lit("无法回答"))).otherwise(F.substring(text, 1, 25))
    return own.select(
        "doc_id", filters.pair_chars(F.col("lang"), text, source, 600).alias("chars"), filters.pair_tokens(words(text), words(source), 80).alias("tokens"), filters.some_label(labels).alias("labelled"),
        filters.answered(said).alias("answered"), filters.translated(source, F.col("lang")).alias("translated"), filters.generated(text, source).alias("generated"),
        filters.answer_route(F.when(F.col("doc_id") % 3 == 0, F.lit(" ")).when(F.col("doc_id") % 3 == 1, source).otherwise(text)).alias("route"),
    )


@query
def self_qa_gate(spark, d):
    """FLT5 FLT6: questions and answers of documents, every fourth answer with a filler"""
    answer = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("作为AI，"), "text")).otherwise(F.col("text"))
    talk = F.array(convert.turn("human", F.concat("source", F.lit(" in "), "lang")), convert.turn("gpt", answer))
    own = _docs(spark, d).select("doc_id", talk.alias("conversations"))
    return filters.judged(own, filters.self_qa_rules(own, question=12)).select("doc_id", "reason")


@query
def text_normalisers(spark, d):
    """TXT5 TXT6 TXT7"""
    own = _docs(spark, d).withColumn("x", F.concat(F.lit("（"), "text", F.lit("）。 ，!？")))
    forms = {"reward": T.answer_normalised(F.col("x")), "check": T.answer_normalised(F.col("x"), T.CHECK_PUNCTUATION), "calc": T.calc_normalised(F.col("x"))}
    return own.select("doc_id", *[F.md5(f).alias(n) for n, f in forms.items()])


@query
def choice_prompts(spark, d):
    """TPL6"""
    options = [F.col("lang"), F.col("source"), F.lit("x"), F.col("n_chars")]
    shot = P.choice_example(F.col("source"), options, F.lit("B"))
    own = P.choice_prompt(F.col("lang"), P.choice_example(F.col("text"), options), F.array(shot, shot))
    return _docs(spark, d).select("doc_id", F.md5(own).alias("hash"))


_FIELDS = {"questions": {"n": "'3'", "text": "text"}, "answer": {"text": "text", "question": "source"}, "reasoning": {"text": "text"}, "translate": {"instruction": "source", "output": "text"}, "generate": {"topic": "source"}, "extract": {"text": "text"}, "verify": {"prompt": "text"}, "label": {"text": "text"}}


@query
def model_requests(spark, d):
    """TPL7"""
    return _docs(spark, d).select("doc_id", *[F.md5(P.request(name, **{f: F.expr(x) for f, x in fields.items()})).alias(name) for name, fields in _FIELDS.items()])


@query
def shuffled_ranks(spark, d):
    """SMP2"""
    return sampling.ranked(_docs(spark, d).select("doc_id"), sampling.order_key(42, "doc_id")).select("doc_id", F.col("rank").cast("long").alias("rank"))


@query
def display_sample(spark, d):
    """SMP11"""
    return sampling.sample(_docs(spark, d), 20, 5, "doc_id").select("doc_id")


@query
def parsed_questions(spark, d):
    """ANS10"""
    said = F.concat(F.lit(" Q: what is "), "source", F.lit("\n2. short\n\n3、"), "lang", F.lit(" asks for more\nplain line of "), "lang")
    return _docs(spark, d).select("doc_id", F.array_join(A.generated_questions(said), "|").alias("questions"), F.size(A.generated_questions(said, 2)).cast("long").alias("used"))


@query
def parsed_pairs(spark, d):
    """ANS11 ANS12 ANS13: every third text lacks its answer"""
    tail = lambda x: F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(x)
    made = F.concat(F.lit("题目：how much is "), "source", tail(F.concat(F.lit("\n答案： "), F.col("doc_id").cast("string"), F.lit("元\nmore"))))
    told = F.concat(F.lit("问题：what is "), "source", tail(F.concat(F.lit("\n回答： "), "lang", F.lit("\n好的，done"))))
    thought = F.concat(F.lit("Q: how many "), "source", F.lit("\n"), tail(F.concat(F.lit("<answer> "), "lang", F.lit("</answer>"))))
    pairs = (A.generated_pair(made), A.translated_pair(told), A.reasoning_pair(thought))
    return _docs(spark, d).select("doc_id", *[x.alias(f"{side}{i}") for i, pair in enumerate(pairs) for side, x in zip("qa", pair, strict=True)])


# Stand-ins for models.
def length_vectors():
    return lambda texts: [[3.0 * (1 + len(t) % 5), 4.0 * (1 + len(t) % 3)] for t in texts]


def reversing():
    return lambda prompts: [p[::-1] for p in prompts]


def doubling():
    return lambda prompts: [p + p for p in prompts]


def solving():
    return lambda prompts: [f"<think>so</think><answer>{p.count('e') % 4}</answer>" if p.count("e") % 3 else "no idea" for p in prompts]


def choosing():
    return lambda prompts: ["ABCD"[len(p) % 4] + "." for p in prompts]


def translating():
    return lambda prompts: ["问题：translated question\n回答：translated answer\n好的" for _ in prompts]


def counting():
    return lambda prompts, answers: [(0.5 * len(a), len(a)) for _, a in zip(prompts, answers, strict=True)]


@query
def generated_texts(spark, d):
    """MDL1 MDL9: two models side by side"""
    own = _docs(spark, d).select("doc_id", F.concat("source", F.lit("/"), "lang").alias("prompt"))
    return model.side_by_side(own, "prompt", reversing, doubling).select("doc_id", "response_one", "response_two")


@query
def solved_attempts(spark, d):
    """MDL5 AGG9 ANS6: every exercise is tried four times"""
    own = _docs(spark, d).select("doc_id", F.col("lang").alias("prompt"), F.lit("1").alias("truth"))
    tried = model.attempts(own, "prompt", "truth", solving, 4)
    return tried.groupBy("doc_id").agg(F.count_if("correct").alias("n_correct"), F.count_if("formatted").alias("n_formatted"))


@query
def chosen_answers(spark, d):
    """MDL6 ANS9 AGG8"""
    own = _docs(spark, d).select("doc_id", F.col("source").alias("prompt"), F.lit("B").alias("answer"), "lang")
    return stats.choice_accuracy(model.choice_evaluation(own, "doc_id", "prompt", choosing), "lang", "predicted", "answer")


@query
def translated_rows(spark, d):
    """MDL3 ANS12 FLT16 FLT20"""
    asked = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("中文"), F.expr("repeat('内容', cast(length(text) AS int))"))).otherwise(F.col("source"))
    own = _docs(spark, d).select("doc_id", asked.alias("q"), F.col("text").alias("a"))
    return model.translate(own, "doc_id", "q", "a", translating).select("doc_id", F.md5("question").alias("question"), F.md5("answer").alias("answer"), "part")


@query
def answer_losses(spark, d):
    """MDL7 MDL8 AGG11 AGG16"""
    own = _docs(spark, d).select(F.col("source").alias("p"), F.col("text").alias("a"))
    return stats.perplexity(model.scored(own, "p", "a", counting), "nll", "tokens").withColumn("perplexity", F.round("perplexity", 9))


@query
def preference_tokens(spark, d):
    """CNV20 TOK1 TOK3 FLT12: both sides of a pair as bytes, padded to the longer one"""
    own = _docs(spark, d).select("doc_id", F.concat("lang", F.lit(" "), "source").alias("chosen"), F.col("lang").alias("rejected"))
    both = model.pair_samples(own, "chosen", "rejected", byte_ids, 64)
    return both.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("input_ids_chosen", "input_ids_rejected", "attention_mask_rejected")])


def byte_ids():
    return lambda text: list(text.encode())


@query
def fitted_dialogues(spark, d):
    """TOK2 FLT13: two turns of bytes within 40 tokens"""
    own = _docs(spark, d).select("doc_id", F.array("source", "lang", "lang", "source").alias("dialog"))
    made = model.sft_samples(own, "dialog", byte_ids, 40, 0)
    return made.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"), F.size(F.filter("labels", lambda x: x != -100)).cast("long").alias("n_labels"))


@query
def calc_details(spark, d):
    """AGG10 ANS4: the first wrong and right answers by position"""
    own = _answers(spark, d)
    judged = own.withColumn("correct", A.prediction_matches(F.col("said"), F.col("shown")))
    return stats.first_details(judged, "doc_id", 20).select("doc_id", "correct")


@query
def projected_vectors(spark, d):
    """SNK7: the two directions of largest variance; figures that do not depend on a sign"""
    flat = cluster.projected(_vectors(spark, d), "embedding")
    return flat.agg(F.count("*").alias("n"), (F.variance("x") >= F.variance("y")).alias("ordered"), F.round(F.abs(F.avg("x")) + F.abs(F.avg("y")), 6).alias("centre"))


def _fields_filled(name: str) -> str:
    out = _q(P.REQUESTS[name])
    for f, x in _FIELDS[name].items():
        out = f"replace({out}, '{{{f}}}', {x})"
    return f"md5({out})"


_EXERCISE_ROWS = "SELECT doc_id, md5(text) AS hash FROM documents"
_CLASS = r"，。、；：\"''！？,.:;!?\-()"
_E = "length(a) - length(replace(a, 'e', ''))"
_ASK = "'<|im_start|>system' || chr(10) || '" + model.EXERCISE_SYSTEM + "' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || lang || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)"
_EXAMPLE = "'题目：' || {q} || chr(10) || 'A. ' || lang || chr(10) || 'B. ' || source || chr(10) || 'C. x' || chr(10) || 'D. ' || n_chars || chr(10) || '答案是：'"

ORACLE_SQL = {
    "jsonl_lenient": _EXERCISE_ROWS,
    "jsonl_counted": "SELECT count(*) AS good, count(*) FILTER (WHERE doc_id % 10 = 0) AS bad FROM documents",
    "jsonl_strict": "SELECT doc_id, md5(text) AS hash, CASE WHEN doc_id % 3 <> 0 THEN lang END AS ground_truth FROM documents",
    "json_arrays": _EXERCISE_ROWS,
    "mixed_formats": "SELECT doc_id, lang, md5(text) AS hash FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')",
    "split_sources": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id::VARCHAR) <= round_even(count(*) OVER () * 10 / 100, 0) THEN 'valid' ELSE 'train' END AS split FROM documents",
    "raw_lines_kept": """SELECT md5('{ "id" :"' || doc_id || '",  "prompt": "é ' || md5(text) || '"}') AS hash FROM documents""",
    "routed_output": "SELECT doc_id, CASE WHEN lang = 'en' THEN 'clean' ELSE 'removed' END AS route FROM documents",
    "report_file": "SELECT count(*) AS total, count(*) FILTER (WHERE n_chars >= 200) AS kept, count(*) FILTER (WHERE n_chars < 200) AS dropped FROM documents",
    "flagged_files": f"{_METRICS}, f AS (SELECT doc_id, rep3 >= 0.1 OR sent_rep >= 0.15 AS r, empty_score >= 0.08 AS e FROM m) SELECT doc_id, 'all' AS file FROM f UNION ALL SELECT doc_id, 'high_rep' FROM f WHERE r UNION ALL SELECT doc_id, 'high_empty' FROM f WHERE e",
    "labels_file": "SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS cluster FROM embeddings",
    "conversation_files": f"WITH {_TALK} SELECT md5({_first('human')}) AS hash FROM talk WHERE {_first('human')} <> ''",
    "complete_exercises": "SELECT doc_id, lang AS ground_truth FROM documents WHERE doc_id % 3 <> 0",
    "limited_exercises": "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25",
    "evaluation_files": f"SELECT 'set' || (item_id % 2) AS source, count(*) AS rows, count(DISTINCT {_strip('text')}) AS distinct_texts FROM benchmark GROUP BY 1",
    "cached_vectors": "WITH v AS (SELECT doc_id, 3.0 * (1 + length(text) % 5) AS x, 4.0 * (1 + length(text) % 3) AS y FROM documents) SELECT doc_id, round((x / sqrt(x * x + y * y))::DOUBLE, 4) AS x, round((y / sqrt(x * x + y * y))::DOUBLE, 4) AS y FROM v",
    "gates": f"""SELECT doc_id, length(lang || text) BETWEEN 1 AND 600 AND length(lang || source) BETWEEN 1 AND 600 AS chars, len(string_split(text, ' ')) <= 80 AND len(string_split(source, ' ')) <= 80 AS tokens,
        doc_id % 4 <> 0 AND n_chars <> -100 AS labelled, doc_id % 5 <> 0 AND length({_strip('substr(text, 1, 25)')}) >= 20 AS answered, length(source) > 5 AND length(lang) > 1 AS translated, length(text) > 15 AND length(source) BETWEEN 1 AND 29 AS generated,
        CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN {_strip('source')} = '' THEN NULL WHEN length({_strip('source')}) < 30 THEN 'short' ELSE 'long' END
            ELSE CASE WHEN {_strip('text')} = '' THEN NULL WHEN length({_strip('text')}) < 30 THEN 'short' ELSE 'long' END END AS route FROM documents""",
    "self_qa_gate": """WITH a AS (SELECT doc_id, length(source || ' in ' || lang) AS q, length(text) + CASE WHEN doc_id % 4 = 0 THEN 5 ELSE 0 END AS n FROM documents)
        SELECT doc_id, CASE WHEN q < 12 OR n < 30 OR n > 2000 THEN 'length' WHEN doc_id % 4 = 0 THEN 'filler' END AS reason FROM a""",
    "text_normalisers": rf"""WITH x AS (SELECT doc_id, '（' || text || '）。 ，!？' AS x FROM documents) SELECT doc_id, md5(lower(regexp_replace(x, '[{_CLASS}（）\s]', '', 'g'))) AS reward, md5(lower(regexp_replace(x, '[{_CLASS}\s]', '', 'g'))) AS "check", md5(regexp_replace(lower(x), '[，。\s]', '', 'g')) AS calc FROM x""",
    "choice_prompts": f"""SELECT doc_id, md5('以下是关于' || lang || '的单项选择题，请直接给出正确答案的选项。' || chr(10) || chr(10) || repeat({_EXAMPLE.format(q='source')} || 'B' || chr(10) || chr(10), 2) || {_EXAMPLE.format(q='text')}) AS hash FROM documents""",
    "model_requests": "SELECT doc_id, " + ", ".join(f'{_fields_filled(n)} AS "{n}"' for n in _FIELDS) + " FROM documents",
    "shuffled_ranks": "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) AS rank FROM documents",
    "display_sample": "SELECT doc_id FROM documents ORDER BY md5('5|' || doc_id), doc_id LIMIT 20",
    "parsed_questions": """WITH l AS (SELECT doc_id, list_filter(['what is ' || source, 'short', lang || ' asks for more', 'plain line of ' || lang], lambda s: length(s) > 10) AS q FROM documents)
        SELECT doc_id, array_to_string(q, '|') AS questions, least(len(q), 2)::BIGINT AS used FROM l""",
    "parsed_pairs": """WITH h AS (SELECT *, doc_id % 3 <> 0 AS a FROM documents) SELECT doc_id, CASE WHEN a THEN 'how much is ' || source END AS q0, CASE WHEN a THEN doc_id || '元' END AS a0,
        CASE WHEN a THEN 'what is ' || source END AS q1, CASE WHEN a THEN lang END AS a1, CASE WHEN a THEN 'how many ' || source END AS q2, CASE WHEN a THEN lang END AS a2 FROM h""",
    "generated_texts": "SELECT doc_id, reverse(source || '/' || lang) AS response_one, source || '/' || lang || source || '/' || lang AS response_two FROM documents",
    "solved_attempts": f"""WITH p AS (SELECT doc_id, {_ASK} AS a FROM documents), e AS (SELECT doc_id, {_E} AS n FROM p) SELECT doc_id, CASE WHEN n % 3 <> 0 AND n % 4 = 1 THEN 4 ELSE 0 END::BIGINT AS n_correct, CASE WHEN n % 3 <> 0 THEN 4 ELSE 0 END::BIGINT AS n_formatted FROM e""",
    "chosen_answers": "SELECT lang, count(*) FILTER (WHERE length(source) % 4 = 1) AS correct, count(*) AS total, (count(*) FILTER (WHERE length(source) % 4 = 1))::DOUBLE / count(*) AS accuracy FROM documents GROUP BY ROLLUP (lang)",
    "translated_rows": """SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND text <> '' THEN md5('中文' || repeat('内容', length(text)::INT)) ELSE md5('translated question') END AS question,
        CASE WHEN doc_id % 2 = 0 THEN md5(text) ELSE md5('translated answer') END AS answer, (doc_id % 2)::INT AS part FROM documents""",
    "answer_losses": "SELECT sum(length(text))::BIGINT AS tokens, 0.5::DOUBLE AS loss, round(exp(0.5::DOUBLE), 9) AS perplexity FROM documents",
    "calc_details": f"""WITH {_ANSWERS}, b AS (SELECT *, string_split(said, '</think>')[-1] AS part, {_value(_COMMAS.format('shown'))} AS v FROM a)
        SELECT doc_id, CASE WHEN v IS NOT NULL THEN len(list_filter(regexp_extract_all(regexp_replace(part, '[,，]', '', 'g'), '{_NUMBER}'), lambda n: abs(n::DOUBLE - v) < 0.5 OR (v <> 0 AND abs(n::DOUBLE - v) / abs(v) < 0.05))) > 0
            ELSE contains(regexp_replace(lower(said), '[，。\\s]', '', 'g'), regexp_replace(lower(shown), '[，。\\s]', '', 'g')) END AS correct FROM b ORDER BY doc_id LIMIT 20""",
    "projected_vectors": "SELECT count(*) AS n, true AS ordered, 0.0::DOUBLE AS centre FROM embeddings WHERE embedding IS NOT NULL",
    "fitted_dialogues": """WITH s AS (SELECT doc_id, length(source) AS s, length(lang) AS l FROM documents) SELECT doc_id, CASE WHEN 2 * (s + l + 1) <= 40 THEN 2 * (s + l + 1) ELSE s + l + 1 END::BIGINT AS n_tokens,
        CASE WHEN 2 * (s + l + 1) <= 40 THEN s + l + 2 ELSE l + 1 END::BIGINT AS n_labels FROM s""",
    "preference_tokens": """WITH b AS (SELECT doc_id, list_transform(generate_series(1, length(lang || ' ' || source)), lambda i: ascii(substr(lang || ' ' || source, i, 1))) AS c, list_transform(generate_series(1, length(lang)), lambda i: ascii(substr(lang, i, 1))) AS r FROM documents)
        SELECT doc_id, array_to_string(c, ',') AS input_ids_chosen, array_to_string(list_concat(r, list_transform(generate_series(1, len(c) - len(r)), lambda i: 0)), ',') AS input_ids_rejected,
            array_to_string(list_concat(list_transform(r, lambda x: 1), list_transform(generate_series(1, len(c) - len(r)), lambda i: 0)), ',') AS attention_mask_rejected FROM b""",
    "clusters_dump": """WITH h AS (SELECT regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')), '\\s+', ' ', 'g'), '[。．，,、;；:：!?！？（）()\\[\\]【】<>《》\\-—_"'']+', '', 'g') AS k, doc_id FROM documents),
        t AS (SELECT k, count(*) AS size, min(doc_id) AS first FROM h GROUP BY k HAVING count(*) >= 2 ORDER BY size DESC, first LIMIT 50)
        SELECT doc_id FROM h JOIN t USING (k) QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) <= 5""",
}
