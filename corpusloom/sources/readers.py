"""Readers of JSON lines, JSON, CSV, Parquet and text, with a declared schema and a stated policy for bad rows.

All readers go through Spark's own sources, so any file system that Spark
reaches will do, and give each row a ``row_id``: file and position, because
Spark itself keeps no order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from corpusloom.functions import text as T
from corpusloom.functions.schema import SUPERSET, either, field
from corpusloom.operators.convert import contamination_text, corpus_text
from corpusloom.operators.sampling import head_split

_BAD = "_corrupt_record"


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))


def _lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Non-blank lines as ``raw`` with ``row_id`` and ``source_path``."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    own = reader.text(_paths(paths)).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    place = F.concat_ws(":", "source_path", F.lpad(F.col("_start").cast("string"), 15, "0"), F.lpad(F.col("_at").cast("string"), 20, "0"))
    return own.filter(T.strip(F.col("raw")) != "").select("raw", "source_path", place.alias("row_id"))


def jsonl(spark: SparkSession, paths: str | Sequence[str], schema: t.StructType = SUPERSET, bad: str = "drop", keep_raw: bool = False, glob: str | None = None) -> DataFrame:
    """JSON lines, gzipped or not. ``bad`` rows are dropped, kept as ``_corrupt_record`` (``keep``) or raise (``fail``)."""
    own = _lines(spark, paths, glob)
    wide = t.StructType([*schema.fields, t.StructField(_BAD, t.StringType())])
    mode = {"mode": "FAILFAST"} if bad == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = own.withColumn("_r", F.from_json("raw", schema if bad == "fail" else wide, mode))
    if bad == "drop":
        parsed = parsed.filter(f"_r.{_BAD} IS NULL AND _r IS NOT NULL")
    names = [f.name for f in schema.fields] + ([_BAD] if bad == "keep" else [])
    return parsed.select("row_id", "source_path", *(["raw"] if keep_raw else []), *[F.col(f"_r.`{n}`").alias(n) for n in names])


def bad_rows(df: DataFrame) -> DataFrame:
    """Good and bad rows of a frame read with ``bad="keep"``."""
    return df.agg(F.count_if(F.col(_BAD).isNull()).alias("good"), F.count_if(F.col(_BAD).isNotNull()).alias("bad"))


def json_documents(spark: SparkSession, paths: str | Sequence[str], schema: t.StructType = SUPERSET) -> DataFrame:
    """JSON files: an array of records, an object with them in ``data``, one record, or JSON lines under a .json name."""
    whole = spark.read.option("recursiveFileLookup", "true").option("wholetext", "true").text(_paths(paths)).select(F.col("value").alias("_w"), F.col("_metadata.file_path").alias("source_path"))
    listed, boxed = t.ArrayType(schema), t.StructType([t.StructField("data", t.ArrayType(schema))])
    trimmed = T.strip(F.col("_w"))
    lines = F.transform(F.filter(F.split("_w", "\n"), lambda s: T.strip(s) != ""), lambda s: F.from_json(s, schema))
    is_list, has_data = F.startswith(trimmed, F.lit("[")), F.get_json_object("_w", "$.data").isNotNull()
    records = F.when(is_list, F.from_json("_w", listed)).when(has_data, F.from_json("_w", boxed)["data"]).when(F.json_object_keys("_w").isNotNull(), F.array(F.from_json("_w", schema))).otherwise(lines)
    rows = whole.select("source_path", F.posexplode(records).alias("_at", "_r")).filter("_r IS NOT NULL")
    return rows.select(F.concat_ws(":", "source_path", F.lpad(F.col("_at").cast("string"), 12, "0")).alias("row_id"), "source_path", *[F.col(f"_r.`{f.name}`").alias(f.name) for f in schema.fields])


def kind_of(path: str) -> str:
    name = path.lower().removesuffix(".gz")
    for kind in ("jsonl", "json", "parquet", "csv", "txt"):
        if name.endswith("." + kind):
            return kind
    raise ValueError(f"no reader for {path}")


def records(spark: SparkSession, paths: str | Sequence[str], schema: t.StructType = SUPERSET, bad: str = "drop") -> DataFrame:
    """The union of files of any kind, by extension; columns a file lacks are null."""
    out = None
    for path in _paths(paths):
        kind = kind_of(path)
        if kind == "jsonl":
            own = jsonl(spark, path, schema, bad)
        elif kind == "json":
            own = json_documents(spark, path, schema)
        elif kind == "parquet":
            own = spark.read.parquet(path).withColumn("row_id", F.concat_ws(":", F.col("_metadata.file_path"), F.lpad(F.col("_metadata.row_index").cast("string"), 15, "0")))
        elif kind == "csv":
            own = csv(spark, path)
        else:
            own = _lines(spark, path).select("row_id", "source_path", F.col("raw").alias("text"))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no input path")
    return out


def csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV with a header; all columns are text."""
    own = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(_paths(paths))
    return own.withColumn("row_id", F.concat_ws(":", F.col("_metadata.file_path"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")))


def files_under(spark: SparkSession, root: str, *kinds: str) -> list[str]:
    """Sorted distinct files of these kinds under a folder, or the file itself; raises when there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root)
    store = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(top).isFile():
        return [root]
    found, walk = set(), store.listFiles(top, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if any(name.lower().removesuffix(".gz").endswith("." + k) for k in kinds):
            found.add(name)
    if not found:
        raise FileNotFoundError(f"no {'/'.join(kinds)} file under {root}")
    return sorted(found)


def evaluation_texts(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """What evaluation sets ask (source, row_id, text), of JSON lines, JSON and CSV; a source without rows raises."""
    out = None
    for root in roots:
        own = records(spark, files_under(spark, root, "jsonl", "json", "csv"))
        if "Question" in own.columns:
            own = own.withColumnRenamed("Question", "question") if "question" not in own.columns else own.withColumn("question", F.coalesce("question", "Question"))
        own = own.select(F.lit(root).alias("source"), "row_id", contamination_text(own).alias("text")).filter("text <> ''")
        if own.isEmpty():
            raise ValueError(f"the evaluation source {root} has no rows")
        out = own if out is None else out.unionByName(own)
    return out


def training_lines(spark: SparkSession, paths: str | Sequence[str], schema: t.StructType = SUPERSET) -> DataFrame:
    """Training rows line by line, whatever the extension, with the raw line for byte-true output; malformed lines go."""
    return jsonl(spark, paths, schema, "drop", keep_raw=True)


def corpus(spark: SparkSession, paths: str | Sequence[str], text: str = "text", least: int = 100, most: int = 1500) -> DataFrame:
    """Paragraphs (row_id, number, paragraph) of text, JSON-lines and gzipped corpora."""
    out = None
    for path in _paths(paths):
        if kind_of(path) == "txt":
            own = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_path").alias("row_id"), F.col("value").alias("_text"))
        else:
            extra = t.StructType([*SUPERSET.fields, *([] if text in SUPERSET.names else [t.StructField(text, t.StringType())])])
            rows = jsonl(spark, path, extra)
            own = rows.select("row_id", corpus_text(rows, text).alias("_text"))
        out = own if out is None else out.unionByName(own)
    return out.select("row_id", F.posexplode(T.paragraphs(F.col("_text"), least, most)).alias("number", "paragraph"))


def exercises(spark: SparkSession, paths: str | Sequence[str], first: int | None = None, complete: bool = True) -> DataFrame:
    """Rows with a prompt and a ground truth, the first ``first`` by position."""
    own = records(spark, paths)
    own = own.filter("prompt IS NOT NULL AND ground_truth IS NOT NULL") if complete else own
    own = own.orderBy("row_id")
    return own if first is None else own.limit(first)


def limited(spark: SparkSession, paths: str | Sequence[str], most: int | None = None) -> DataFrame:
    """The first ``most`` records by position; raises where there is none."""
    own = records(spark, paths).orderBy("row_id")
    return require_rows(own if most is None else own.limit(most), str(paths))


def train_and_validation(spark: SparkSession, train: str | Sequence[str], valid: str | Sequence[str] | None = None, percent: float = 10, order: str = "row_id") -> DataFrame:
    """Records with ``split``: named validation files, or the first ``percent`` of the training rows by ``order`` where none are named."""
    own = records(spark, train)
    if valid is None:
        return head_split(own, percent, order)
    label = lambda df, name: df.withColumn("split", F.lit(name))
    return label(own, "train").unionByName(label(records(spark, valid), "valid"), allowMissingColumns=True)


def first_questions(spark: SparkSession, paths: str | Sequence[str], most: int | None = None) -> DataFrame:
    """First human texts of conversations; ``most`` counts lines before any is dropped."""
    own = _lines(spark, paths).orderBy("row_id")
    own = own if most is None else own.limit(most)
    talk = F.from_json("raw", t.StructType([SUPERSET["conversations"]]))["conversations"]
    asked = F.get(F.filter(talk, lambda m: m["from"] == "human"), F.lit(0))["value"]
    return own.select("row_id", asked.alias("text")).filter("text <> ''")


def subjects(spark: SparkSession, folder: str) -> DataFrame:
    """Choice questions of one CSV per subject; the subject is the file's stem."""
    own = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(folder)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.csv$", 1)
    return own.withColumn("subject", F.url_decode(stem)).withColumn("position", F.monotonically_increasing_id())


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def conversations_table(turns: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Exploded turns as one row per conversation, with roles named human, gpt and system."""
    named = F.when(F.col(role) == "user", "human").when(F.col(role) == "assistant", "gpt").otherwise(F.col(role))
    turn = F.struct(F.col(order).alias("_at"), named.alias("from"), F.col(text).alias("value"))
    talk = F.transform(F.array_sort(F.collect_list(turn)), lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value")))
    return turns.groupBy(conv).agg(talk.alias("conversations"))


def question_text(df: DataFrame) -> Column:
    return either(field(df, "question"), field(df, "prompt"))
