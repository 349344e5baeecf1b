"""Writers of JSON lines, raw lines, routed outputs and reports."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, order: str | None = None) -> None:
    """JSON lines in UTF-8, characters literal, null fields left out."""
    own = df.sortWithinPartitions(order).drop(order) if order else df
    own.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def raw_lines(df: DataFrame, path: str, raw: str = "raw", order: str | None = None) -> None:
    """The lines as they were read."""
    own = df.orderBy(order) if order else df
    own.select(F.col(raw).alias("value")).write.mode("overwrite").text(path)


def routed(df: DataFrame, route: Column, paths: Mapping[str, str], raw: str = "raw") -> None:
    """One output per route. The flagged frame is kept while its outputs are written, so it is computed once."""
    own = df.withColumn("_route", route).persist()
    try:
        for name, path in paths.items():
            raw_lines(own.filter(F.col("_route") == name), path, raw)
    finally:
        own.unpersist()


def conversations(df: DataFrame, path: str) -> None:
    """Only the conversations; scores and other fields stay behind."""
    jsonl(df.select("conversations"), path)


def report(df: DataFrame, path: str) -> None:
    """A one-row frame as one JSON file."""
    df.limit(1).select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def clusters_text(df: DataFrame, path: str, key: str, order: str, instruction: str, extra: str, output: str, cut: int = 800) -> None:
    """Examples of the largest clusters with their bodies cut, as text. The frame has a bounded number of rows."""
    body = F.concat(F.substring(output, 1, cut), F.when(F.length(output) > cut, "\n...<truncated>...").otherwise(""))
    head = F.when(F.col("member") == 1, F.concat(F.lit("\n" + "=" * 90 + "\nQ_HASH="), F.col(key), F.lit("  count="), F.col("size").cast("string"), F.lit("\n"))).otherwise("")
    middle = F.when(F.col(extra) != "", F.concat(F.lit("\n\n[INPUT]\n"), F.col(extra))).otherwise("")
    text = F.concat(head, F.lit("\n--- example "), F.col("member").cast("string"), F.lit(" (idx="), F.col(order).cast("string"), F.lit(") ---\n[INSTRUCTION]\n"), F.col(instruction), middle, F.lit("\n\n[OUTPUT]\n"), body)
    df.orderBy(F.desc("size"), "first", "member").coalesce(1).select(text.alias("value")).write.mode("overwrite").text(path)


def clusters_markdown(sizes: DataFrame, labels: DataFrame, examples: DataFrame, balance: DataFrame, cluster: str = "cluster", shown: int = 3) -> str:
    """A summary of clusters: balance, then each cluster with its label and first representatives. All inputs are one row per cluster or fewer than ten."""
    figures = balance.first().asDict()
    lines = ["# Clusters", "", *[f"- {k}: {v}" for k, v in figures.items()], ""]
    texts: dict = {}
    for r in examples.filter(F.col("rank") <= shown).orderBy(cluster, "rank").collect():
        texts.setdefault(r[cluster], []).append(r["text"])
    named = {r[cluster]: r["label"] for r in labels.collect()}
    for r in sizes.orderBy(F.desc("size"), cluster).collect():
        lines += [f"## {r[cluster]}: {named.get(r[cluster], '')}", "", f"{r['size']} rows, {r['percentage']:.1f} %", "", *[f"- {x}" for x in texts.get(r[cluster], [])], ""]
    return "\n".join(lines)


def labels(df: DataFrame, path: str, key: str, cluster: str = "cluster") -> None:
    df.select(key, cluster).write.mode("overwrite").parquet(path)


def flagged(df: DataFrame, folder: str) -> None:
    """All rows, those with high repetition and those with high emptiness."""
    own = df.persist()
    try:
        jsonl(own, f"{folder}/all")
        jsonl(own.filter("high_rep"), f"{folder}/high_rep")
        jsonl(own.filter("high_empty"), f"{folder}/high_empty")
    finally:
        own.unpersist()


def as_json(df: DataFrame) -> dict:
    """A one-row frame as a dictionary."""
    row = df.first()
    return json.loads(json.dumps(row.asDict(recursive=True), default=str)) if row else {}
