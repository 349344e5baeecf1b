"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import covertree, exact, licences, mixing, near, oracles, packing, pii, quality, urls, warc
from corpusloom.llm.store import Scratch
from corpusloom.session import shipped

ORACLE_SQL = oracles.ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(_table(spark, sf_dir, "documents"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.search_every(_table(spark, sf_dir, "embeddings"), 50)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "archives")
    index = scratch.table(warc.write_archives(_table(spark, sf_dir, "pages"), scratch.at("warc")), "index")
    return warc.read_records(index, scratch.at("warc")).drop("url")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents")).drop("matches")


QUERIES = {f.__name__: shipped(f) for f in (op1_near_duplicates, op2_packing, op3_mixing, op4_urls, op5_exact_duplicates, op6_personal_data, op7_top_k, op8_warc, op9_quality, op10_licences)}
