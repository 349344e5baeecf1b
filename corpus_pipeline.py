"""A training-data pipeline over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  All but the last keep the
columns of documents, whatever further ones there are.

Cases: null and empty texts are rejected by the first stage; the later ones take
them as empty texts.  Null ids are ids, the smallest ones.  Of repeated rows the
second stage leaves one.  Ties go to the largest id in the second and to the
least in the third stage.  Very long texts are read whole and cut only into
pieces of bins by the last.  Every stage gives an empty result for an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact, mixing, near, packing, quality
from corpusloom.llm.store import Scratch
from corpusloom.session import ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    ship(spark)
    return quality.good_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    ship(spark)
    return exact.without_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    ship(spark)
    return near.without_near_duplicates(docs, shingle=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; small sources are read again until the largest has been read once."""
    ship(spark)
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of the permitted lengths."""
    ship(spark)
    return packing.packed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# EM, the trained scorer and best-fit packing have no SQL form; tests/llm checks run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
