"""The corpus pipeline: from documents to packed sequences.

Each stage takes all rows its predecessor kept and applies one operator of ``tideline.llm``. Rows may be repeated and
hold nulls; what each operator does with them is in its module's docstring. An empty table passes every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import lines, packing, pii, quality, simhash
from tideline.llm.common import free
from tideline.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject; it learns from the labels of the documents given."""
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = free("__score", docs.columns)
    return quality.score(docs, net, score_col=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without line runs that stand earlier in the corpus."""
    return _counted(lines.deduplicate(docs))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, fingerprints 4 bits apart or less."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _counted(pii.redact(docs, pii.train(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 4096 tokens."""
    return packing.pack(packing.tokenize(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("line_dedup", new_lines),
    ("simhash_dedup", distinct_documents),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Training, fingerprints and tokenization are beyond SQL; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
