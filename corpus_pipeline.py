"""From raw documents to packed training sequences, a table after each stage.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardweave.llm.decontaminate import decontaminate
from cardweave.llm.lines import dedup_lines
from cardweave.llm.minhash import near_duplicates
from cardweave.llm.packing import pack_documents
from cardweave.llm.quality import judge_quality
from cardweave.storage import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return judge_quality(whole, labels).where("predicted = 1").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has, n_chars as it then is."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, and all without a word or a doc_id.

    By the sets of the operator's own query, two words: one changed word takes two of them and not
    five, so far more near copies are alike in four fifths of theirs.
    """
    judged = near_duplicates(docs, words=2)
    return docs.join(judged.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and where they lie."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near", near),
    ("benchmark", benchmark),
    ("packing", packing),
]

#: No stage but the second can be said in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table after each stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
