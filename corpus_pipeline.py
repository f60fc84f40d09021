"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before it kept, and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last return the
columns of documents:

1. toxicity: documents that the class-conditional letter models reject go;
2. near duplicates: one document of each group of similarity 0.75 stays;
3. substring dedup: words in passages of 35 words or more that occur elsewhere are cut from the texts;
4. decontamination: documents that hold a passage of a benchmark item go;
5. packing: a row per piece of a document, with its sequence of at most 1024 tokens and its offset there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe.llm import decontaminate, minhash_forest, packing, substring_dedup, toxicity
from contractframe.llm.catalog import vocabulary
from contractframe.llm.common import materialize, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.keep_one(docs, 75)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_documents(docs, 35).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"), 10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary(), 1024)


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("substring dedup", without_repeated_passages),
    ("decontamination", without_benchmark_passages),
    ("packing", packed),
]

#: Token ids and trained models have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
