"""The text pipeline: toxicity, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in the
shared folder and reads it again as the next stage's docs. All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesloom.llm import decontamination, near_dedup, packing, suffix_dedup, toxicity
from seriesloom.llm.common import table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns on the given documents and their labels; rejects what scores at least the threshold."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the least id stays."""
    return near_dedup.keep_one_of_each(docs, words=5, percent=80)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 bytes or more that a document with a smaller id holds; no row is dropped."""
    return suffix_dedup.shortened(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of benchmark words go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, with the sequence and offset of each."""
    return packing.packing_report(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_near_copy),
    ("repeated_passages", remove_repeated_passages),
    ("decontamination", reject_contaminated),
    ("packing", pack),
]

#: Learned decisions and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
