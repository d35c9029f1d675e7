"""Token counts from an exact length histogram.

Documents are encoded where they lie; only (length, documents) counts are shuffled, with a
partial aggregate first. All further answers come from the histogram: suffix sums give, for
every context limit, the documents that exceed it, the tokens that remain after truncation,
and the quantile the limit stands for. The suffix sums run in two steps, inside blocks of
1,024 lengths and over the totals of the blocks, so that no task gets a histogram whole.

Defined cases: null text is empty and has length 0; an empty table gives an empty
histogram; equal rows count as often as they appear.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import id_and_text, map_arrow, small_batches, table, written
from seriesloom.llm.registry import query
from seriesloom.llm.tokens import VOCABULARY, encoding

BLOCK = 1024


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens for each row; no end token is counted."""
    def count(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in small_batches(batches):
            lengths = [len(encode(text)) if text else 0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths, pa.int64())],
                                             ["doc_id", "n_tokens"])

    return map_arrow(id_and_text(docs), count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_report(histogram: DataFrame) -> DataFrame:
    """One row per occurring length L, taken as a context limit.

    n_docs, docs_at_most (length <= L), docs_over, tokens_at_most (of documents with length
    <= L), total_tokens, truncated_tokens (sum of min(length, L)), lost_tokens, quantile
    (share of documents with length <= L). Limits between two lengths follow from the next
    smaller one: truncated_tokens + docs_over * (limit - L).
    """
    block = F.floor(F.col("n_tokens") / BLOCK)
    sized = histogram.withColumn("block", block).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    blocks = sized.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    blocks = blocks.select(
        "block", F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("b_docs").over(whole).alias("all_docs"), F.sum("b_tokens").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = (sized.join(blocks, "block")
            .withColumn("docs_over", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("later_docs"))
            .withColumn("tokens_over", F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("later_tokens")))
    return over.select(
        "n_tokens", "n_docs", (F.col("all_docs") - F.col("docs_over")).alias("docs_at_most"), "docs_over",
        (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_at_most"),
        F.col("all_tokens").alias("total_tokens"),
        (F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_tokens"),
        (F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")).alias("lost_tokens"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = length_histogram(token_lengths(table(spark, sf_dir, "documents")))
    return context_report(written(histogram, "lengths"))  # the report reads it twice
