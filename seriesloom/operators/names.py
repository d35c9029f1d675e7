"""Term index for matching contract names: markets come as a table, however many there are.

Names repeat week after week, so each distinct name is cut once into its pieces of one to ``GRAM`` characters.
A term meets the names that hold its first piece by an equi-join and is confirmed on the whole name;
what a market wants, needs and bars is counted per (name, market). The plan does not grow with the markets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.positioning import _keep_if_any

GRAM = 4


def name_pieces(names: DataFrame) -> DataFrame:
    """``name, piece``: the distinct pieces of each name."""
    def cut(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("name") - (size - 1))
        return F.when(F.length("name") >= size, F.transform(starts, lambda at: F.substring(F.col("name"), at, F.lit(size)))).otherwise(
            F.array().cast("array<string>"))

    pieces = F.array_distinct(F.concat(*[cut(size) for size in range(1, GRAM + 1)]))
    return names.select("name", F.explode(pieces).alias("piece"))


def market_terms(markets: DataFrame) -> DataFrame:
    """``market, kind, term, n_terms`` of the markets without a code: what is wanted, required and barred."""
    searched = markets.filter(F.col("code").isNull())
    kinds = F.array(
        F.struct(F.lit("wanted").alias("kind"), F.array(F.coalesce("query_name", "market")).alias("terms")),
        F.struct(F.lit("required").alias("kind"), F.coalesce("must_contain", F.array()).alias("terms")),
        F.struct(F.lit("barred").alias("kind"), F.coalesce("must_not_contain", F.array()).alias("terms")))
    rows = searched.select("market", F.inline(kinds)).withColumn("terms", F.array_distinct(F.transform("terms", F.upper)))
    return rows.select("market", "kind", F.explode("terms").alias("term"), F.size("terms").alias("n_terms")).filter(F.col("term") != "")


def name_matches(names: DataFrame, markets: DataFrame) -> DataFrame:
    """``name, market, required, barred`` for every name a market wants: all required terms there, any barred one."""
    terms = market_terms(markets)
    sought = terms.select("term").distinct().withColumn("piece", F.substring("term", 1, GRAM))
    hits = (name_pieces(names).join(sought, "piece").filter(F.contains("name", "term")).select("name", "term")
            .join(terms, "term"))
    counted = hits.groupBy("name", "market").agg(
        F.count_if(F.col("kind") == "wanted").alias("wanted"), F.count_if(F.col("kind") == "required").alias("n_required"),
        F.count_if(F.col("kind") == "barred").alias("n_barred")).filter(F.col("wanted") > 0)
    needed = terms.filter("kind = 'required'").select("market", "n_terms").distinct()
    return counted.join(needed, "market", "left").select(
        "name", "market", (F.col("n_required") == F.coalesce("n_terms", F.lit(0))).alias("required"),
        (F.col("n_barred") > 0).alias("barred"))


def assign_market_table(reports: DataFrame, markets: DataFrame) -> DataFrame:
    """Report rows of every market of a table, pinned and searched, with their rules applied.

    ``markets``: market, code, query_name, must_contain, must_not_contain. A market with a code takes its
    rows by the code alone. Others take names that hold their query name; required terms keep all rows
    where none has them; barred ones drop rows without such a fallback.
    """
    named = reports.drop("market").withColumn("name", F.upper("contract_name"))
    matches = name_matches(named.select("name").distinct(), markets)
    searched = named.join(matches, "name")
    kept = _keep_if_any(searched, F.col("required")).filter(~F.col("barred")).drop("name", "required", "barred")
    pinned = markets.filter(F.col("code").isNotNull()).select("market", F.col("code").alias("contract_code"))
    return kept.unionByName(reports.drop("market").join(pinned, "contract_code"))
