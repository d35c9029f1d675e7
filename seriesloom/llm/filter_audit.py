"""How filters interact: steps of every order and Shapley values from a removal game.

A coalition of filters removes the documents that fail at least one of them, v(S). The
Hart-Mas-Colell potential of that game is

    P(empty) = 0,    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it). With n filters, n! P(S) is a whole
number for every S, so all arithmetic is exact: n! times the Shapley value is the filter's removals
summed over all n! orders. A step of an order that applies filter i after the filters S removes
v(S with i) - v(S) documents; the other columns are differences of coalitions as well.

Documents reach the game only as counts: one row per (part, set of failed filters), at most 2^n
rows a part, summed on the map side. Which documents repeat an earlier text is decided by the
SHA-256 of the text and the least id that holds it; groups of copies shrink to one row per task
before they are shuffled.

Defined cases: a null text is empty; a null source is the part ''; a document without an id
counts, but is never earlier or later than another, and has no labels; repeated rows count each, and
do not repeat each other; with several labels of an id, one of the value counts; an empty table has no
parts and gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import map_arrow, small_batches, table, text_bytes, written
from seriesloom.llm.registry import query

#: Fixed values of the five filters.
FILTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"

CONTINUATION = bytes(range(0x80, 0xC0))
REPEAT_BIT = 1 << FILTERS.index("E")


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails by itself."""
    words = text.split()
    few = len(words) < LEAST_WORDS
    dull = 100 * len(set(words)) < DISTINCT_PERCENT * len(words)
    points = len(text.translate(None, CONTINUATION))
    loud = 100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * points
    odd = len(text.translate(None, SYMBOLS)) < len(text)
    return few | dull << 1 | loud << 2 | odd << 3


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, failed (bits of A to D), a row per document."""
    part = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"),
                       F.col("text").cast("string").alias("text"))

    def measure(batches):
        for batch in small_batches(batches):
            texts = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"),
                 pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()),
                 pa.array([own_failures(text) for text in texts], pa.int32())], ["doc_id", "part", "digest", "failed"])

    return map_arrow(rows, measure, "doc_id long, part string, digest binary, failed int")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits of all five filters), n, good, toxic."""
    rows = (written(measured(docs), "measured").groupBy("digest", "doc_id", "part", "failed")
            .agg(F.count("*").alias("n")))
    rows = written(rows, "rows")
    first = (rows.filter(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"),
                           (F.col("toxic") == 1).alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & (F.col("good") | F.col("toxic"))).groupBy("doc_id")
             .agg(F.max(F.coalesce("good", F.lit(False))).alias("good"),
                  F.max(F.coalesce("toxic", F.lit(False))).alias("toxic")))
    repeat = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), F.lit(REPEAT_BIT)).otherwise(F.lit(0))
    both = rows.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    return both.groupBy("part", F.col("failed").bitwiseOR(repeat).alias("failed")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def removals(counts: DataFrame, measures: list[str], n_filters: int) -> DataFrame:
    """part, total, and for each measure an array: what each coalition of filters removes."""
    def game(measure: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("failed").bitwiseAND(F.lit(coalition)) != 0, F.col(measure)).otherwise(0))
                         for coalition in range(1 << n_filters)])

    return counts.groupBy("part").agg(F.sum("n").alias("total"), *[game(measure).alias(measure) for measure in measures])


def potentials(game: Column, n_filters: int) -> Column:
    """n! times the potential of every coalition, smaller coalitions first."""
    bits = [1 << k for k in range(n_filters)]

    def extend(known: Column, coalition: Column) -> Column:
        smaller = sum((F.when(coalition.bitwiseAND(F.lit(bit)) != 0, F.get(known, coalition.bitwiseXOR(F.lit(bit)))).otherwise(0)
                       for bit in bits), F.lit(0).cast("long"))
        value = F.lit(math.factorial(n_filters)).cast("long") * F.get(game, coalition) + smaller
        return F.concat(known, F.array(F.call_function("div", value, F.bit_count(coalition))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n_filters) - 1)), F.array(F.lit(0).cast("long")), extend)


def interaction_audit(counts: DataFrame, filters: str = FILTERS, measures: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """One row per part, order of the filters and step.

    ``counts`` holds part, failed (bit k for the k-th filter), n and a column per measure, any number of
    rows a part. kept, removed, redundant, unique_fails, shapley (times n!) and <measure>_lost.
    """
    n_filters, everything = len(filters), (1 << len(filters)) - 1
    games = removals(counts, ["n", *measures], n_filters).withColumn("potential", potentials(F.col("n"), n_filters))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(filters)])
    steps = (games.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_filters)))))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    own = sum((F.when(letter == name, F.lit(1 << k)).otherwise(0) for k, name in enumerate(filters)), F.lit(0))
    before = sum((F.when(F.instr(F.col("filter_order"), F.lit(name)) < F.col("step"), F.lit(1 << k)).otherwise(0)
                  for k, name in enumerate(filters)), F.lit(0))
    steps = steps.withColumn("own", own).withColumn("before", before).withColumn("after", F.col("before").bitwiseOR(F.col("own")))

    def gained(measure: str) -> Column:
        return F.get(measure, F.col("after")) - F.get(measure, F.col("before"))

    others = F.lit(everything).bitwiseXOR(F.col("own"))
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", F.col("after"))).alias("kept"), gained("n").alias("removed"),
        (F.get("n", F.col("own")) - gained("n")).alias("redundant"),
        (F.get("n", F.lit(everything)) - F.get("n", others)).alias("unique_fails"),
        *[gained(measure).alias(f"{measure}_lost") for measure in measures],
        (F.get("potential", F.lit(everything)) - F.get("potential", others)).alias("shapley"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM d),
kinds AS (SELECT part, a, b, c, d, e, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
met AS (
  SELECT *, list_filter([CASE WHEN a THEN instr(o, 'A') END, CASE WHEN b THEN instr(o, 'B') END, CASE WHEN c THEN instr(o, 'C') END,
         CASE WHEN d THEN instr(o, 'D') END, CASE WHEN e THEN instr(o, 'E') END], lambda x: x IS NOT NULL) AS places
  FROM kinds, orders),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
rows AS (
  SELECT part, o, step, substr(o, step, 1) AS letter,
         coalesce(sum(n) FILTER (WHERE len(places) = 0 OR list_min(places) > step), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE list_min(places) = step), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE list_contains(places, step) AND list_min(places) < step), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE places = [step]), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE list_min(places) = step AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE list_min(places) = step AND toxic), 0) AS toxic_lost
  FROM met, steps GROUP BY ALL)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM rows
"""


@query("op12_filter_interaction_audit", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction_audit(failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
