"""Quality rules whose cutoffs limit false rejection, by DataFrame functions only.

Fixed base rules come first (too few words, too many repeated words). Further rules compare a
measure of the text with a cutoff that is selected per stratum (language). The rules' grids form one walk from
loose to strict, taking a cutoff of each rule in turn; step t stands for all cutoffs up to there, and a
document's first step is the one that would reject it. Labelled good documents that pass the base rules are
the holdout. An exact binomial test asks at each step whether the rules together reject more than ``RISK`` of
them, and the walk ends before the first step that fails. Steps are tested in an order fixed beforehand
and only until one fails, so they need no correction among themselves (fixed-sequence testing);
``DELTA`` is divided by the number of strata (Bonferroni). So with probability 1 - DELTA no stratum
loses more than RISK of its good documents to the rules. A stratum with too few labels takes
no step, and its documents meet the base rules alone.

All measures come from one pass over whole texts inside the JVM. Words in repeated windows are found
per text: windows are hashed to 64 bits, and only texts with fewer distinct hashes than windows sort them.
Labelled rows are reduced to counts per step with a partial aggregate; the selected steps
(one row per stratum) are joined back, whatever their number. Windows of words are compared by
64-bit hashes: two different windows of one text would be taken for equal with a chance below 2^-40 for a million words.

Defined cases: null text has no words and fails the base rules; a null language is a
stratum of its own; labels without quality are ignored, several labels of one id count as good only if
all are; repeated rows give a row each and count as often in the holdout; empty labels select no cutoff.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import table, written
from seriesloom.llm.registry import query

RISK = 0.02
DELTA = 0.05
SPACES = "[\\x20\\x09-\\x0D]+"
RUN = 5

#: Rules: measure and its cutoffs from loose to strict; a rule rejects what lies above its cutoff.
RULES: dict[str, list[float]] = {
    "symbols": [1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02],
    "repeats": [0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04, 0.02],
    "dup_lines": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05, 0.02],
    "long_words": [30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0, 6.0],
}
#: The walk: (rule, cutoff) of every step, a cutoff of each rule in turn.
WALK = [(rule, cutoffs[level]) for level in range(max(map(len, RULES.values())))
        for rule, cutoffs in RULES.items() if level < len(cutoffs)]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside RUN-word windows that occur twice or more in the list."""
    def of_windows(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            twice = F.filter(ordered, lambda x, k: (
                F.when(k > 0, F.get(ordered, k - 1)["h"] == x["h"]).otherwise(False)
                | F.when(k < last, F.get(ordered, k + 1)["h"] == x["h"]).otherwise(False)))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        covered = F.aggregate(
            let(pairs, starts), F.struct(F.lit(-RUN).alias("before"), F.lit(0).cast("long").alias("total")),
            lambda done, at: F.struct(at.alias("before"), (done["total"] + F.least(F.lit(RUN), at - done["before"])
                                                           ).alias("total")), lambda done: done["total"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - RUN),
                          lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(RUN)]))
    return F.when(F.size(words) > RUN, let(windows, of_windows)).otherwise(F.lit(0).cast("long"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and the base measures of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    words = F.filter(F.split(text, SPACES), lambda word: word != "")
    of_words = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda rows: F.struct(
        F.size(rows).cast("long").alias("n_lines"),
        (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines")))
    stratum = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), stratum.alias("stratum"), of_words.alias("w"), of_lines.alias("l"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    ).select("doc_id", "stratum", "w.*", "l.*", "n_symbols")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measure(rule: str) -> Column:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {"symbols": F.col("n_symbols") / words, "repeats": F.col("n_repeat_words") / words,
            "dup_lines": F.col("n_dup_lines") / lines, "long_words": F.col("word_chars") / words}[rule]


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    small = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(20)), F.lit(1)).cast("int")), F.lit(0.0),
                        lambda total, i: total + F.log(i.cast("double")))
    y = F.greatest(x, F.lit(1.0))
    large = y * F.log(y) - y + 0.5 * F.log(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return F.when(n <= 20, small).otherwise(large)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed from k downwards; 1 where k > n p.

    Terms farther than 20 sqrt(n) + 50 below k add nothing a double could show.
    """
    top = (log_factorial(n) - log_factorial(k) - log_factorial(n - k)
           + k * math.log(p) + (n - k) * math.log1p(-p))
    steps = F.least(k, F.ceil(20 * F.sqrt(n) + 50)).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(done: Column, j: Column) -> Column:
        at = k - j + 1  # the ratio leads from at to at - 1 successes
        term = done["term"] * at / (n - at + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (done["total"] + term).alias("total"))

    below = F.when(k > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, add,
                                      lambda done: done["total"])).otherwise(F.lit(1.0))
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.exp(top) * below)


def first_step() -> Column:
    """Number of the first step of the walk that rejects a document; len(WALK) if none does."""
    def of(rule: str) -> Column:
        steps = [(step, cutoff) for step, (name, cutoff) in enumerate(WALK) if name == rule]
        value = measure(rule)
        found = F.lit(len(WALK))
        for step, cutoff in reversed(steps):
            found = F.when(value > cutoff, F.lit(step)).otherwise(found)
        return found

    return F.least(*[of(rule) for rule in RULES])


def selected_steps(measures: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, last_step (the strictest admissible one), n_good, n_rejected, p_value."""
    good = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
            .filter(F.col("_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("_id").agg(F.min("quality").alias("quality")).filter(F.col("quality") == 1).select("_id"))
    holdout = measures.join(good, F.col("doc_id") == F.col("_id"), "left_semi").filter(~base_failed())
    counts = written(holdout.groupBy("stratum", "first_step").agg(F.count("*").alias("n")), "holdout")
    allowed = delta / max(counts.select("stratum").distinct().count(), 1)
    hits = F.sum(F.when(F.col("first_step") <= F.col("step"), F.col("n")).otherwise(0))
    tests = (counts.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(WALK) - 1))))  # len(WALK) counts a stratum
             .groupBy("stratum", "step").agg(F.sum("n").alias("n_good"), hits.alias("n_rejected")))
    tested = tests.withColumn("p_value", binomial_tail(F.col("n_rejected"), F.col("n_good"), risk))
    # Rejections only grow along the walk, so the steps that pass come before the first that fails.
    return tested.filter(F.col("p_value") <= allowed).groupBy("stratum").agg(
        F.max(F.struct("step", "n_good", "n_rejected", "p_value")).alias("best")).select(
        "stratum", F.col("best.step").alias("last_step"), "best.n_good", "best.n_rejected", "best.p_value")


def judged(measures: DataFrame, steps: DataFrame) -> DataFrame:
    """The measures with base_failed and kept."""
    both = measures.join(steps.select(F.col("stratum").alias("_stratum"), "last_step"), F.col("stratum") == F.col("_stratum"), "left")
    hit = F.coalesce(F.col("first_step") <= F.col("last_step"), F.lit(False))
    return both.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & ~hit)


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    measures = written(measured(docs).withColumn("first_step", first_step()), "measures")
    steps = written(selected_steps(measures, labels, risk, delta), "steps")
    return judged(measures, steps).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql(risk: float = RISK) -> str:
    ratio = {"symbols": "n_symbols / greatest(n_words, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)",
             "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "long_words": "word_chars / greatest(n_words, 1)"}
    walk = ", ".join(f"({step}, '{rule}', CAST({cutoff} AS DOUBLE))" for step, (rule, cutoff) in enumerate(WALK))
    value = "CASE rule " + " ".join(f"WHEN '{rule}' THEN CAST({expr} AS DOUBLE)" for rule, expr in ratio.items()) + " END"
    p = risk
    return f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)),
often AS (SELECT r, s FROM windows GROUP BY r, s HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows JOIN often USING (r, s)) GROUP BY r),
m AS (
  SELECT doc_id, r, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN covered c USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
holdout AS (SELECT * FROM judged WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
walk(step, rule, cutoff) AS (VALUES {walk}),
rejected AS (SELECT r, min(step) AS first_step FROM judged, walk WHERE {value} > cutoff GROUP BY r),
tests AS (
  SELECT stratum, step, count(*) AS n, count(*) FILTER (WHERE first_step <= step) AS k
  FROM holdout LEFT JOIN rejected USING (r), (SELECT step FROM walk) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k > n * {p!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) END AS p_value
  FROM tests),
best AS (
  SELECT stratum, max(step) AS last_step FROM tested t
  WHERE NOT EXISTS (SELECT 1 FROM tested f WHERE f.stratum = t.stratum AND f.step <= t.step
    AND f.p_value > {DELTA} / (SELECT count(DISTINCT stratum) FROM holdout)) GROUP BY 1),
hits AS (SELECT r FROM judged JOIN rejected USING (r) JOIN best USING (stratum) WHERE first_step <= last_step)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM hits) AS kept FROM judged
"""


@query("op7_quality_rules", _sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("quality_rules_tenth_risk", _sql(0.1))
def tenth_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules where a tenth of the good documents may go: cutoffs are selected on few labels too."""
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.1)
