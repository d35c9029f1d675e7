"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature: ``sigma`` spreads the shingle hashes over a circle
of ``CIRCLE`` places, and coordinate k is the least value of ``pi`` over the set's places
shifted by k. Bands of ``rows`` coordinates are the buckets. With 50 bands of 8, a pair at
similarity 0.85 misses all buckets with probability (1 - 0.85^8)^50 < 2e-7.

Equal shingle sets are one class and take part once, whatever the number of copies; a class is told by
128 bits of its set and numbered by its least id, so an id with several texts stands in several classes. In a
bucket, members are compared with one hub, not with each other: the member that meets most
others over all buckets, which in a group of copies is the text they come from. Verified links
join classes to components, and a bucket whose members are in one component is finished. The
members of the others are compared by an exact rule: two of them are a pair if they share
one of their rarest shingles (prefix filter), which loses no link and does not pair up large groups
of unlinked copies. Links are confirmed on whole sets: 100 * intersection >= 85 * union.

Components are found by label propagation with pointer jumping over verified links, each
turn written to the shared folder. Nothing that grows with the data reaches the driver.

Defined cases: null text, empty text and text without words have no shingles, link with
nothing and are kept; a text of fewer than three words is one shingle; repeated rows give one
row; an id that repeats with another text gives a row for each set, and each set has its own
links; an empty table gives none; a row without an id takes part as the least of all ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import id_and_text, map_arrow, small_batches, table, text_bytes, written, written_at
from seriesloom.llm.registry import query
from seriesloom.llm.textops import mix, shingle_set
from seriesloom.session import discard

WORDS = 3
PERCENT = 85
BANDS, ROWS = 50, 8
CIRCLE = 1 << 18
NO_ID = -(1 << 63)

_random = np.random.default_rng(20240301)
SIGMA_SEED = np.uint64(_random.integers(1, 1 << 62))
#: pi, written twice in a row so that a circular shift is a slice.
PI = np.tile(_random.permutation(CIRCLE).astype(np.uint32), 2)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates: coordinate k is min over x of pi[(sigma(x) + k) mod CIRCLE]."""
    shifted = np.lib.stride_tricks.sliding_window_view(PI, size)
    places = np.unique(mix(shingles ^ SIGMA_SEED) % np.uint64(CIRCLE))
    least = np.full(size, CIRCLE, dtype=np.uint32)
    for first in range(0, len(places), 256):
        np.minimum(least, shifted[places[first:first + 256]].min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    table_ = coordinates.reshape(bands, rows).astype(np.uint64)
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + table_[:, k])
    return keys.view(np.int64)


def class_key(found: np.ndarray) -> bytes | None:
    """16 bytes that name a shingle set; None for an empty one."""
    if not len(found):
        return None
    return np.array([mix(found).sum(), mix(found * np.uint64(0xD6E8FEB86659FD93)).sum() ^ np.uint64(len(found))],
                    dtype=np.uint64).tobytes()


def described(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, class_key (16 bytes naming the set; null if empty), buckets."""
    def sign(batches):
        for batch in small_batches(batches):
            sizes, keys, buckets = [], [], []
            for text in text_bytes(batch.column("text")):
                found = shingle_set(text, words)
                sizes.append(len(found))
                keys.append(class_key(found))
                buckets.append(None if not len(found) else
                               band_keys(signature(found, bands * rows), bands, rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "class_key", "buckets"])

    return map_arrow(id_and_text(docs), sign, "doc_id long, n_shingles long, class_key binary, buckets array<bigint>")


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """node, n_shingles, shingles of the texts (node, class_key, text) whose set is that class."""
    def cut(batches):
        for batch in small_batches(batches):
            sets = [shingle_set(text, words) for text in text_bytes(batch.column("text"))]
            own = [class_key(x) == key for x, key in zip(sets, batch.column("class_key").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                ["node", "n_shingles", "shingles"]).filter(pa.array(own, pa.bool_()))

    return map_arrow(texts.select("node", "class_key", "text"), cut, "node long, n_shingles long, shingles array<bigint>")


def named_classes(classes: DataFrame) -> DataFrame:
    """Adds ``node``, a number for each class (class_key, first): its least id, if no other class has that one.

    Further classes of an id with several texts get a hash that is no other class's number.
    """
    place = F.row_number().over(Window.partitionBy("first").orderBy("class_key"))
    ranked = written(classes.withColumn("place", place), "ranked")
    plain = ranked.filter("place = 1").select("class_key", "first", F.col("first").alias("node"))
    more = ranked.filter("place > 1").select("class_key", "first")
    if more.isEmpty():
        return plain
    salt, clash = 0, more
    while not clash.isEmpty():
        salt += 1
        hashed = more.withColumn("node", F.xxhash64("class_key", F.lit(salt)))
        every = plain.select("node").unionByName(hashed.select("node"))
        clash = every.groupBy("node").count().filter("count > 1")
    return plain.unionByName(hashed)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", common.alias("common"))
            .filter(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))
            .select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """node, label (least node reachable), for every node that has a link.

    Tables of a turn are deleted once the next has replaced them.
    """
    spark = links.sparkSession
    both = written(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                   .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "links")
    labels, old = written_at(both.groupBy("node").agg(F.min("other").alias("other"))
                             .select("node", F.least("node", "other").alias("label")), "labels")
    while True:
        offered = both.join(labels.toDF("other", "offer"), "other").groupBy("node").agg(F.min("offer").alias("offer"))
        lower, low = written_at(labels.join(offered, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "offer").alias("next")), "labels")
        # A node's lower label is also offered to the node its old label names; then all labels move one step on.
        hooks = lower.groupBy(F.col("before").alias("node")).agg(F.min("next").alias("hook"))
        hooked, mid = written_at(lower.join(hooks, "node", "left").select(
            "node", "before", F.least("next", F.coalesce("hook", "next")).alias("next")), "labels")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved, new = written_at(hooked.join(jump, "next", "left").select(
            "node", "before", F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        for path in (old, low, mid):
            discard(spark, path)
        labels, old = moved.select("node", "label"), new
        if moved.filter(F.col("before") != F.col("label")).isEmpty():
            return labels


def linked(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """node, label for the nodes that have links.

    classes: (class_key, first: an id that holds it, node); members: (bucket, node, n_shingles), only buckets of two or more.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n_members"))
    meets = written(members.join(written(sizes, "sizes"), "bucket").groupBy("node")
                    .agg(F.sum("n_members").alias("meets")), "meets")
    holders = classes.join(meets, "node", "left_semi").withColumnRenamed("first", "doc_id")
    sets = written(shingle_sets(docs.join(holders, "doc_id"), words), "sets")
    members = written(members.join(meets, "node"), "members")
    # A bucket's hub is the member that meets most others.
    first = F.struct((-F.col("meets")).alias("meets"), F.xxhash64("node").alias("h"), "node", "n_shingles")
    hubs = written(members.groupBy("bucket").agg(F.min(first).alias("hub")).select(
        "bucket", F.col("hub.node").alias("hub"), F.col("hub.n_shingles").alias("hub_size")), "hubs")
    fits = 100 * F.least("n_shingles", "hub_size") >= percent * F.greatest("n_shingles", "hub_size")
    pairs = written(members.join(hubs, "bucket").filter((F.col("node") != F.col("hub")) & fits)
                    .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
    links = written(verified(pairs, sets, percent), "verified")
    labels = components(links)
    # Open: members of a bucket that holds several components, beyond the hub and one other.
    named = written(members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    several = (named.groupBy("bucket")
               .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n_members"))
               .filter((F.col("lo") < F.col("hi")) & (F.col("n_members") > 2)).select("bucket"))
    open_nodes = written(named.join(written(several, "several"), "bucket", "left_semi")
                         .select("node", "label").distinct(), "open")
    if open_nodes.isEmpty():
        return labels
    rest = written(rare_prefix_pairs(sets, open_nodes, percent).join(pairs, ["a", "b"], "left_anti"), "rest")
    found = written(verified(rest, sets, percent), "verified")
    return labels if found.isEmpty() else components(links.unionByName(found))


def rare_prefix_pairs(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Every pair (a, b) of ``nodes`` with different labels that may reach the similarity.

    Prefix filter (Xiao et al. 2008): with the shingles of a set in order of rising frequency, two
    sets that reach the similarity share one among the first n - ceil(2t/(1+t) n) + 1 of
    the smaller and the first n - ceil(t n) + 1 of the larger. Shingles of one text alone need
    no join; they only fill places. So a text with many words of its own meets nobody, however
    large the group it comes from.
    """
    own = sets.select("node", "n_shingles", "shingles").join(nodes, "node").dropDuplicates(["node"])  # repeated rows
    single = written(own.select("node", "label", "n_shingles", F.explode("shingles").alias("shingle")), "shingles")
    often = written(single.groupBy("shingle").agg(F.count("*").alias("held")).filter(F.col("held") > 1), "often")
    ordered = single.join(often, "shingle").groupBy("node", "label", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("held", "shingle"))).alias("common"))
    n, alone = F.col("n_shingles"), F.col("n_shingles") - F.size("common")

    def prefix(required):
        return F.slice("common", F.lit(1), F.greatest(n - required + 1 - alone, F.lit(0)).cast("int"))

    smaller = F.ceil(2 * percent * n / (100 + percent))
    larger = F.ceil(percent * n / 100)
    kept = written(ordered.select("node", "label", "n_shingles", alone.alias("alone"), prefix(smaller).alias("index"),
                                  prefix(larger).alias("probe")), "prefixes")

    def side(name, which):
        return (kept.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"),
                            F.col("n_shingles").alias(f"{name}_n"), "alone", F.posexplode(which).alias("at", "rare"))
                .select(name, f"{name}_label", f"{name}_n", F.col("rare.shingle").alias("shingle"),
                        (F.col(f"{name}_n") - F.col("alone") - F.col("at")).alias(f"{name}_left")))

    # If this is the first shingle both share, no more than what is left of either can be common.
    required = F.ceil(percent * (F.col("x_n") + F.col("y_n")) / (100 + percent))
    fits = ((F.col("x_label") != F.col("y_label")) & (F.col("x_n") <= F.col("y_n"))
            & (100 * F.col("x_n") >= percent * F.col("y_n"))
            & (F.least("x_left", "y_left") >= required))
    return side("x", "index").join(side("y", "probe"), "shingle").filter(fits).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    texts = id_and_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    signed = written(described(texts, words, bands, rows), "signed")
    rows_ = signed.select("doc_id", "n_shingles", "class_key").distinct()
    classes = written(named_classes(rows_.filter(F.col("class_key").isNotNull()).groupBy("class_key")
                                    .agg(F.min("doc_id").alias("first"))), "classes")
    held = signed.join(classes.withColumnRenamed("first", "doc_id"), ["class_key", "doc_id"])
    buckets = written(held.select("node", "n_shingles", F.explode("buckets").alias("bucket")), "buckets")
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = written(shared.filter(F.col("lo") < F.col("hi")).select("bucket"), "shared")
    members = written(buckets.join(shared, "bucket", "left_semi").dropDuplicates(["bucket", "node"]), "members")
    labels = linked(texts, classes, members, words, percent)
    grouped = written(classes.join(labels, "node").select("class_key", "first", "label"), "grouped")
    least = grouped.groupBy("label").agg(F.min("first").alias("component"))
    named = written(classes.join(grouped.join(least, "label").select("class_key", "component"), "class_key", "left")
                    .select("class_key", F.coalesce("component", "first").alias("component")), "components")
    own = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    result = rows_.join(named, "class_key", "left").select(
        own.alias("doc_id"), "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    return result.select(
        "doc_id", "n_shingles",
        F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"),
        F.coalesce("doc_id", F.lit(NO_ID)).eqNullSafe(F.col("component")).alias("kept"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the least id of their near-duplicate group, with all columns.

    Of an id with several texts all rows stay if one of the texts does.
    At similarity 0.8, 50 bands of 6 miss a pair with probability below 3e-7.
    """
    judged = near_duplicates(docs, words, percent, bands=BANDS, rows=6).groupBy("doc_id").agg(F.max("kept").alias("any_kept"))
    gone = judged.filter(~F.col("any_kept")).select("doc_id").alias("gone")
    kept = docs.alias("kept")
    return kept.join(gone, F.col("kept.doc_id").cast("long") == F.col("gone.doc_id"), "left_anti")


SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, w, least(len(w), 3) AS n FROM words WHERE len(w) > 0),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM runs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x AS v, y AS u FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS v, doc_id AS u FROM documents
  UNION SELECT reach.v, edges.u FROM reach JOIN edges ON edges.v = reach.u),
least_ids AS (SELECT v AS doc_id, min(u) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least_ids l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""


@query("op4_minhash_near_dedup", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
