"""Benchmark decontamination: Wu-Manber search for windows of benchmark words.

A window is ten consecutive words of a benchmark item, or the whole item if it is shorter.
Windows of one length form one matcher: a shift table over blocks of two words skips
positions where no window can end, a bucket per last block selects the windows to test,
and the words themselves are compared.

The benchmark is the query set. Its (window, item) pairs are dealt by hash into blocks of
about ``block_pairs``; the driver and the tasks hold one block each time, so neither a
large benchmark nor a window shared by many items has to fit anywhere whole. Documents are
scanned in place, without a shuffle; only with several blocks are the hits of a document
gathered again.

Defined cases: null or word-less text has no words and is clean; an item without words is
ignored; an item with a null id marks words but is not listed; an empty benchmark leaves
every document clean; every input row gives one output row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import ASCII_LOWER_SQL, arrow, id_and_text, map_arrow, small_batches, table, text_bytes, written
from seriesloom.llm.registry import query

WINDOW = 10
BLOCK_PAIRS = 200_000

#: A-Z to a-z; 0-9, a-z and all bytes from 0x80 stay; the rest separates words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def item_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WuManber:
    """Patterns of one length over words."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list] = defaultdict(list)
        for words, owners in patterns.items():
            for end in range(self.block, length + 1):
                key = words[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.buckets[words[length - self.block:]].append((words, owners))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """(start, owners) of every occurrence."""
        length, block, default, shift = self.length, self.block, self.default, self.shift
        end, last = length, len(words)
        while end <= last:
            key = tuple(words[end - block:end])
            step = shift.get(key, default)
            if step:
                end += step
                continue
            start = end - length
            found = tuple(words[start:end])
            for pattern, owners in self.buckets[key]:
                if pattern == found:
                    yield start, owners
            end += 1


def matchers(pairs: list[tuple[bytes, str | None]]) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], list]] = defaultdict(dict)
    for window, item in pairs:
        words = tuple(window.split(b" "))
        by_length[len(words)].setdefault(words, []).append(item)
    return [WuManber(length, patterns) for length, patterns in sorted(by_length.items())]


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (window, item) pairs; the words of a window are joined by one space."""
    def cut(batches):
        for batch in small_batches(batches):
            windows, items = [], []
            for item, text in zip(batch.column("item").to_pylist(), text_bytes(batch.column("text"))):
                words = item_words(text)
                for start in range(max(1, len(words) - WINDOW + 1) if words else 0):
                    windows.append(b" ".join(words[start:start + WINDOW]))
                    items.append(item)
            yield arrow({"bench_window": (windows, pa.binary()), "bench_item": (items, pa.string())})

    columns = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return map_arrow(columns, cut, "bench_window binary, bench_item string").distinct()


def scan(docs: DataFrame, pairs: list[tuple[bytes, str | None]]) -> DataFrame:
    """doc_id, text_key, n_words, positions of the hit words, items found, for one block of pairs."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def search(batches):
        searchers = matchers(shared.value)
        for batch in small_batches(batches):
            counts, hits, items = [], [], []
            for text in text_bytes(batch.column("text")):
                words = item_words(text)
                hit, found = set(), set()
                for searcher in searchers:
                    for start, owners in searcher.occurrences(words):
                        hit.update(range(start, start + searcher.length))
                        found.update(owners)
                counts.append(len(words))
                hits.append(sorted(hit))
                items.append(sorted(x for x in found if x is not None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()),
                 pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text_key", "n_words", "hit_words", "item_ids"])

    keyed = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    return map_arrow(keyed, search, "doc_id long, text_key long, n_words long, hit_words array<int>, item_ids array<string>")


def pair_blocks(benchmark: DataFrame, block_pairs: int) -> Iterator[list[tuple[bytes, str | None]]]:
    """The (window, item) pairs in blocks of about ``block_pairs``, each read when it is asked for."""
    windows = written(benchmark_windows(benchmark), "windows")
    blocks = max(1, -(-windows.count() // block_pairs))
    dealt = windows.withColumn("bench_block", F.pmod(F.xxhash64("bench_window", "bench_item"), F.lit(blocks)))
    for block in range(blocks):
        yield [(bytes(row.bench_window), row.bench_item)
               for row in dealt.filter(F.col("bench_block") == block).toLocalIterator()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """doc_id, n_words, hit_words (positions of words inside occurrences), item_ids."""
    scans = [scan(docs, pairs) for pairs in pair_blocks(benchmark, block_pairs)]
    if len(scans) == 1:
        return scans[0].drop("text_key")
    union = scans[0]
    for part in scans[1:]:
        union = union.unionByName(part)
    found = union.groupBy("doc_id", "text_key").agg(  # each block has a row for each copy of a document row
        (F.count("*") / len(scans)).cast("long").alias("copies"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("text_key", "copies", "copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark window, with all their columns; blocks in turn."""
    for pairs in pair_blocks(benchmark, block_pairs):
        shared = docs.sparkSession.sparkContext.broadcast(pairs)

        def clean(batches, shared=shared):
            searchers = matchers(shared.value)
            for batch in small_batches(batches):
                words = map(item_words, text_bytes(batch.column("text")))
                yield batch.filter(pa.array([not any(next(x.occurrences(w), None) for x in searchers) for w in words],
                                            pa.bool_()))

        docs = map_arrow(docs, clean, docs.schema)
    return docs


SQL = f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all({ASCII_LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({ASCII_LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, sizes WHERE len(w) >= n)),
hits AS (SELECT d.r, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.win = b.win),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits))
  GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(k.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(k.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items k USING (r)
"""


@query("op10_benchmark_decontamination", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))
