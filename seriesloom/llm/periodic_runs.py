"""Periodic runs of words by suffix trees: every maximal repetition of a text, and the text without repeats.

A run is a stretch of words with smallest period q, of at least max(12, 2q) words, that no neighbouring
word extends. Runs are found as the runs theorem describes them (Bannai et al. 2017):

  1. Ukkonen's algorithm builds the suffix trees of the word sequence and of its reversal. An
     Euler tour of a tree visits the suffixes in order; between two neighbouring leaves it passes their lowest
     common ancestor. A table of range minima over those depths answers any later LCA, and so
     the longest common extension of two places, in constant time.
  2. From the suffix order come the longest Lyndon words at each place, under the word order and
     under its inverse (next smaller suffix). Each is the root of one candidate.
  3. Candidates are extended to the right by the text's tree and to the left by the reversal's. Every
     run has such a root, and there are fewer than two candidates a word.

Trees are built only where a run can lie. Inside a run of period q at least six words in a row recur q
words on, so each of its words lies in a six-word window that recurs, in the same island of such
windows, at most half an island away. Windows are hashed, islands shrunk until they stay, and the words of
those that are left numbered exactly; a hash collision can only make an island larger.

A row is handled by itself, in memory proportional to its text and its largest island; no shuffle.

Defined cases: null, empty and short texts have no runs; a row without an id is read like any other; repeated rows
give a row each; an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import id_and_text, map_arrow, small_batches, table, text_bytes
from seriesloom.llm.registry import query
from seriesloom.llm.textops import exact_word_hashes

LEAST = 12
WINDOW = LEAST // 2
ROUNDS = 16

_random = np.random.default_rng(20240407)
FACTORS = _random.integers(0, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- suffix trees --------------------------------------------------------------------------------

class SuffixTree:
    """Ukkonen's tree of ``symbols`` (1 .. size-1), closed by the least symbol 0."""

    def __init__(self, symbols: list[int], size: int):
        text = [*symbols, 0]
        self.size, self.count = size, len(text)
        begins, ends, links, edges, leaves = [0], [0], [0], {}, []
        node = place = depth = 0  # the active point: below ``node``, ``depth`` symbols along the edge of text[place]
        waiting = 0
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not depth:
                    place = at
                key = node * size + text[place]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(begins)
                    leaves.append(len(begins))
                    begins.append(at)
                    ends.append(self.count)
                    links.append(0)
                    if unlinked:
                        links[unlinked] = node
                        unlinked = 0
                else:
                    begin = begins[child]
                    length = ends[child] - begin
                    if depth >= length:
                        node, place, depth = child, place + length, depth - length
                        continue
                    if text[begin + depth] == symbol:
                        depth += 1
                        if unlinked:
                            links[unlinked] = node
                        break
                    inner = len(begins)
                    begins += (begin, at)
                    ends += (begin + depth, self.count)
                    links += (0, 0)
                    edges[key] = inner
                    edges[inner * size + symbol] = inner + 1
                    leaves.append(inner + 1)
                    begins[child] = begin + depth
                    edges[inner * size + text[begin + depth]] = child
                    if unlinked:
                        links[unlinked] = inner
                    unlinked = inner
                waiting -= 1
                if node:
                    node = links[node]
                elif depth:
                    depth -= 1
                    place = at - waiting + 1
        self.lengths = [end - begin for begin, end in zip(begins, ends)]
        self.suffix = [-1] * len(begins)  # leaves arise in the order of their suffixes
        for start, leaf in enumerate(leaves):
            self.suffix[leaf] = start
        self.keys = np.fromiter(edges.keys(), dtype=np.int64, count=len(edges))
        self.children = np.fromiter(edges.values(), dtype=np.int64, count=len(edges))

    def tour(self, inverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order an Euler tour meets them, and the depth it falls to before each.

        ``inverse`` turns the order of the symbols round; the closing symbol stays least.
        """
        parents, symbols = np.divmod(self.keys, self.size)
        if inverse:
            symbols = (self.size - symbols) % self.size
        order = np.argsort(parents * self.size + symbols)
        children = self.children[order].tolist()
        edges = np.searchsorted(parents[order], np.arange(len(self.lengths) + 1)).tolist()
        lengths, suffix = self.lengths, self.suffix
        found, falls, stack = [], [], [(0, 0, 0)]
        while stack:
            node, depth, fall = stack.pop()
            if suffix[node] >= 0:
                found.append(suffix[node])
                falls.append(fall)
                continue
            first = edges[node]
            for child in children[edges[node + 1] - 1:first:-1]:
                stack.append((child, depth + lengths[child], depth))
            stack.append((children[first], depth + lengths[children[first]], fall))
        return np.array(found), np.array(falls, dtype=np.int32)


class Extensions:
    """Longest common extensions: the depth of two leaves' lowest common ancestor, by range minima over a tour."""

    def __init__(self, suffixes: np.ndarray, falls: np.ndarray):
        self.ranks = np.empty(len(suffixes), dtype=np.int64)
        self.ranks[suffixes] = np.arange(len(suffixes))
        self.minima = [falls]
        while 2 << len(self.minima) - 1 <= len(falls):
            width = 1 << len(self.minima) - 1
            self.minima.append(np.minimum(self.minima[-1][:-width], self.minima[-1][width:]))

    def of(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes at two different places each."""
        low, high = self.ranks[one], self.ranks[other]
        low, high = np.minimum(low, high) + 1, np.maximum(low, high) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            table_ = self.minima[k]
            out[mine] = np.minimum(table_[low[mine]], table_[high[mine] - (1 << k)])
        return out


def next_smaller(ranks: list[int]) -> np.ndarray:
    """For each place but the last, the next place whose suffix is smaller; the last holds the least suffix."""
    out, waiting = [0] * len(ranks), []
    for place, rank in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > rank:
            out[waiting.pop()] = place
        waiting.append(place)
    return np.array(out[:-1])


def runs_of(symbols: list[int], size: int, least: int = LEAST) -> np.ndarray:
    """All runs of at least ``least`` symbols: rows of start, length, smallest period; by start, then period."""
    count = len(symbols)
    tree = SuffixTree(symbols, size)
    ahead = Extensions(*tree.tour())
    inverse = np.empty(count + 1, dtype=np.int64)
    inverse[tree.tour(inverse=True)[0]] = np.arange(count + 1)
    back = Extensions(*SuffixTree(symbols[::-1], size).tour())
    first = np.tile(np.arange(count), 2)
    second = np.concatenate([next_smaller(ahead.ranks.tolist()), next_smaller(inverse.tolist())])
    start = first - back.of(count - first, count - second)
    period = second - first
    length = second + ahead.of(first, second) - start
    keep = length >= np.maximum(least, 2 * period)
    return np.unique(np.stack([start[keep], period[keep], length[keep]], axis=1), axis=0)[:, [0, 2, 1]]


# --- islands -------------------------------------------------------------------------------------

def islands(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of words that hold all runs, cut as far as recurring windows allow."""
    count = len(hashes)
    if count < LEAST:
        return []
    windows = np.zeros(count - WINDOW + 1, dtype=np.uint64)
    for k in range(WINDOW):
        windows += hashes[k:k + len(windows)] * FACTORS[k]
    starts, ends = np.array([0]), np.array([count])
    for _ in range(ROUNDS):
        held = ends - starts - WINDOW + 1
        owner = np.repeat(np.arange(len(starts)), held)
        places = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(held) - held), held)
        order = np.lexsort([windows[places], owner]) if len(starts) > 1 else np.argsort(windows[places], kind="stable")
        places, owner = places[order], owner[order]
        near = ((windows[places[1:]] == windows[places[:-1]]) & (owner[1:] == owner[:-1])
                & (2 * (places[1:] - places[:-1]) <= (ends - starts)[owner[1:]]))
        chosen = np.concatenate([places[1:][near], places[:-1][near]])
        if not len(chosen):
            return []
        depth = np.zeros(count + 1, dtype=np.int64)
        np.add.at(depth, chosen, 1)
        np.add.at(depth, chosen + WINDOW, -1)
        turns = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(depth[:-1]) > 0, [False]]).astype(np.int8)))
        before = int((ends - starts).sum())
        starts, ends = turns[::2], turns[1::2]
        enough = ends - starts >= LEAST
        starts, ends = starts[enough], ends[enough]
        if not len(starts) or int((ends - starts).sum()) == before:
            break
    return list(zip(starts.tolist(), ends.tolist()))


def text_runs(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """The runs of a word sequence; ``hashes`` are equal where words are."""
    found = []
    for start, end in islands(hashes):
        numbers: dict[bytes, int] = {}
        symbols = [numbers.setdefault(word, len(numbers) + 1) for word in words[start:end]]
        own = runs_of(symbols, len(numbers) + 1)
        own[:, 0] += start
        found.append(own)
    return np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)


def without_repeats(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds beyond its first period, joined by spaces."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, reorder: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, runs (by start, then period), collapsed (the text's words without repeats), a row per document.

    ``reorder(doc_id, n_words)`` may name the words that stand for words 0 .. n_words-1.
    """
    def search(batches):
        for batch in small_batches(batches):
            ids, runs, kept = batch.column("doc_id").to_pylist(), [], []
            for doc, text in zip(ids, text_bytes(batch.column("text"))):
                words, hashes = text.split(), exact_word_hashes(text)
                places = reorder(doc, len(words)) if reorder else None
                if places is not None:
                    words, hashes = [words[k] for k in places.tolist()], hashes[places]
                found = text_runs(words, hashes)
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in found.tolist()])
                kept.append(without_repeats(words, found))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(runs, kind), pa.array(kept, pa.binary())],
                                             ["doc_id", "runs", "collapsed"])

    return map_arrow(id_and_text(docs), search,
                     "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")


def looped(doc_id: int | None, count: int) -> np.ndarray | None:
    """One document in ten, by the checksum of its id, repeats a stretch to its end; others stay (None)."""
    if doc_id is None or not count:
        return None
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return None
    share = checksum // 10
    first = share % count
    period = 1 + (count - first) // (3 + share % 8)
    places = np.arange(count)
    places[first:] = first + (places[first:] - first) % period
    return places


SQL = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sums AS (
  SELECT *, len(w) AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
    lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS h FROM texts),
shares AS (SELECT *, h // 10 AS g FROM sums),
firsts AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM shares),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM firsts),
seqs AS (
  SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM periods),
grams AS (
  SELECT r, n, i, array_to_string(list_slice(w, i + 1, i + 6), ' ') AS s
  FROM (SELECT r, n, w, unnest(range(0, n - 5)) AS i FROM seqs WHERE n >= 12)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.s = y.s AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM pairs) GROUP BY r, q, g),
runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS k, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s,
         max(length) AS longest FROM runs GROUP BY r),
best AS (
  SELECT r, start, length, period FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) AS place FROM runs) WHERE place = 1),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS s
  FROM (SELECT r, unnest(w) AS word, unnest(range(0, n)) AS i FROM seqs) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(coalesce(l.k, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length,
       CAST(b.period AS BIGINT) AS period, CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.s, '')) AS runs_sha256, sha256(coalesce(o.s, '')) AS collapsed_sha256
FROM seqs LEFT JOIN listed l USING (r) LEFT JOIN best b USING (r) LEFT JOIN left_over o USING (r)
"""


@query("op13_periodic_run_detection", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), looped)
    best = F.array_max(F.transform("runs", lambda run: F.struct(
        run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period"))))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    lines = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.call_function("div", 1000 * F.col("best.length"), -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
