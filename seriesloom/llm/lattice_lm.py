"""Language-model score: the marginal probability of a text over all its segmentations.

The pieces are those of an existing byte-level vocabulary; their unigram scores are counted on
the training documents (each training word is cut as the vocabulary cuts it, and add-one
smoothing gives every piece a score). A word's probability sums over every way to cut it into
pieces: forward recursion in log space. Pieces start a word with its leading space and
never cross one, so a text's lattice is the chain of its words' lattices and the end symbol,
and its log probability is a sum over words.

Steps: (1) words are counted where documents lie, and (word, training count, count) is summed
over the corpus; (2) each distinct word is solved once; (3) documents are scored in place
from the words of the head, which are sent to every task, and the rest are joined by word. The
head is all words from a count on, the count chosen so that it holds at most ``HEAD_WORDS``
words of at most 64 bytes; it carries the very frequent words, so that no join key is hot.

Base score: add-one unigram over words: log10((c + 1) / (N + V + 1)) for each token.

Defined cases: null text is empty and consists of the end token alone; without training
documents all counts are 0; repeated rows count as often as they appear and give one row; a
null id is never held out.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import fold, id_and_text, map_arrow, small_batches, table, text_bytes, written
from seriesloom.llm.registry import query
from seriesloom.llm.tokens import VOCABULARY, encoding

FOLDS, HELD_OUT = 7, 2
HEAD_WORDS = 150_000
HEAD_BYTES = 64
FLUSH_WORDS = 300_000
SOLVED = "word binary, known boolean, base double, lattice double"


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes.split() takes just these spaces."""
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, trained (tokens in training documents), seen (tokens in all)."""
    def count(batches):
        trained, seen = Counter(), Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array([trained[w] for w in seen], pa.int64()),
                 pa.array(list(seen.values()), pa.int64())], ["word", "trained", "seen"])
            trained.clear()
            seen.clear()
            return out

        for batch in small_batches(batches):
            for text, out_of_fold in zip(text_bytes(batch.column("text")), batch.column("training").to_pylist()):
                words = words_of(text)
                seen.update(words)
                if out_of_fold:
                    trained.update(words)
            if len(seen) > FLUSH_WORDS:
                yield flush()
        if seen:
            yield flush()

    marked = id_and_text(docs).select("text", (fold("doc_id", FOLDS) != HELD_OUT).alias("training"))
    counted = map_arrow(marked, count, "word binary, trained long, seen long")
    return counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def piece_counts(words: DataFrame, vocabulary: str = VOCABULARY) -> dict[int, int]:
    """Occurrences of each piece in the training words; at most one entry per piece of the vocabulary."""
    def count(batches):
        encode = encoding(vocabulary).encode_ordinary
        totals: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("trained").to_pylist()):
                for piece in encode(" " + word.decode("utf-8", "replace")):
                    totals[piece] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())],
                                         ["piece", "n"])

    trained = words.filter(F.col("trained") > 0).select("word", "trained")
    summed = map_arrow(trained, count, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {row.piece: row.n for row in summed.toLocalIterator()}


class Lattice:
    """Marginal log probability of a word under unigram piece scores."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        self.longest: dict[bytes, int] = {}
        for piece in scores:
            start = piece[:2]
            self.longest[start] = max(self.longest.get(start, 0), len(piece))

    def log_probability(self, text: bytes) -> float:
        scores, longest, size = self.scores, self.longest, len(text)
        arrivals: list[list[float]] = [[] for _ in range(size + 1)]
        arrivals[0].append(0.0)
        total = 0.0
        for start in range(size + 1):
            terms = arrivals[start]
            if not terms:
                continue
            if len(terms) == 1:
                total = terms[0]
            else:
                top = max(terms)
                total = top + math.log(sum([math.exp(term - top) for term in terms]))
            if start == size:
                return total
            one = scores.get(text[start:start + 1])
            if one is not None:
                arrivals[start + 1].append(total + one)
            for end in range(start + 2, min(size, start + longest.get(text[start:start + 2], 0)) + 1):
                score = scores.get(text[start:end])
                if score is not None:
                    arrivals[end].append(total + score)
        return -math.inf


def piece_scores(counts: dict[int, int], ends: int, vocabulary: str = VOCABULARY) -> tuple[dict[bytes, float], float]:
    """Natural log score of each piece, and of the end symbol; add-one smoothing over both."""
    pieces = encoding(vocabulary)._mergeable_ranks
    whole = math.log(sum(counts.values()) + ends + len(pieces) + 1)
    scores = {piece: math.log(counts.get(rank, 0) + 1) - whole for piece, rank in pieces.items()}
    return scores, math.log(ends + 1) - whole


@functools.lru_cache(maxsize=1)
def _lattice(counts: tuple[tuple[int, int], ...], ends: int, vocabulary: str) -> Lattice:
    return Lattice(piece_scores(dict(counts), ends, vocabulary)[0])


def solved(words: DataFrame, counts: dict[int, int], ends: int, base_whole: float,
           vocabulary: str = VOCABULARY) -> DataFrame:
    """word, known, base and lattice log10 probability of each distinct word."""
    shared = words.sparkSession.sparkContext.broadcast(tuple(sorted(counts.items())))
    tenth = 1 / math.log(10)

    def solve(batches):
        lattice = _lattice(shared.value, ends, vocabulary)
        for batch in batches:
            found = [lattice.log_probability(b" " + word) * tenth for word in batch.column("word").to_pylist()]
            trained = batch.column("trained").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(trained > 0), pa.array(np.log10(trained + 1) - base_whole),
                 pa.array(found, pa.float64()), batch.column("seen")],
                ["word", "known", "base", "lattice", "seen"])

    return map_arrow(words, solve, SOLVED + ", seen long")


def head_words(words: DataFrame, most: int = HEAD_WORDS) -> list:
    """Rows of the most frequent words; all words above a count, at most ``most`` of them."""
    short = words.filter(F.octet_length("word") <= HEAD_BYTES)
    step = F.floor(F.log2("seen") * 8).cast("int")
    sizes = sorted(((row.step, row.n) for row in short.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()),
                   reverse=True)
    total, limit = 0, None
    for at, n in sizes:
        total += n
        if total > most:
            break
        limit = at
    return [] if limit is None else short.filter(step >= limit).select("word", "known", "base", "lattice").collect()


def score_texts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    counted = written(word_counts(texts), "words")
    ends = texts.filter(fold("doc_id", FOLDS) != HELD_OUT).count()
    sums = counted.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count_if(F.col("trained") > 0).alias("v")).first()
    tokens, distinct = sums.n + ends, sums.v + (1 if ends else 0)
    base_whole = math.log10(tokens + distinct + 1)
    pieces = piece_counts(counted, vocabulary)
    solutions = written(solved(counted, pieces, ends, base_whole, vocabulary), "solved")
    head = {bytes(row.word): (int(row.known), row.base, row.lattice) for row in head_words(solutions)}
    shared = docs.sparkSession.sparkContext.broadcast(head)
    end_base = math.log10(ends + 1) - base_whole
    end_score = piece_scores(pieces, ends, vocabulary)[1] / math.log(10)

    def score(batches):
        known_words = shared.value
        for batch in small_batches(batches):
            tokens_, known, base, total, rest_words, rest_counts, sizes = [], [], [], [], [], [], [0]
            for text in text_bytes(batch.column("text")):
                words = Counter(words_of(text))
                sums_ = [0, 0.0, 0.0]
                for word, n in words.items():
                    at = known_words.get(word)
                    if at is None:
                        rest_words.append(word)
                        rest_counts.append(n)
                    else:
                        sums_[0] += n * at[0]
                        sums_[1] += n * at[1]
                        sums_[2] += n * at[2]
                tokens_.append(sum(words.values()) + 1)
                known.append(sums_[0])
                base.append(sums_[1])
                total.append(sums_[2])
                sizes.append(len(rest_words))
            rest = pa.StructArray.from_arrays([pa.array(rest_words, pa.binary()), pa.array(rest_counts, pa.int64())],
                                              ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(tokens_, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rest)],
                ["doc_id", "text_key", "n_tokens", "n_known", "base", "total", "rest"])

    scanned = written(map_arrow(
        texts, score, "doc_id long, text_key long, n_tokens long, n_known long, base double, total double, "
                      "rest array<struct<word: binary, n: bigint>>"), "scanned")
    rest = scanned.select("doc_id", "text_key", F.explode("rest").alias("rest")).select("doc_id", "text_key", "rest.*")
    tail = (rest.join(solutions.select("word", "known", "base", "lattice"), "word")
            .groupBy("doc_id", "text_key").agg(
                F.sum(F.col("n") * F.col("known").cast("int")).alias("t_known"),
                F.sum(F.col("n") * F.col("base")).alias("t_base"),
                F.sum(F.col("n") * F.col("lattice")).alias("t_total"))
            .select(F.col("doc_id").alias("t_id"), F.col("text_key").alias("t_key"), "t_known", "t_base", "t_total"))
    heads = scanned.groupBy(*[name for name in scanned.columns if name != "rest"]).agg(F.count("*").alias("copies"))
    both = heads.join(tail, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_key") == F.col("t_key")), "left")
    zero = F.lit(0.0)
    return both.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce((F.col("t_known") / F.col("copies")).cast("long"), F.lit(0))
         + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("t_base") / F.col("copies"), zero) + F.lit(end_base)).alias("base_score"),
        (F.col("total") + F.coalesce(F.col("t_total") / F.col("copies"), zero) + F.lit(end_score)).alias("score"))


@query("op8_lattice_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
