"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document. Expectation-
maximisation (Dawid and Skene 1979) estimates from all documents how often each labeller
votes each way on good and on bad documents, and the share of good ones. Votes are counted by pattern, so
one row per pattern of votes reaches the driver, at most 3^labellers. The posterior of its pattern is a
document's soft label; soft labels of a bounded sample train a hashed linear scorer
(logistic regression on byte n-grams and repeated words), which scores every whole text. No
true label is read.

Defined cases: null text and text without words get votes like any other text (bad by the
labellers that need words) and a score; an empty table gives no rows; repeated rows count and are
scored each; documents without an id take part in the counts, not in the sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import id_and_text, map_arrow, small_batches, table, text_bytes
from seriesloom.llm.linear import hashed_ngrams, logistic, sigmoid
from seriesloom.llm.registry import query
from seriesloom.llm.textops import word_bounds, word_hashes

SAMPLE_DOCS = 4000
DIMS = 2048
EXTRA = 10
THRESHOLD = 0.5
GOOD, BAD, NONE = 1, 0, 2

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>{}[]\\^~=_@/+")] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[0x41:0x5B] = True
STOP = np.zeros(256, dtype=bool)
STOP[list(b".!?")] = True

LABELLERS = ["symbols", "symbol_words", "letters", "repeats", "variety", "sentences", "capitals", "lines", "length"]


def measures(text: bytes) -> np.ndarray:
    """Shares and counts the labellers look at."""
    data = np.frombuffer(text, dtype=np.uint8)
    hashes = word_hashes(text)
    words, letters = max(len(hashes), 1), max(int(LETTER[data].sum()), 1)
    starts, ends = word_bounds(data)
    same = float((hashes[1:] == hashes[:-1]).sum()) / words
    pairs = np.unique(hashes[1:] ^ (hashes[:-1] * np.uint64(3))) if len(hashes) > 1 else hashes
    endings = STOP[data[ends - 1]].sum() if len(ends) else 0
    runs = STOP[data[1:]] & STOP[data[:-1]] if len(data) > 1 else np.zeros(0)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return np.array([
        SYMBOL[data].sum() / words, same, len(pairs) / words if len(hashes) > 1 else 1.0,
        endings / words, UPPER[data].sum() / letters, 1 - len(set(lines)) / max(len(lines), 1),
        len(hashes), float(runs.sum()) / words, float(SYMBOL[data[ends - 1]].sum()) / words if len(ends) else 0.0,
        letters / max(int((ends - starts).sum()), 1)])


def votes(m: np.ndarray) -> tuple[int, ...]:
    """One vote per labeller, from the measures."""
    symbols, same, variety, endings, capitals, lines, words, runs, symbol_words, letters = m

    def vote(good: bool, bad: bool) -> int:
        return BAD if bad else GOOD if good else NONE

    return (vote(symbols < 0.02, symbols > 0.15), vote(symbol_words < 0.02, symbol_words > 0.1),
            vote(letters > 0.93, letters < 0.87), vote(same < 0.05, same > 0.25),
            vote(variety > 0.7, variety < 0.45), vote(0.02 <= endings <= 0.4 and runs < 0.05, endings == 0 or runs > 0.2),
            vote(capitals < 0.2, capitals > 0.5), vote(lines < 0.05, lines > 0.3), vote(words >= 15, words < 5))


def pattern_of(cast: tuple[int, ...]) -> int:
    out = 0
    for vote in cast:
        out = out * 3 + vote
    return out


def described(docs: DataFrame) -> DataFrame:
    """doc_id, pattern of votes."""
    def look(batches):
        for batch in small_batches(batches):
            found = [pattern_of(votes(measures(text))) for text in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int32())], ["doc_id", "pattern"])

    return map_arrow(id_and_text(docs), look, "doc_id long, pattern int")


def unpack(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** k % 3 for k in range(len(LABELLERS) - 1, -1, -1)], axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, turns: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern, vote chances (class, labeller, vote), share of good documents."""
    cast = unpack(patterns)
    one_hot = np.stack([cast == v for v in range(3)], axis=2).astype(float)
    good, bad = (cast == GOOD).sum(axis=1), (cast == BAD).sum(axis=1)
    # Start: a document is bad if a labeller says so and not most of the others disagree strongly.
    posterior = np.where(bad >= 2, 0.05, np.where(bad == 1, 0.4, np.where(good > 0, 0.95, 0.5)))
    total = counts.sum()
    for _ in range(turns):
        share = float((counts * posterior).sum() / total)
        chance = np.stack([
            (np.einsum("p,plv->lv", counts * weight, one_hot) + 0.5) / ((counts * weight).sum() + 1.5)
            for weight in (1 - posterior, posterior)])
        logs = np.stack([(one_hot * np.log(chance[c])[None]).sum(axis=(1, 2)) for c in (0, 1)])
        logs += np.log(np.clip([[1 - share], [share]], 1e-9, 1))
        fresh = sigmoid(logs[1] - logs[0])
        moved = np.abs(fresh - posterior).max()
        posterior = fresh
        if moved < 1e-9:
            break
    return posterior, chance, share


def features(text: bytes) -> np.ndarray:
    m = measures(text)
    dense = np.array([min(m[0], 2), 3 * m[1], 1 - m[2], min(4 * m[3], 2), m[4], m[5], min(np.log1p(m[6]) / 5, 2), 2 * m[7],
                      2 * m[8], min(m[9], 1.5)])
    grams = hashed_ngrams(np.frombuffer(text, dtype=np.uint8), (1, 2, 3), DIMS)
    return np.concatenate([2 * dense, grams, [1.0]]).astype(np.float32)


class Scorer:
    def __init__(self, weights: np.ndarray, posterior: dict[int, float], chance: np.ndarray, share: float):
        self.weights, self.posterior, self.chance, self.share = weights, posterior, chance, share


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Scorer | None:
    texts = id_and_text(docs)
    counted = described(texts).groupBy("pattern").agg(F.count("*").alias("n")).toPandas().sort_values("pattern")
    if counted.empty:
        return None
    patterns, counts = counted["pattern"].to_numpy(), counted["n"].to_numpy(dtype=float)
    posterior, chance, share = estimate(patterns, counts)
    soft = dict(zip(patterns.tolist(), posterior.tolist()))
    shared = docs.sparkSession.sparkContext.broadcast(soft)

    def extract(batches):
        known = shared.value
        for batch in small_batches(batches):
            texts_ = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([features(text).tobytes() for text in texts_], pa.binary()),
                 pa.array([known.get(pattern_of(votes(measures(text))), 0.5) for text in texts_], pa.float64())],
                ["doc_id", "x", "soft"])

    parts = 1_000_000
    limit = int(min(1.0, sample_docs / counts.sum()) * parts) + 1
    chosen = texts.filter(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(parts)) < limit)
    rows = sorted((row.doc_id or 0, bytes(row.x), row.soft)
                  for row in map_arrow(chosen, extract, "doc_id long, x binary, soft double").toLocalIterator())
    if not rows:
        return Scorer(np.zeros(DIMS + EXTRA + 1, dtype=np.float32), soft, chance, share)
    matrix = np.frombuffer(b"".join(x for _, x, _ in rows), dtype=np.float32).reshape(len(rows), -1)
    weights = logistic(matrix, np.array([p for _, _, p in rows]), penalty=0.02)
    return Scorer(weights, soft, chance, share)


def score_texts(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """doc_id, score (0 to 1, higher: better), weak_label (posterior of the votes)."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches):
        fitted = shared.value
        for batch in small_batches(batches):
            texts = text_bytes(batch.column("text"))
            scores = sigmoid(np.array([float(features(text) @ fitted.weights) for text in texts]))
            weak = [fitted.posterior.get(pattern_of(votes(measures(text))), fitted.share) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(weak, pa.float64())],
                ["doc_id", "score", "weak_label"])

    return map_arrow(id_and_text(docs), score, "doc_id long, score double, weak_label double")


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, learn(docs))
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"), "weak_label")
