"""Language identification: the family first, then the language inside the family.

Features are hashed byte n-grams (one to four) of the lower-cased text with everything that is
no letter read as a space. A one-versus-one set of linear support vector machines tells families
apart; inside each family a further one-versus-one set separates the related languages. The
class with most won duels is the answer, and summed margins break ties.

Training takes whole texts and short passages of a bounded sample of at most about
``SAMPLE_DOCS`` documents outside the held-out fold, spread evenly over the languages. All
documents are then scored where they lie.

Defined cases: null text and text without a letter are ``und`` with score 0; without any
training document every text is ``und``; with a single training language that language is
returned with score 1; repeated rows each give a row; a null id is not held out.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import fold, id_and_text, map_arrow, small_batches, table
from seriesloom.llm.linear import bounded_sample, hashed_ngrams, sigmoid, svm
from seriesloom.llm.registry import query

FOLDS, HELD_OUT = 3, 1
SAMPLE_DOCS = 900
DIMS = 4096
SIZES = (1, 2, 3, 4)
COST = 10.0

#: Languages of each family by ISO 639-1 code. Any other value is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

LETTER = regex.compile(r"\p{L}")
#: ASCII bytes that are no letters read as a space.
LETTER_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def features(text: str) -> np.ndarray:
    data = b" ".join(text.lower().encode("utf-8", "replace").translate(LETTER_BYTES).split())
    return hashed_ngrams(np.frombuffer(b" " + data + b" ", dtype=np.uint8), SIZES, DIMS)


def passages(text: str) -> list[str]:
    """The text, and short stretches of it of 1, 3, 8 and 20 words."""
    words = text.split()
    out = [text]
    for k, size in enumerate((1, 3, 8, 20)):
        if len(words) > size:
            start = (k * 7919 + len(text)) % (len(words) - size)
            passage = " ".join(words[start:start + size])
            if LETTER.search(passage):
                out.append(passage)
    return out


class Duels:
    """One-versus-one machines over some classes."""

    def __init__(self, matrix: np.ndarray, classes: np.ndarray):
        self.names = sorted(set(classes.tolist()))
        self.pairs = list(itertools.combinations(range(len(self.names)), 2))
        weights = []
        for a, b in self.pairs:
            rows = np.flatnonzero((classes == self.names[a]) | (classes == self.names[b]))
            weights.append(svm(matrix[rows], np.where(classes[rows] == self.names[a], 1.0, -1.0), COST))
        self.weights = np.array(weights, dtype=np.float32).reshape(len(weights), matrix.shape[1]).T

    def decide(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the winner and how sure the closest of its duels is (0 to 1)."""
        rows = np.arange(len(matrix))
        if not self.pairs:
            return np.zeros(len(matrix), dtype=int), np.ones(len(matrix))
        margins = matrix @ self.weights
        wins, summed = np.zeros((len(matrix), len(self.names))), np.zeros((len(matrix), len(self.names)))
        closest = np.full((len(matrix), len(self.names)), np.inf)
        for k, (a, b) in enumerate(self.pairs):
            for side, sign in ((a, 1), (b, -1)):
                margin = sign * margins[:, k]
                wins[:, side] += margin > 0
                summed[:, side] += margin
                closest[:, side] = np.minimum(closest[:, side], margin)
        winner = np.argmax(wins + 1e-3 * np.tanh(summed), axis=1)
        return winner, sigmoid(3 * closest[rows, winner])


class Model:
    def __init__(self, matrix: np.ndarray, languages: np.ndarray):
        families = np.array([FAMILY_OF.get(x, f"only:{x}") for x in languages])
        self.families = Duels(matrix, families)
        self.inside = {name: Duels(matrix[families == name], languages[families == name]) for name in self.families.names}

    def predict(self, matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, sure = self.families.decide(matrix)
        names: list = [None] * len(matrix)
        for k, name in enumerate(self.families.names):
            rows = np.flatnonzero(family == k)
            if len(rows):
                language, inner = self.inside[name].decide(matrix[rows])
                sure[rows] *= inner
                for row, at in zip(rows, language):
                    names[row] = self.inside[name].names[at]
        return names, sure


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """docs: doc_id, text, lang. None if nothing can be learned from."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
    usable = usable.filter(F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT) & F.col("text").rlike(r"\p{L}"))

    def extract(batches):
        for batch in small_batches(batches):
            rows, names = [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                for passage in passages(text):
                    rows.append(features(passage).tobytes())
                    names.append(lang)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(names, pa.string())], ["x", "lang"])

    chosen = bounded_sample(usable, "doc_id", "lang", sample_docs)
    rows = sorted((row.lang, bytes(row.x)) for row in map_arrow(chosen, extract, "x binary, lang string").toLocalIterator())
    if not rows:
        return None
    return Model(np.frombuffer(b"".join(x for _, x in rows), dtype=np.float32).reshape(len(rows), DIMS),
                 np.array([lang for lang, _ in rows]))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        fitted = shared.value
        for batch in small_batches(batches, most_bytes=1 << 20):
            texts = batch.column("text").to_pylist()
            rows = [k for k, text in enumerate(texts) if text and LETTER.search(text)] if fitted else []
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if rows:
                found, sure = fitted.predict(np.array([features(texts[k]) for k in rows]))
                for k, name, score in zip(rows, found, sure):
                    names[k], scores[k] = name, float(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return map_arrow(id_and_text(docs), predict, "doc_id long, lang_pred string, score double")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
