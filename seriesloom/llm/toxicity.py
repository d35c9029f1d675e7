"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel counts common subsequences of four letters; a subsequence that stretches over l
characters, however many, weighs DECAY^l, so gaps and inserted characters only weaken a match
(Lodhi et al. 2002). A character that is no letter takes up one place, whatever its bytes, and
matches nothing. The kernel is normalised by both self kernels, which a recursion gives.

A text is read as spans: its words between marks for start and end, and runs of single characters
("i d i o t") joined. Words of more than ``SPAN`` letters are read as overlapping stretches of that many
letters with all that lies between them; what only a wider match would add weighs at most
DECAY^(SPAN + 1) = 3e-6 a subsequence, the precision of the weights. A document is judged by its most toxic span and by
how many of its spans are toxic.

Training (at most about ``SAMPLE_DOCS`` labelled documents outside the held-out fold, half of
them toxic where there are enough): a sentence's label is that of its document.
  1. Spans are counted by toxic and by clean documents. Those that toxic documents hold far more
     often than chance allows (log-likelihood) are the positive examples, the strongest of them
     landmarks.
  2. Spans of clean documents are the negative examples: the most frequent ones, also landmarks,
     and those most similar to the positive landmarks.
  3. Nyström features K(x, L) K(L, L)^(-1/2) train a squared-hinge machine. As the features are
     linear in K(x, L), the machine folds into one weight per subsequence.
  4. Labels, best decision values and numbers of toxic spans of the sampled documents give the
     probability (logistic regression, weighted to the true share of toxic documents).

Defined cases: null or empty text has no span and gets the probability of a text without
signal; without labels, or with labels of one kind, all texts get the share of toxic labels (0
without labels); several labels of one document count as toxic if one is; repeated rows each
give a row; a null id is not held out.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import fold, id_and_text, map_arrow, small_batches, table, text_bytes, written
from seriesloom.llm.linear import logistic, sigmoid, svm
from seriesloom.llm.registry import query

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SAMPLE_DOCS = 4000
LANDMARKS = 192
POSITIVES, NEGATIVES = 600, 2400
LENGTH = 4
DECAY = 0.6
SPAN, STEP = 24, 8
LONG = 14
#: Places between the first and the last letter of a subsequence: no limit.
STRETCH = float("inf")
#: Decisions are told apart down to here, and a text without a span has this one.
FLOOR = -3.0
CACHE = 200_000

#: Marks of a span's start and end; these bytes occur in no UTF-8 text.
START, END = b"\xfe", b"\xff"
#: Classes of bytes: 1-26 the letters, 27-29 bytes of other letters, 30 and 31 the marks, 0 what matches nothing.
BYTE_CLASS = np.array([b - 0x60 if 0x61 <= b <= 0x7A else b - 0x40 if 0x41 <= b <= 0x5A else
                       30 if b == 0xFE else 31 if b == 0xFF else
                       27 + b % 3 if b >= 0x80 else 0 for b in range(256)], dtype=np.uint8)
SINGLES = re.compile(rb"(?<!\S)\S(?:[ \t]\S){3,}(?!\S)")
WIDE = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
MATCHING = re.compile(rb"[A-Za-z\x80-\xff]")


def spans(text: bytes) -> set[bytes]:
    """Distinct words of a text, and its runs of single characters joined."""
    lower = text.lower()
    found = set(lower.split())
    for run in SINGLES.findall(lower):
        found.add(b"".join(run.split()))
    return found


@functools.lru_cache(maxsize=1 << 16)
def _letter_or_gap(character: bytes) -> bytes:
    """A letter outside ASCII (or a vowel sign) as it is, any other character as one byte that matches nothing."""
    one = character.decode("utf-8", "replace")
    sign = (unicodedata.category(one) in ("Mn", "Mc") and not unicodedata.combining(one) and one != "\u034f"
            and "VARIATION SELECTOR" not in unicodedata.name(one, ""))
    return character if one.isalpha() or sign else b"\0"


def single_gaps(string: bytes) -> bytes:
    """The string with one byte for each character that is no letter."""
    return string if string.isascii() else WIDE.sub(lambda found: _letter_or_gap(found.group()), string)


def stretches(span: bytes) -> list[bytes]:
    """The span between its marks, or its overlapping stretches of SPAN letters."""
    marked = START + single_gaps(span) + END
    if len(marked) <= SPAN + 2:
        return [marked]
    places = [found.start() for found in MATCHING.finditer(marked)]
    if len(places) <= SPAN + 2:
        return [marked]
    last = len(places) - SPAN
    return [marked[places[at]:places[at + SPAN - 1] + 1] for at in [*range(0, last, STEP), last]]


def _by_letters(strings: list[bytes], most: int, cut: bool = False):
    """(rows, classes of the letters, their places), both as arrays of letters x rows, for each number of letters;
    at most ``most`` rows each time. Strings of fewer letters than a subsequence has are left out.
    ``cut`` strings come from ``stretches`` and have one byte for each gap already."""
    strings = strings if cut else [single_gaps(string) for string in strings]
    lengths = np.array([len(string) for string in strings], dtype=np.int64)
    classes = BYTE_CLASS[np.frombuffer(b"".join(strings), dtype=np.uint8)].astype(np.int32)
    owner = np.repeat(np.arange(len(strings)), lengths)
    place = np.arange(len(classes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = classes > 0
    owner, place, classes = owner[letters], place[letters], classes[letters]
    sizes = np.bincount(owner, minlength=len(strings))
    start = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes >= LENGTH]):
        every = np.flatnonzero(sizes == size)
        for first in range(0, len(every), most):
            rows = every[first:first + most]
            at = start[rows] + np.arange(size)[:, None]
            yield rows, classes[at], place[at]


def codes(classes: np.ndarray):
    """(first letter, third letter, codes of the subsequences that end with each letter after the third)."""
    for i in range(len(classes) - 3):
        for j in range(i + 1, len(classes) - 2):
            two = (classes[i] * 32 + classes[j]) * 32
            for k in range(j + 1, len(classes) - 1):
                yield i, k, (two + classes[k]) * 32 + classes[k + 1:]


#: DECAY^l; the last one is zero in double precision, as all that follow.
POWERS = DECAY ** np.arange(1500.0)


def reach(place: np.ndarray, first: int) -> np.ndarray:
    """Weight of a subsequence from letter ``first`` to each letter from the fourth on."""
    return POWERS.take(place[first + LENGTH - 1:] - (place[first] - 1), mode="clip")


def self_kernel(strings: list[bytes], cut: bool = False) -> np.ndarray:
    """K(x, x) of each string by the gap-weighted recursion over pairs of equal letters."""
    out = np.zeros(len(strings))
    for rows, classes, place in _by_letters(strings, 2048, cut):
        letters, at = classes.T, place.T
        same = (letters[:, :, None] == letters[:, None, :]).astype(np.float64)
        apart = at[:, :, None] - at[:, None, :]
        onward = np.where(apart > 0, POWERS.take(apart, mode="clip"), 0.0)
        back, ending = onward.transpose(0, 2, 1), DECAY ** 2 * same
        for _ in range(LENGTH - 1):
            ending = same * (onward @ ending @ back)
        out[rows] = ending.sum(axis=(1, 2))
    return out


def least_norm(strings: list[bytes], cut: bool = False) -> np.ndarray:
    """Weight of the closest four letters of each string; the norm is at least that."""
    out = np.zeros(len(strings))
    for rows, _, place in _by_letters(strings, 1 << 16, cut):
        out[rows] = POWERS.take((place[LENGTH - 1:] - place[:1 - LENGTH]).min(axis=0) + 1, mode="clip")
    return out


def profile(string: bytes) -> dict[int, float]:
    """The explicit feature vector of a short string."""
    out: dict[int, float] = {}
    for _, classes, place in _by_letters([string], 1):
        for first, third, found in codes(classes):
            for code, value in zip(found[:, 0].tolist(), reach(place, first)[third - first - 2:, 0].tolist()):
                out[code] = out.get(code, 0.0) + value
    return out


@functools.lru_cache(maxsize=64)
def quadruples(size: int) -> np.ndarray:
    """The places of all subsequences of so many letters: four rows."""
    return np.array(list(itertools.combinations(range(size), LENGTH)), dtype=np.int16).T


def dot(strings: list[bytes], weights: np.ndarray, cut: bool = False) -> np.ndarray:
    """Product of each string's feature vector with a weight per code."""
    out = np.zeros(len(strings))
    for rows, classes, place in _by_letters(strings, 2048, cut):
        if LONG < len(classes) <= SPAN + 2:  # few strings have so many letters: all subsequences at once
            a, b, c, d = quadruples(len(classes))
            some = max(1, (1 << 19) // len(a))
            for first in range(0, len(rows), some):
                letters, at = classes[:, first:first + some], place[:, first:first + some]
                found = ((letters[a] * 32 + letters[b]) * 32 + letters[c]) * 32 + letters[d]
                out[rows[first:first + some]] = (weights.take(found) * POWERS.take(at[d] - at[a] + 1, mode="clip")).sum(axis=0)
            continue
        sums = np.zeros((len(classes) - 3, *classes.shape), dtype=np.float32)
        for first, third, found in codes(classes):
            sums[first, third + 1:] += weights.take(found)
        for first in range(len(sums)):
            out[rows] += (reach(place, first) * sums[first, first + LENGTH - 1:]).sum(axis=0)
    return out


class Landmarks:
    """Normalised feature vectors of some strings, by the few codes that occur in them."""

    def __init__(self, strings: list[bytes]):
        profiles = [profile(string) for string in strings]
        used = sorted(set().union(*profiles))
        place = {code: k + 1 for k, code in enumerate(used)}
        self.row = np.zeros(32 ** LENGTH, dtype=np.int32)
        self.row[used] = np.arange(1, len(used) + 1)
        self.vectors = np.zeros((len(used) + 1, len(strings)), dtype=np.float32)
        for column, whole in enumerate(profiles):
            norm = np.sqrt(sum(x * x for x in whole.values())) or 1.0
            for code, weight in whole.items():
                self.vectors[place[code], column] = weight / norm

    def similarity(self, strings: list[bytes]) -> np.ndarray:
        """Normalised kernel of strings (rows) and landmarks (columns)."""
        out = np.zeros((len(strings), self.vectors.shape[1]))
        for rows, classes, place in _by_letters(strings, 2048):
            total = np.zeros((len(rows), out.shape[1]), dtype=np.float32)
            weight = [reach(place, first).astype(np.float32) for first in range(len(place) - LENGTH + 1)]
            for first, third, found in codes(classes):
                at = self.row.take(found)
                for last in np.flatnonzero(at.any(axis=1)):
                    hit = np.flatnonzero(at[last])
                    total[hit] += weight[first][third - first - 2 + last, hit][:, None] * self.vectors[at[last, hit]]
            out[rows] = total
        norms = np.sqrt(np.maximum(self_kernel(strings), 1e-300))
        return out / norms[:, None]


def document_signs(best: np.ndarray, hits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Best decision, and the number of toxic spans seen against the number of spans read."""
    best = np.clip(best, -3, 3)
    return np.column_stack([best, np.maximum(best, 0), np.log1p(hits), np.log1p(size) * (hits > 0), np.ones(len(best))])


class Model:
    """Folded machine: a weight for each subsequence, and a logistic curve over the best span."""

    def __init__(self, codes: np.ndarray, values: np.ndarray, bias: float, curve: tuple[float, ...], share: float):
        self.codes, self.values, self.bias, self.curve, self.share = codes, values, bias, curve, share
        self._weights: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_weights": None}

    def decisions(self, strings: list[bytes], cut: bool = False, above_bias: bool = False) -> np.ndarray:
        """Decision value of each string, and FLOOR for those that lie below it.

        ``above_bias`` leaves out (NaN) the strings whose decision does not exceed the bias; they need no norm to be known."""
        if self._weights is None:
            self._weights = np.zeros(32 ** LENGTH, dtype=np.float32)
            self._weights[self.codes] = self.values
        raw = dot(strings, self._weights, cut)
        out = np.full(len(strings), np.nan if above_bias else FLOOR)
        rows = np.flatnonzero(raw > 0) if above_bias else np.arange(len(strings))
        if not above_bias and self.bias <= FLOOR:  # then a negative product lies below FLOOR, and few others need the norm in full
            rows = np.flatnonzero(raw > 0)
            rows = rows[raw[rows] > (FLOOR - self.bias) * least_norm([strings[k] for k in rows], cut)]
        norms = np.sqrt(np.maximum(self_kernel([strings[k] for k in rows], cut), 1e-300))
        out[rows] = np.maximum(raw[rows] / norms + self.bias, FLOOR)
        return out

    def probability(self, best: np.ndarray, hits: np.ndarray, size: np.ndarray) -> np.ndarray:
        return sigmoid(document_signs(best, hits, size) @ np.array(self.curve))


def sampled_texts(docs: DataFrame, labels: DataFrame, sample_docs: int) -> tuple[DataFrame, float]:
    """Texts and labels of the bounded sample, and the true share of toxic labels."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sizes = {row.toxic: row.n for row in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    place, parts = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)), 1_000_000
    limit = {value: int(min(1.0, sample_docs / 2 / n) * parts) + 1 for value, n in sizes.items()}
    kept = marks.filter(place < F.coalesce(*[F.when(F.col("toxic") == v, F.lit(n)) for v, n in limit.items()], F.lit(0)))
    ids = docs.sparkSession.createDataFrame([(row.doc_id, row.toxic) for row in kept.toLocalIterator()],
                                            "doc_id long, toxic int")  # about sample_docs rows
    return (id_and_text(docs).join(F.broadcast(ids), "doc_id").filter(F.col("text").isNotNull()),
            sizes.get(1, 0) / total if total else 0.0)


def counted_spans(sample: DataFrame) -> DataFrame:
    """span (a stretch with marks), t and c: toxic and clean documents of the sample that hold it."""
    def cut(batches):
        for batch in small_batches(batches):
            strings, marks = [], []
            for text, toxic in zip(text_bytes(batch.column("text")), batch.column("toxic").to_pylist()):
                found = {x for span in spans(text) for x in stretches(span)}
                strings += found
                marks += [toxic] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary()), pa.array(marks, pa.int32())],
                                             ["span", "toxic"])

    return map_arrow(sample, cut, "span binary, toxic int").groupBy("span").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))


def most_similar(counted: DataFrame, positive: list[bytes], most: int) -> list[tuple[bytes, int]]:
    """(span, clean documents) of the spans most similar to a positive landmark."""
    def near(batches):
        landmarks = Landmarks(positive)
        for batch in batches:
            strings = [bytes(x) for x in batch.column("span").to_pylist()]
            close = [landmarks.similarity(strings[k:k + 2048]).max(axis=1) for k in range(0, len(strings), 2048)]
            if strings:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("span"), batch.column("c"), pa.array(np.concatenate(close), pa.float64())],
                    ["span", "c", "near"])

    ranked = map_arrow(counted.select("span", "c"), near, "span binary, c long, near double")
    rows = ranked.orderBy(F.desc(F.col("near") * F.log1p("c")), "span").limit(most).collect()
    return [(bytes(row.span), row.c) for row in rows]


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, landmarks: int = LANDMARKS) -> Model:
    texts, share = sampled_texts(docs, labels, sample_docs)
    prior = float(np.log(share / (1 - share))) if 0 < share < 1 else (40.0 if share else -40.0)
    nothing = Model(np.zeros(0, dtype=int), np.zeros(0), 0.0, (0.0, 0.0, 0.0, 0.0, prior), share)
    if not 0 < share < 1:
        return nothing
    sample = written(texts, "labelled")
    sizes = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return nothing
    counted = written(counted_spans(sample), "spans").filter(F.octet_length("span") > LENGTH)
    expected = (F.col("t") + F.col("c")) * (toxic / (toxic + clean))
    evidence = F.col("t") * F.log(F.col("t") / expected) - (F.col("t") - expected)
    # Much more frequent in toxic documents: eight times, as far as the clean ones can tell.
    telling = (F.col("t") >= 2) & (F.col("t") / toxic > 8 * F.greatest(F.col("c") - 1, F.lit(0)) / clean) & (
        F.col("t") / toxic > 3 * F.col("c") / clean)
    found = [(bytes(row.span), row.t, row.e) for row in counted.filter(telling).select("span", "t", evidence.alias("e"))
             .orderBy(F.desc("e"), "span").limit(POSITIVES).collect()]
    chance = np.log(toxic + clean)  # of many spans some stand out by chance; the strongest must stand above that
    positive = [(span, t) for span, t, e in found if e > chance and profile(span)]
    positive = positive or [(span, t) for span, t, _ in found[:8] if profile(span)]
    if not positive:
        return nothing
    marks = [span for span, _ in positive[:landmarks // 2]]
    usual = counted.filter((F.col("c") >= 1) & (F.col("t") / toxic <= 2 * F.col("c") / clean))
    common = [(bytes(row.span), row.c) for row in
              usual.orderBy(F.desc("c"), "span").limit(NEGATIVES // 4).collect() if profile(bytes(row.span))]
    hard = most_similar(usual, marks, NEGATIVES * 3 // 4)
    points = list(dict.fromkeys(marks + [x for x, _ in common[:landmarks // 8]] + [x for x, _ in hard[:landmarks * 3 // 8]]))
    negative = sorted({**dict(common), **dict(hard)}.items())
    strings = [span for span, _ in positive + negative]
    marked = Landmarks(points)
    values, vectors = np.linalg.eigh(marked.similarity(points))
    keep = values > 1e-6
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.hstack([marked.similarity(strings) @ root, np.ones((len(strings), 1))])
    target = np.where(np.arange(len(strings)) < len(positive), 1.0, -1.0)
    held_by = np.array([n for _, n in positive + negative], dtype=float)
    side = np.where(target > 0, held_by[target > 0].sum(), held_by[target < 0].sum())
    weights = svm(mapped, target, 10 * len(strings) * held_by / side)
    folded = root @ weights[:-1]
    total: dict[int, float] = {}
    for landmark, factor in zip(points, folded):
        whole = profile(landmark)
        norm = np.sqrt(sum(x * x for x in whole.values()))
        for code, weight in whole.items():
            total[code] = total.get(code, 0.0) + factor * weight / norm
    codes = np.array(sorted(total), dtype=np.int64)
    model = Model(codes, np.array([total[c] for c in codes], dtype=np.float32), float(weights[-1]), (1.0, 0.0, 0.0, 0.0, 0.0), share)
    seen = score_texts(sample, model, "toxic").select("toxic", "decision", "hits", "n_spans").toPandas()  # sample_docs rows
    target = seen["toxic"].to_numpy(dtype=float)
    balance = np.where(target > 0, share / target.mean(), (1 - share) / (1 - target.mean()))
    features = document_signs(seen["decision"].to_numpy(), seen["hits"].to_numpy(), seen["n_spans"].to_numpy())
    model.curve = tuple(float(x) for x in logistic(features, target, balance, penalty=0.05))
    return model


class TextScorer:
    """Scores texts with a model; decisions of words are kept from batch to batch, up to CACHE words."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def decide(self, words: list[bytes], pieces: list[list[bytes]], above_bias: bool) -> None:
        decided = self.model.decisions([x for some in pieces for x in some], True, above_bias)
        starts = np.cumsum([0, *[len(some) for some in pieces]])[:-1]
        self.cache.update(zip(words, np.fmax.reduceat(decided, starts).tolist()))

    def __call__(self, texts: list[bytes]) -> dict[str, list | np.ndarray]:
        """score, decision, hits, n_spans, worst_span of each text."""
        cache, found = self.cache, [spans(text) for text in texts]
        fresh = sorted(set().union(*found).difference(cache))
        if len(cache) + len(fresh) > CACHE:
            cache.clear()
            fresh = sorted(set().union(*found))
        for first in range(0, len(fresh), 20_000):
            part = fresh[first:first + 20_000]
            pieces = [stretches(x) for x in part]
            self.decide(part, pieces, above_bias=True)
        # The worst span decides, so the others' exact values matter only where no span lies above the bias.
        quiet = sorted(set().union(*[some for some in found if some and all(cache[x] != cache[x] for x in some)]))
        for first in range(0, len(quiet), 20_000):
            part = quiet[first:first + 20_000]
            self.decide(part, [stretches(x) for x in part], above_bias=False)
        best, worst, hits = [], [], []
        for some in found:
            values = [cache[x] for x in some]
            top = max([value for value in values if value == value], default=FLOOR)
            best.append(top)
            hits.append(sum([value > 0 for value in values]))
            worst.append(min((x for x, value in zip(some, values) if value == top), default=None))
        size = np.array([len(some) for some in found])
        return {"score": self.model.probability(np.array(best), np.array(hits), size), "decision": best, "hits": hits,
                "n_spans": size, "worst_span": [None if x is None else x.decode("utf-8", "replace") for x in worst]}


def score_texts(docs: DataFrame, model: Model, *kept: str) -> DataFrame:
    """doc_id, score (probability that the text is toxic), decision (of the worst span), hits (spans with a
    positive decision), n_spans, worst_span, and the columns ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]

    def score(batches):
        scorer = TextScorer(shared.value)
        for batch in small_batches(batches, most_bytes=2 << 20):
            found = scorer(text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(values, kind) for values, kind in zip(found.values(), kinds)],
                 *[batch.column(name) for name in kept]], ["doc_id", *found, *kept])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *kept)
    extra = "".join(f", {name} {kind}" for name, kind in columns.dtypes[2:])
    return map_arrow(columns, score, "doc_id long, score double, decision double, hits long, n_spans long, "
                                     "worst_span string" + extra)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches):
        scorer = TextScorer(shared.value)
        for batch in small_batches(batches, most_bytes=2 << 20):
            yield batch.filter(pa.array(scorer(text_bytes(batch.column("text")))["score"] < threshold))

    return map_arrow(docs, clean, docs.schema)


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "worst_span")
