"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams (with marks for its ends) and of itself as a whole, a passage the mean
of its words, and a linear softmax over that mean gives the score.  A misspelling shares most n-grams with the word it hides, so it
gets much of its vector without having been seen.  Passages have ``PASSAGE`` words and overlap by half; a text is as toxic as its
worst one, so that a long clean text cannot dilute a word.  Labels are of texts, so training goes in stages: whole texts first, then
the passages that the last stage finds worst, few of a toxic text (some of its passages are clean) and many of a clean one (all
are).  A fifth of the sample is left out of that and sets the scale and offset of the softmax.

Bounds, for tables of any size: training reads ``PER_CLASS`` labelled texts of each class, the embeddings are ``BUCKETS`` x
``WIDTH`` numbers, and what is broadcast is one number a bucket (1 MB): under a linear softmax of means a word counts by one number.
Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import is_held_out, labelled_sample, read

#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 1000
BUCKETS = 1 << 18
MASK = BUCKETS - 1
WIDTH = 8
GRAMS = (3, 4, 5)
#: Characters of a word that are read at once.
LONGEST = 40
PASSAGE = 4
STAGES = 3
STEPS = 60
WORST_OF_TOXIC, WORST_OF_CLEAN = 4, 30
#: Bucket shares below this are not sped up further: what one text alone holds teaches little.
FLOOR = 1e-4
#: Words whose number a task remembers, in each of two generations; forgetting changes no score.
REMEMBERED = 1 << 18
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1


def words_of(text: str | None) -> list[str]:
    """Lower-case words; of a word repeated on end one is read, as saying it often makes it no other word.

    A word over ``LONGEST`` characters is read as half-overlapping pieces of that length, so that nothing in it is diluted.
    """
    words = [w for w, _ in groupby((text or "").lower().split())]
    if max(map(len, words), default=0) > LONGEST:
        step = LONGEST // 2
        words = [w[i : i + LONGEST] for w in words for i in (range(0, len(w) - step, step) if len(w) > LONGEST else (0,))]
    return words


def grams(word: str) -> list[int]:
    """Buckets of a word and its n-grams."""
    raw = f"<{word}>"
    if raw.isascii():  # bytes are characters then
        code = raw.encode()
        found = [zlib.crc32(code) & MASK]
        for n in GRAMS:
            found += [zlib.crc32(code[i : i + n]) & MASK for i in range(len(code) - n + 1)]
    else:
        found = [zlib.crc32(raw.encode("utf-8", "surrogatepass")) & MASK]
        for n in GRAMS:
            found += [zlib.crc32(raw[i : i + n].encode("utf-8", "surrogatepass")) & MASK for i in range(len(raw) - n + 1)]
    return found


class WordNumbers(dict):
    """What a word adds to the log-odds; a word that is not there is the mean of its n-grams."""

    def __init__(self, number: list[float], older: dict | None = None):
        self.number, self.older = number, older or {}

    def __missing__(self, word: str) -> float:
        value = self.older.get(word)
        if value is None:
            at = grams(word)
            value = sum(map(self.number.__getitem__, at)) / len(at)
        self[word] = value
        return value


def spans(n: int, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the half-overlapping passages of ``n`` words."""
    starts = np.arange(0, max(1, n - size // 2), size // 2)
    return starts, np.minimum(starts + size, n)


def passage_means(each: np.ndarray) -> np.ndarray:
    """Mean of ``each`` (one number per word) over every passage; zero without words."""
    if not len(each):
        return np.zeros(1)
    sums = np.concatenate([[0.0], np.cumsum(each)])
    starts, ends = spans(len(each))
    return (sums[ends] - sums[starts]) / (ends - starts)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def balanced(labels: np.ndarray) -> np.ndarray:
    """Weights that give each class a half."""
    ones = (labels == 1).sum()
    return np.where(labels == 1, 0.5 / max(ones, 1), 0.5 / max(len(labels) - ones, 1))


class Subwords:
    """Embeddings and softmax over the words of the training texts, fitted by gradient descent with momentum on both."""

    def __init__(self, texts: list[str], seed: int = 7):
        vocabulary: dict[str, int] = {}
        self.texts = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)], np.int64) for t in texts]
        of_word = [grams(w) for w in vocabulary]
        self.sizes = np.array([len(g) for g in of_word], np.int64)
        self.at = np.array([x for g in of_word for x in g], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        draw = np.random.default_rng(seed)
        self.embed = draw.standard_normal((BUCKETS, WIDTH)) * 0.01
        self.soft = draw.standard_normal((WIDTH, 2)) * 0.5
        self.bias = np.zeros(2)

    def bucket(self) -> np.ndarray:
        """What a bucket adds to the log-odds of the second class."""
        return self.embed @ (self.soft[:, 1] - self.soft[:, 0])

    def words(self, bucket: np.ndarray) -> np.ndarray:
        return np.add.reduceat(bucket[self.at], self.begin) / self.sizes if len(self.sizes) else np.zeros(0)

    def train(self, passages: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, steps: int) -> None:
        lengths = np.array([len(p) for p in passages], np.int64)
        word = np.concatenate(passages) if passages else np.zeros(0, np.int64)
        row, share = np.repeat(np.arange(len(passages)), lengths), np.repeat(1 / np.maximum(lengths, 1), lengths)

        def logits(bucket: np.ndarray) -> np.ndarray:
            return np.bincount(row, share * self.words(bucket)[word], len(passages))

        def pulled(delta: np.ndarray) -> np.ndarray:
            each = np.bincount(word, share * delta[row], len(self.sizes)) / self.sizes
            return np.bincount(self.at, np.repeat(each, self.sizes), BUCKETS)

        # Common buckets move less; the step is as long as the largest curvature allows.
        rate = 1 / (pulled(weight) + FLOOR)
        probe = np.random.default_rng(0).random(BUCKETS)
        for _ in range(6):
            bent = rate * pulled(0.25 * weight * logits(probe))
            largest = np.linalg.norm(bent) / np.linalg.norm(probe)
            probe = bent / max(np.linalg.norm(bent), 1e-300)
        step, speed, half = 1 / max(largest, 1e-12), np.zeros(BUCKETS), np.array([-0.5, 0.5])
        for _ in range(steps):
            toward = self.soft[:, 1] - self.soft[:, 0]
            delta = (sigmoid(logits(self.embed @ toward) + self.bias[1] - self.bias[0]) - labels) * weight
            pull = pulled(delta)
            turn = (self.embed.T @ pull)[:, None] * half[None, :]
            speed = 0.9 * speed - step * rate * pull
            self.embed += speed[:, None] * (toward / (toward @ toward))[None, :]
            self.soft -= 0.01 * turn
            self.bias -= delta.sum() * half

    def worst(self, of: np.ndarray, number: np.ndarray, most: int) -> list[np.ndarray]:
        means = passage_means(number[of])
        starts, ends = spans(len(of))
        return [of[starts[k] : ends[k]] for k in np.argsort(-means, kind="stable")[:most]]


def calibrated(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and offset that fit the logits of unseen texts to their labels, classes weighing alike."""
    middle, spread, weight = logits.mean(), logits.std() + 1e-9, balanced(labels)
    x, scale, offset = (logits - middle) / spread, 1.0, 0.0
    for _ in range(500):
        delta = (sigmoid(scale * x + offset) - labels) * weight
        scale -= 2 * ((delta * x).sum() + 1e-4 * scale)
        offset -= 2 * delta.sum()
    return scale / spread, offset - scale * middle / spread


def worst_logit(words: list[str], known: WordNumbers) -> float:
    return float(passage_means(np.fromiter(map(known.__getitem__, words), np.float64, len(words))).max())


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """(number per bucket, offset): what a bucket adds to a word's log-odds, and the log-odds of none."""
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(BUCKETS), float(0 if not len(labels) else 20 * labels[0] - 10)
    unseen = np.zeros(len(labels), bool)
    for c in (0, 1):  # a fifth of each class that has five texts or more
        unseen[np.flatnonzero(labels == c)[4::5]] = True
    fitted = np.flatnonzero(~unseen)
    model, classes = Subwords([texts[i] for i in fitted], seed), labels[fitted]
    weight = balanced(classes)
    model.train(model.texts, classes, weight, STEPS)
    for _ in range(STAGES):
        number, parts, part_labels, part_weight = model.words(model.bucket()), [], [], []
        for of, c, w in zip(model.texts, classes, weight):
            found = model.worst(of, number, WORST_OF_TOXIC if c else WORST_OF_CLEAN)
            parts += found
            part_labels += [c] * len(found)
            part_weight += [w / len(found)] * len(found)
        model.train(parts, np.array(part_labels), np.array(part_weight), STEPS)
    number = model.bucket()
    judged = np.flatnonzero(unseen) if len(set(labels[unseen])) == 2 else fitted
    known = WordNumbers(number.tolist())
    logits = np.array([worst_logit(words_of(texts[i]), known) for i in judged])
    scale, offset = calibrated(logits, labels[judged])
    return number * scale, offset


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, per_class).toArrow().sort_by("doc_id")
    number, offset = train(sample["text"].to_pylist(), sample["label"].to_numpy().astype(np.float64))
    return number.astype(np.float32), offset


def with_scores(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out: str = "toxic_score") -> DataFrame:
    """``docs`` with the score of each row's whole text; a column named ``out`` is replaced.

    Defined cases: a null, empty or blank text has no words and gets the softmax of the offset; with labels of one
    class only that class is certain, with none all scores are one half; repeated rows get equal scores; an empty table gives no
    rows; no column but the text is read.
    """
    kept = [c for c in docs.columns if c != out]
    wide = docs.select(*[F.col(f"`{c}`") for c in kept])
    shared, place = docs.sparkSession.sparkContext.broadcast(model), kept.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, offset = shared.value
        known = WordNumbers(number.tolist())

        def score(text: str | None) -> float:
            nonlocal known
            if len(known) > REMEMBERED:
                known.older = {}
                known = WordNumbers(known.number, known)
            return float(sigmoid(worst_logit(words_of(text), known) + offset))

        for batch in batches:
            column = pa.array([score(t.as_py()) for t in batch.column(place)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*kept, out])

    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0.0).alias(out)).schema
    return wide.mapInArrow(scored, schema)


def op7_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_scores(docs, fit(docs, read(spark, sf_dir, "labels")), out="score")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
