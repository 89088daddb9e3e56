"""Quality classifier by nearest-neighbour voting in a latent semantic space.

A text is a hashed bag of its words, of the shapes of its words, and of how it repeats itself.  A truncated singular value
decomposition of a bounded labelled sample gives the latent space; the sample's vectors and labels are broadcast, every document
meets all of them in blocked exact cosine products, and its nearest neighbours vote, weighted by similarity.

Bounds, for tables of any size: the sample holds ``PER_CLASS`` documents of each class, its bags ``WIDTH`` numbers each (75 MB on
the driver), and 2.2 MB are broadcast.  Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import is_held_out, labelled_sample, read

#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 2000
WORD_BUCKETS, SHAPE_BUCKETS, HABITS = 4096, 512, 6
WIDTH = WORD_BUCKETS + SHAPE_BUCKETS + HABITS
LATENT = 64
NEIGHBOURS = 15
SHARPNESS = 8
BLOCK = 256
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

_SHAPE = bytes(
    65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 97 if 97 <= c <= 122 or c > 127 else c for c in range(256)
)
_RUN = re.compile(rb"([Aa0])\1+")


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a whole text's bag, a unit vector; both empty for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    n, counts = len(words), Counter(words)
    times = np.fromiter(counts.values(), np.float64, len(counts))
    place = np.fromiter((zlib.crc32(w) % WORD_BUCKETS for w in counts), np.int64, len(counts))
    word = np.bincount(place, np.log1p(times), WORD_BUCKETS)
    forms: Counter[bytes] = Counter()
    for w, k in counts.items():
        forms[w.translate(_SHAPE)] += k
    shapes: Counter[bytes] = Counter()
    for f, k in forms.items():
        shapes[_RUN.sub(rb"\1", f)] += k
    shape = np.zeros(SHAPE_BUCKETS)
    for f, k in shapes.items():
        shape[zlib.crc32(f) % SHAPE_BUCKETS] += k
    often = np.sort(times)[::-1]
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    habits = np.sqrt([
        same / n, 1 - len(counts) / n, often[0] / n, often[:10].sum() / n, (often[1:] * (often[1:] > 2)).sum() / n, min(1.0, 20 / n),
    ])
    parts = [0.6 * word / np.linalg.norm(word), 1.2 * np.sqrt(shape / n), habits]
    whole = np.concatenate(parts)
    whole /= np.linalg.norm(whole)
    at = np.flatnonzero(whole)
    return at.astype(np.int32), whole[at].astype(np.float32)


def bags(rows: DataFrame) -> DataFrame:
    """(at, value, label) of (text, label) rows."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag(t.as_py()) for t in batch.column(0)]
            at, value = pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([at, value, batch.column(1)], ["at", "value", "label"])

    return rows.select("text", "label").mapInArrow(made, "at array<int>, value array<float>, label int")


def latent_space(sample: np.ndarray, latent: int = LATENT, seed: int = 7) -> np.ndarray:
    """The right singular vectors of the largest singular values, by subspace iteration."""
    rank = min(latent, *sample.shape)
    base = np.random.default_rng(seed).standard_normal((sample.shape[1], rank + 16)).astype(np.float32)
    for _ in range(4):
        base = np.linalg.qr(sample.T @ np.linalg.qr(sample @ base)[0])[0]
    vectors = np.linalg.svd(sample @ base, full_matrices=False)[2][:rank]
    return np.ascontiguousarray((base @ vectors.T).astype(np.float32))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Space (WIDTH x latent), sample vectors and sample labels; empty arrays without any labelled text that has words."""
    rows = bags(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, per_class)).where(F.size("at") > 0).toArrow()
    sample = np.zeros((rows.num_rows, WIDTH), np.float32)
    for k, (at, value) in enumerate(zip(rows["at"], rows["value"])):
        sample[k, at.values.to_numpy()] = value.values.to_numpy()
    votes = rows["label"].to_numpy().astype(np.float32)
    if not len(votes):
        return np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), votes
    # A fixed order, whatever order the rows came in.
    order = np.lexsort((votes, *[sample @ np.random.default_rng(k).standard_normal(WIDTH).astype(np.float32) for k in range(2)]))
    sample, votes = sample[order], votes[order]
    space = latent_space(sample)
    return space, unit(sample @ space).astype(np.float32), votes


def vote(vectors: np.ndarray, sample: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """Mean label of the nearest neighbours, weighted by a power of the similarity; without any, the sample's mean.

    Of equally near neighbours those that come first in the sample vote.
    """
    if not len(votes):
        return np.full(len(vectors), 0.5)
    near = np.maximum(vectors @ sample.T, 0)
    k = min(NEIGHBOURS, len(votes))
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    worst = np.take_along_axis(near, best, 1).min(axis=1)
    for row in np.flatnonzero((near >= worst[:, None]).sum(axis=1) > k):
        best[row] = np.argsort(-near[row], kind="stable")[:k]
    weight = np.take_along_axis(near, best, 1).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight * votes[best]).sum(axis=1) / np.where(total > 0, total, 1), votes.mean())


def with_scores(docs: DataFrame, model: tuple, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the score of each row's whole text; a column named ``out`` is replaced.

    Defined cases: a null, empty or blank text has no direction and gets the mean label of the sample (half with no sample);
    repeated rows get equal scores; an empty table gives no rows; no column but the text is read.
    """
    kept = [c for c in docs.columns if c != out]
    wide = docs.select(*[F.col(f"`{c}`") for c in kept])
    space, sample, votes = model
    shared, place = docs.sparkSession.sparkContext.broadcast(model), kept.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sample, votes = shared.value
        for batch in batches:
            scores = []
            for start in range(0, batch.num_rows, BLOCK):
                texts = batch.column(place).slice(start, BLOCK)
                vectors = np.zeros((len(texts), space.shape[1]), np.float32)
                for k, text in enumerate(texts):
                    at, value = bag(text.as_py())
                    if len(at):
                        vectors[k] = value @ space[at]
                scores.append(vote(unit(vectors), sample, votes))
            column = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*kept, out])

    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0.0).alias(out)).schema
    return wide.mapInArrow(scored, schema)


def op6_latent_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_scores(docs, fit(docs, read(spark, sf_dir, "labels")), out="score")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
