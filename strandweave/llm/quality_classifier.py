"""Quality scores by votes of the nearest labelled documents in a latent-semantic space.

Documents become vectors of hashed words and word shapes (case, symbols, closing marks, stutter), weighted by the
inverse document frequency and projected on the main directions of a sample of labelled documents (truncated singular
value decomposition). The vectors of the sample and their labels are sent to all tasks: at most ``MAX_LABELLED`` of
them, about 1.5 MB. Each block of documents is multiplied with all of them, and the ``NEIGHBOURS`` nearest vote with
their cosine (rounded to ``GRID``; of equally near ones those with the smaller doc_ids); the votes of a label are weighted
by the inverse of its frequency, so that rare labels count as much.

The sample is the labelled documents with the least hash of the id, out of the rows the caller lets in: a bounded fit,
while every document is scored in full. Null and empty texts get the vector of "no words" and a score like all others.
A text has to fit into a task. Each row of the input gets one row of output, whether its doc_id is missing, repeated or neither. An empty table gives an
empty result. Other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import documents
from .substring_dedup import _TABLE, word_spans

WORD_DIMS, SHAPE_DIMS, LATENT = 1024, 128, 48
MAX_LABELLED, NEIGHBOURS, SHARPNESS = 3000, 25, 8.0
THRESHOLD = 0.7
#: Steps of a cosine.
GRID = 1 << 20


def _class_table() -> np.ndarray:
    """Bits of a byte: capital, small or other letter, digit, symbol, closing mark."""
    table = np.zeros(256, np.uint8)
    table[65:91] = 1
    table[97:123] = table[128:] = 2
    table[48:58] = 4
    table[list(b"#*$%&|<>")] = 8
    table[list(b"!?")] = 16
    return table


_CLASS = _class_table()


def vectors(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Term frequencies of hashed words, and shares of word shapes, of each document (float32)."""
    start, end, units = word_spans(data, bounds)
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(units))
    names = R.Hasher(_TABLE[data])(start, end)
    out = np.zeros((n, WORD_DIMS + SHAPE_DIMS), np.float32)
    count = np.bincount(doc * WORD_DIMS + (names % R.U(WORD_DIMS)).astype(np.int64), minlength=n * WORD_DIMS).reshape(n, -1)
    out[:, :WORD_DIMS] = np.log1p(count)
    shape = np.zeros(len(start), np.int64)
    for k in range(5):
        sums = np.concatenate([[0], np.cumsum((_CLASS[data] >> k) & 1, dtype=np.int64)])
        shape |= np.minimum(sums[end] - sums[start], 1) << k
    stutter = np.zeros(len(start), bool)
    stutter[1:] = (names[1:] == names[:-1]) & (doc[1:] == doc[:-1])
    shape |= stutter.astype(np.int64) << 5
    # Words that the document has had before, by hashed name within the document.
    order = np.lexsort((np.arange(len(names)), names, doc))
    again = np.zeros(len(start), bool)
    again[order[1:]] = (names[order][1:] == names[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    long = (end - start) >= 6
    shape |= (again & long).astype(np.int64) << 6
    shares = np.bincount(doc * SHAPE_DIMS + shape, minlength=n * SHAPE_DIMS).reshape(n, -1) / np.maximum(np.diff(units), 1)[:, None]
    out[:, WORD_DIMS:] = np.sqrt(shares)
    return out


class Model:
    """Weights, projection, and the labelled vectors (unit length) with their votes."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        words = counts[:, :WORD_DIMS]
        self.idf = np.log((1 + len(counts)) / (1 + (words > 0).sum(0))).astype(np.float32) + 1
        flat = self._weighted(counts)
        self.mean = flat.mean(0)
        flat = flat - self.mean
        # The right singular vectors of the sample are the eigenvectors of its Gram matrix; the last are the largest.
        self.axes = np.linalg.eigh(flat.T @ flat)[1][:, : -LATENT - 1 : -1].astype(np.float32)
        self.points = self._unit(flat @ self.axes)
        self.labels = labels.astype(np.float32)
        share = labels.mean()
        self.votes = np.where(labels > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        words = counts[:, :WORD_DIMS] * self.idf
        words = 0.4 * words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)
        return np.hstack([words, 1.6 * counts[:, WORD_DIMS:]])

    @staticmethod
    def _unit(points: np.ndarray) -> np.ndarray:
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Between 0 and 1: the weighted share of label 1 among the nearest labelled vectors, all compared exactly."""
        points = self._unit((self._weighted(counts) - self.mean) @ self.axes)
        cosine = points @ self.points.T
        k = min(NEIGHBOURS, cosine.shape[1])
        # Products of blocks of other shapes differ in their last bits; a place in the order makes the nearest a matter of course.
        steps = np.rint(cosine * GRID).astype(np.int64)
        ranked = np.arange(cosine.shape[1]) - steps * cosine.shape[1]
        near = np.argpartition(ranked, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(steps, near, 1) / GRID, 0) ** SHARPNESS * self.votes[near] + 1e-9
        return ((weight * self.labels[near]).sum(1) / weight.sum(1)).astype(np.float64).clip(0, 1)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Fit on ``docs(doc_id, text)`` with at most ``limit`` of the ``labels(doc_id, label)``.

    Null labels are left out; of several labels of one document the larger counts. Only the chosen labels, ``limit``
    rows, are sent to the documents; labels of absent documents don't count. Without any label, every text will score 0.5. Of several texts with one labelled
    doc_id that with the least hash is learnt from.
    """
    chosen = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), pa.array([v.tobytes() for v in vectors(data, bounds)], pa.binary())], names=["doc_id", "label", "vector"])

    taught = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    taught = taught.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    found = taught.select("doc_id", "text", F.col("label").cast("int")).mapInArrow(of, "doc_id long, label int, vector binary").orderBy("doc_id", "label").collect()
    if not found:
        return Model(np.zeros((1, WORD_DIMS + SHAPE_DIMS), np.float32), np.array([0.5]))
    return Model(np.frombuffer(b"".join(r.vector for r in found), np.float32).reshape(len(found), -1), np.array([r.label for r in found]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs(doc_id, text)``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(batch):
                scores = np.concatenate([held.value.score(block) for block in np.array_split(vectors(data, bounds), -(-(high - low) // 512))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, score double")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Rows without a doc_id are not held out (and have no label)."""
    docs = documents(spark, sf_dir)
    fold = lambda c: F.crc32(c.cast("string").cast("binary")) % 4
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id")) != 2).select("doc_id", F.col("quality").alias("label"))
    model = fit(docs, labels)
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
