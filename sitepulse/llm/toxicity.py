"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its words, pairs and triples of neighbours, and pairs with one or two words
between them, each hashed into 2^20 places. Training walks over the labelled texts one by one with
a learning rate of its own for each place; the L1 term keeps most weights at exactly zero, so the
model is a short list of places and weights that goes to every task. The number of training texts
is bounded by ``sample`` (the smallest hashes of ``doc_id`` among the documents that have a label) and
the number of their n-grams by ``SAMPLE_PLACES``, which bounds the single task that trains. Every
text is scored whole, with weights sent as the list of those that are not zero.

Defined cases: a null or empty text has the score of the intercept alone; rows without a label or
with a null one do not train; a document with several label rows takes the largest; a label row
without a document is ignored; without any label every score is 0.5; rows repeated with one
``doc_id`` are scored each; a null ``doc_id`` never trains and counts as not held out; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitepulse.llm.common import stored, table

PLACES_LOG2 = 20
SAMPLE = 24_000
SAMPLE_PLACES = 100_000_000  # n-grams of all training texts together: 400 MB
THRESHOLD = 0.7
EPOCHS = 8
_WORD = re.compile(r"\w+")
_U = np.uint64
_SALTS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                          0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def features(text: str | None) -> np.ndarray:
    """Places of the text's n-grams and skip-grams, sorted, each once."""
    words = _WORD.findall((text or "").lower())
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, [w.encode("utf-8", "surrogatepass")
                                                   for w in words]), np.uint64, len(words))
    pairs = [(h[:-gap] * _SALTS[0]) ^ (h[gap:] * _SALTS[gap]) for gap in (1, 2, 3)]
    triples = (h[:-2] * _SALTS[0]) ^ (h[1:-1] * _SALTS[1]) ^ (h[2:] * _SALTS[4])
    grams = np.concatenate([h, *pairs, triples]) * _SALTS[2]
    return np.unique(grams >> _U(64 - PLACES_LOG2)).astype(np.int32)


class Ftrl:
    """w is zero while |z| <= l1; otherwise it follows z with the place's own rate."""

    def __init__(self, places: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
                 l2: float = 1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(places + 1), np.zeros(places + 1)  # the last is the intercept

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return -np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0) / rate

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def is_held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(3)) == 1,
                      F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """place, doc_id, toxic, text of at most ``sample`` labelled texts outside the held-out part.

    Ids meet first, so labels without a document take no place, and a text that is repeated with
    one ``doc_id`` takes one.
    """
    judged = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                          & ~is_held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.length("text"))
    texts = docs.select("doc_id", key.alias("key"))
    chosen = (texts.join(judged, "doc_id").distinct().withColumn("place", F.xxhash64("doc_id"))
              .orderBy("place", "doc_id", "key").limit(sample))
    found = docs.select("doc_id", "text", key.alias("key")).join(
        F.broadcast(chosen), ["doc_id", "key"])  # bounded by ``sample``
    return found.groupBy("place", "doc_id", "toxic", "key").agg(F.max("text").alias("text")).drop(
        "key")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights by place; the last one is the intercept."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.binary())],
                ["place", "doc_id", "toxic", "places"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic, held = [], [], 0
        for batch in batches:
            for label, data in zip(batch.column(2).to_pylist(), batch.column(3)):
                at = np.frombuffer(data.as_py(), np.int32)
                held += len(at)
                if held <= SAMPLE_PLACES:  # the rest is read past, not kept
                    texts.append(at)
                    toxic.append(label)
        model = Ftrl(1 << PLACES_LOG2)
        for _ in range(EPOCHS):
            for at, label in zip(texts, toxic):
                model.learn(at, label)
        w = model.weights(slice(None))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], ["place", "weight"])

    rows = training_rows(docs, labels, sample).select(
        "place", F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias(
            "toxic"), F.col("text").cast("string").alias("text"))
    found = stored(rows.mapInArrow(
        extract, "place long, doc_id long, toxic long, places binary"), "training")
    learned = found.repartition(1).sortWithinPartitions("place", "doc_id", "places").mapInArrow(
        learn, "place long, weight double")
    weights = np.zeros((1 << PLACES_LOG2) + 1, np.float32)
    for row in learned.toLocalIterator():  # at most one row per place
        weights[row["place"]] = row["weight"]
    return weights


def scores_of(texts: pa.Array, w: np.ndarray) -> np.ndarray:
    margin = np.array([w[features(t.as_py())].sum(dtype=np.float64) for t in texts], np.float64)
    return 1.0 / (1.0 + np.exp(-np.clip(margin + w[-1], -35, 35)))


def _sparse(weights: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    kept = np.flatnonzero(weights).astype(np.int32)
    return len(weights), kept, weights[kept]


def _dense(model: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    weights = np.zeros(model[0], np.float32)
    weights[model[1]] = model[2]
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(_sparse(weights))  # at most one per place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _dense(model.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores_of(batch.column(1), w))],
                ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).mapInArrow(
                             run, "doc_id long, score double")
    return scored.select("doc_id", is_held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, by a model that saw no label of the held-out third."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def not_toxic(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(_sparse(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _dense(model.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(scores_of(texts, w) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted toxic."""
    return not_toxic(docs, train(docs, table(spark, sf_dir, "labels")))
