"""Toxicity score: FTRL-proximal logistic regression on hashed words, word pairs and skip-grams.

A document's features are the distinct hashed words, neighbouring pairs and
pairs with one word skipped. FTRL-proximal learns from a bounded sample of
labelled documents, one after the other, in one task: every coordinate has
its own learning rate, and the L1 term keeps most weights at zero. The
remaining weights (at most 2**20 numbers) are broadcast, and every whole text
is scored where it lies.

Labels are used only from documents with ``crc32(doc_id) % 3 != 1``; labels,
language, source and id are never inputs of a score.

Defined cases: a null or empty text gets the score of no features; null
labels and ids are ignored; several labels of one document count as toxic if
any is; without any label all scores are 0; a row without an id is in no fold
(``held_out`` is null) and not learned from; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from cdclake.llm.common import crc_fold, map_texts
from cdclake.llm.hashed_text import BITS, SAMPLE, WordHashes, fit, labelled_sample, ngram_buckets, word_hashes

ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.0
EPOCHS = 8
THRESHOLD = 0.7
#: The bias is kept in the bucket after the last one.
BIAS = 1 << BITS


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def document_features(text: str | None, known: WordHashes) -> np.ndarray:
    return np.unique(ngram_buckets(word_hashes(text, known)))


def ftrl(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights that are not zero. Each example has its distinct buckets and its label."""
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def weights(i):
        free = np.abs(z[i]) - L1 * (i != BIAS)
        return np.where(free > 0, -np.sign(z[i]) * free / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for features, y in examples:
            i = np.append(features, BIAS)
            w = weights(i)
            g = sigmoid(float(w.sum())) - y
            old = n[i]
            now = old + g * g
            z[i] += g - (np.sqrt(now) - np.sqrt(old)) / ALPHA * w
            n[i] = now
    w = weights(np.arange(BIAS + 1))
    kept = np.flatnonzero(w)
    return kept, w[kept]


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and weights that are not zero; None without labels."""
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_fold(F.col("doc_id")) != 1))
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    )
    sample = labelled_sample(docs, usable, rows)
    features = map_texts(sample, _feature_maker, "h bigint, doc_id bigint, y int, features array<int>", "h", "doc_id", "y", "text")
    return fit(features, lambda examples: ftrl(examples[:rows]), "features", "y")


def _feature_maker():
    known = WordHashes()
    return lambda h, ids, y, texts: {
        "h": h, "doc_id": ids, "y": y, "features": [document_features(t, known).astype(np.int32) for t in texts]
    }


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        known, dense = WordHashes(), np.zeros(BIAS + 1)
        if shared.value is not None:
            dense[shared.value[0]] = shared.value[1]

        def one(text):
            found = ngram_buckets(word_hashes(text, known))
            weighty = np.unique(found[dense[found] != 0])
            return sigmoid(float(dense[weighty].sum()) + dense[BIAS]) if shared.value is not None else 0.0

        return lambda ids, held, texts: {"doc_id": ids, "held_out": held, "score": [one(t) for t in texts]}

    prepared = docs.select("doc_id", (crc_fold(F.col("doc_id")) == 1).alias("held_out"), "text")
    schema = StructType([docs.schema["doc_id"], StructField("held_out", BooleanType()), StructField("score", DoubleType(), False)])
    scored = map_texts(prepared, make, schema, "doc_id", "held_out", "text")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast(IntegerType()))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
