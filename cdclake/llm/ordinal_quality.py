"""Quality grades: cumulative-link (proportional odds) regression on hashed text.

Graded ratings ``0 < 1 < 2`` share one weight vector over hashed features;
ordered thresholds ``t0 < t1`` cut the score ``s = w . x``:

    P(grade <= k) = sigmoid(t_k - s)

A document gets its expected grade and the tail probability
``P(grade >= 1)``, which selects it. Features are the distinct lower-case
words, the words' shapes (letters, capitals, digits and marks in runs) with
shape pairs, and marks for the text's length and for how often it repeats
itself; each group of features has unit length, so long texts count no more
than short ones. Adagrad learns from a bounded sample of graded documents in
one task; the weights (at most 2**20 numbers) are broadcast.

The grade of a labelled document is 0 (``quality`` 0), 1 (good but toxic) or
2 (good and not toxic). As in the toxicity score, documents with
``crc32(doc_id) % 3 = 1`` are held out.

Defined cases: a null or empty text is scored by its length mark alone; null
quality or ids are ignored, null ``toxic`` counts as not toxic; the lowest
grade counts when a document has several; without labels every document has
the middle grade and is kept; a row without an id is in no fold (``held_out``
is null) and not learned from; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from cdclake.llm.common import WORD_CACHE_ENTRIES, crc_fold, map_texts
from cdclake.llm.hashed_text import BITS, SAMPLE, buckets, fit, labelled_sample

GRADES = 3
RATE, DECAY, EPOCHS = 0.5, 1e-6, 6
#: Smaller weights are dropped.
LEAST = 1e-3
#: Least P(grade >= 1) of a kept document.
TAIL = 0.5

#: Character classes of a word's shape: a letter, A capital, 0 digit; others stay.
_SHAPE = {ord(c): "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {ord(c): "a" for c in "abcdefghijklmnopqrstuvwxyz"} | {ord(c): "0" for c in "0123456789"}


def shape(word: str) -> str:
    """Runs of character classes, e.g. ``Word***`` -> ``Aa*``."""
    out = []
    for c in word.translate(_SHAPE):
        c = "a" if c > "\x7f" and c.islower() else "A" if c > "\x7f" and c.isupper() else c
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out[:12])


class TokenHashes(dict):
    """Raw token -> (hash of the lower-case word, hash of its shape); bounded."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= WORD_CACHE_ENTRIES:
            self.clear()
        value = self[token] = (xxhash.xxh64_intdigest("w" + token.lower()), xxhash.xxh64_intdigest("s" + shape(token)))
        return value


def _unit(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets with log-damped counts, scaled to length one."""
    found, times = np.unique(buckets(hashes), return_counts=True)
    value = np.log1p(times)
    return found, value / (np.linalg.norm(value) or 1.0)


def features(text: str | None, known: TokenHashes) -> tuple[np.ndarray, np.ndarray]:
    tokens = (text or "").split()
    pairs = np.array([known[t] for t in tokens], np.uint64).reshape(len(tokens), 2)
    word, form = pairs[:, 0], pairs[:, 1]
    groups = []
    repeat = 0.0
    if tokens:
        distinct = np.unique(word)
        repeat = 1 - len(np.unique(word[:-1] * np.uint64(3) + word[1:])) / max(1, len(word) - 1)
        groups += [_unit(distinct), _unit(np.concatenate([form, form[:-1] * np.uint64(31) + form[1:]]))]
    marks = [f"len{int(math.log2(len(tokens) + 1))}", f"rep{int(repeat * 10)}"]
    groups.append((buckets(np.array([xxhash.xxh64_intdigest("m" + m) for m in marks], np.uint64)), np.ones(len(marks))))
    return np.concatenate([g[0] for g in groups]), np.concatenate([g[1] for g in groups])


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def probabilities(s: float, cuts: list[float]) -> list[float]:
    """P(grade = k) for every grade."""
    below = [0.0, *(_sigmoid(t - s) for t in cuts), 1.0]
    return [max(0.0, b - a) for a, b in zip(below, below[1:], strict=False)]


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, list[float]]:
    """The weights and the ordered thresholds. Thresholds are a start and positive gaps, so their order holds."""
    w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    start, gaps, seen_cuts = -1.0, [1.0] * (GRADES - 2), np.full(GRADES - 1, 1e-1)
    for _ in range(epochs):
        for i, x, y in examples:
            cuts = list(np.cumsum([start, *gaps]))
            s = float(w[i] @ x)
            a = _sigmoid(cuts[y] - s) if y < GRADES - 1 else 1.0
            b = _sigmoid(cuts[y - 1] - s) if y > 0 else 0.0
            p = max(a - b, 1e-9)
            g = (1 - a - b) * x + DECAY * w[i]
            np.add.at(seen, i, g * g)
            np.add.at(w, i, -RATE * g / np.sqrt(seen[i]))
            slope = np.zeros(GRADES - 1)  # of the loss, by threshold
            if y < GRADES - 1:
                slope[y] -= a * (1 - a) / p
            if y > 0:
                slope[y - 1] += b * (1 - b) / p
            tail = np.cumsum(slope[::-1])[::-1]  # by start and gaps
            seen_cuts += tail * tail
            step = 0.1 * tail / np.sqrt(seen_cuts)
            start -= float(step[0])
            gaps = [max(0.05, gap - float(d)) for gap, d in zip(gaps, step[1:], strict=True)]
    return w, [float(c) for c in np.cumsum([start, *gaps])]


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, list[float]] | None:
    """Buckets and weights (without the negligible), and the thresholds; None without labels."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (crc_fold(F.col("doc_id")) != 1))
        .groupBy("doc_id")
        .agg(F.min(grade).alias("y"))
    )

    def make():
        known = TokenHashes()

        def work(h, ids, y, texts):
            found = [features(t, known) for t in texts]
            return {"h": h, "doc_id": ids, "y": y, "i": [f[0].astype(np.int32) for f in found], "x": [f[1] for f in found]}

        return work

    sample = map_texts(
        labelled_sample(docs, usable, rows), make, "h bigint, doc_id bigint, y int, i array<int>, x array<double>", "h", "doc_id", "y", "text"
    )

    def fitted(examples):
        w, cuts = train([(i.astype(np.int64), x, y) for i, x, y in examples[:rows]])
        kept = np.flatnonzero(np.abs(w) > LEAST)
        return [*range(-len(cuts), 0), *kept], [*cuts, *w[kept]]  # the thresholds come first, under negative numbers

    found = fit(sample, fitted, "i", "x", "y")
    if found is None:
        return None
    keys, values = found
    return keys[GRADES - 1 :], values[GRADES - 1 :], list(values[: GRADES - 1])


def grade(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, list[float]] | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``expected_grade``, ``tail_probability`` and ``kept`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known, dense, cuts = TokenHashes(), np.zeros(1 << BITS), None
        if shared.value is not None:
            buckets_, weights, cuts = shared.value
            dense[buckets_] = weights

        def one(text):
            if cuts is None:
                return (GRADES - 1) / 2, TAIL
            i, x = features(text, known)
            p = probabilities(float(dense[i] @ x), cuts)
            return sum(k * q for k, q in enumerate(p)), 1 - p[0]

        def work(ids, held, texts):
            found = [one(t) for t in texts]
            return {"doc_id": ids, "held_out": held, "expected_grade": [f[0] for f in found], "tail_probability": [f[1] for f in found]}

        return work

    prepared = docs.select("doc_id", (crc_fold(F.col("doc_id")) == 1).alias("held_out"), "text")
    schema = StructType(
        [
            docs.schema["doc_id"],
            StructField("held_out", BooleanType()),
            StructField("expected_grade", DoubleType(), False),
            StructField("tail_probability", DoubleType(), False),
        ]
    )
    graded = map_texts(prepared, make, schema, "doc_id", "held_out", "text")
    return graded.withColumn("kept", F.col("tail_probability") >= TAIL)


def quality_grades(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return grade(docs, learn(docs, labels))
