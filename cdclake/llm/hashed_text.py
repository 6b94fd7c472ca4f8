"""Hashed text features and the bounded labelled sample that the linear models learn from."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import WORD_CACHE_ENTRIES, hash_sample, stage

#: Size of the hashed feature space. Weights are at most 2**20 numbers, so they may be broadcast.
BITS = 20
#: Labelled documents that a model learns from, at most: those with the smallest id hash.
SAMPLE = 12_000

_WORD = re.compile(r"\w+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_SHIFT = np.uint64(64 - BITS)


class WordHashes(dict):
    """word -> 64-bit hash, the same in every process; forgets all when it grows past its bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    words = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _A >> _SHIFT).astype(np.int64)


def ngram_buckets(h: np.ndarray) -> np.ndarray:
    """Buckets of all words, word pairs, and pairs with one word skipped (repeats included)."""
    mixed = h * _B
    parts = [buckets(h)]
    if len(h) > 1:
        parts.append(buckets(mixed[:-1] + h[1:]))
    if len(h) > 2:
        parts.append(buckets((mixed[:-2] ^ _C) + h[2:]))
    return np.concatenate(parts)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``doc_id, y, text, h`` of at most ``rows`` labelled documents, the smallest id hashes first.

    ``labels`` has one row ``(doc_id, y)`` per document. The sample is at most
    ``rows`` ids and labels, so it is broadcast against the documents.
    """
    chosen = hash_sample(stage(labels, "labels"), "doc_id", rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(sample: DataFrame, train, *columns: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Run ``train`` over the sample's rows, ordered by id hash, in one task.

    ``train`` takes an iterator of row tuples of ``columns`` (arrays come as
    NumPy arrays) and returns numbers and values, at most a few megabytes,
    that come back as two arrays. None if the sample is empty.
    """

    def run(batches):
        def rows():
            for b in batches:
                lists = (b.column(c) for c in columns)
                yield from zip(
                    *(x.to_numpy(zero_copy_only=False) if pa.types.is_list(x.type) else x.to_pylist() for x in lists), strict=True
                )

        examples = list(rows())
        if examples:
            keys, values = train(examples)
            yield pa.RecordBatch.from_pydict(
                {"keys": [np.asarray(keys, np.int32).tobytes()], "vals": [np.asarray(values, np.float64).tobytes()]}
            )

    ordered = sample.repartition(1).sortWithinPartitions("h", "doc_id")
    found = ordered.mapInArrow(run, "keys binary, vals binary").collect()
    return (np.frombuffer(found[0][0], np.int32), np.frombuffer(found[0][1], np.float64)) if found else None
