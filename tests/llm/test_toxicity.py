import random
import zlib

import numpy as np
import pytest

from cdclake.llm import toxicity as t
from cdclake.llm.hashed_text import WordHashes, ngram_buckets, word_hashes
from tests.llm.conftest import rows


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(600)]
    docs = []
    for i in range(n):
        words = [rng.choice(stems) for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(60), rng.choice(["vilething", "nastyword", "slurry"]) + rng.choice([",", ".", ""]))
        docs.append((i, " ".join(words), int(toxic)))
    return docs


def test_features_are_words_pairs_and_skips():
    known = WordHashes()
    h = word_hashes("Aa bb, aa CC", known)
    assert len(ngram_buckets(h)) == 4 + 3 + 2
    # a pair differs from the same two words with one skipped, and order counts
    pair = set(ngram_buckets(word_hashes("x y", known))) - set(ngram_buckets(word_hashes("y x", known)))
    skip = set(ngram_buckets(word_hashes("x z y", known)))
    assert len(pair) == 1 and not pair & skip
    assert len(ngram_buckets(word_hashes("", known))) == len(ngram_buckets(word_hashes(None, known))) == 0


def test_ftrl_against_plain_updates():
    """The vectorised steps equal the textbook updates, coordinate by coordinate."""
    rng = np.random.default_rng(0)
    examples = [(np.unique(rng.integers(0, 40, 6)), int(rng.integers(0, 2))) for _ in range(60)]
    z, n = {}, {}

    def weight(i):
        l1 = 0 if i == t.BIAS else t.L1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((t.BETA + n[i] ** 0.5) / t.ALPHA + t.L2)

    for _ in range(2):
        for features, y in examples:
            each = [*map(int, features), t.BIAS]
            w = {i: weight(i) for i in each}
            g = t.sigmoid(sum(w.values())) - y
            for i in each:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / t.ALPHA * w[i]
                n[i] = old + g * g
    buckets, weights = t.ftrl(examples, epochs=2)
    expected = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(buckets.tolist(), weights.tolist(), strict=True)) == pytest.approx(expected)


def test_held_out_accuracy(spark):
    docs = corpus()
    table = spark.createDataFrame(docs, "doc_id bigint, text string, toxic int")
    found = t.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic")).collect()
    truth = {i: y for i, _, y in docs}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7)
    held = [r for r in found if r.held_out]
    caught = sum(r.predicted for r in held if truth[r.doc_id]) / sum(truth[r.doc_id] for r in held)
    false = sum(r.predicted for r in held if not truth[r.doc_id])
    assert caught >= 0.9 and false == 0


def test_held_out_labels_do_not_matter(spark):
    docs = corpus(300)
    table = spark.createDataFrame(docs, "doc_id bigint, text string, toxic int")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in docs]
    other = spark.createDataFrame(flipped, "doc_id bigint, toxic int")
    assert rows(t.toxicity(table, table.select("doc_id", "toxic"))) == rows(t.toxicity(table, other))


def test_edge_cases(messy, crowded, messy_labels, empty_docs, empty_labels):
    plain = t.toxicity(messy, messy_labels)
    found = plain.collect()
    assert len(found) == messy.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (2, 3, 7)}) == 1
    assert rows(t.toxicity(crowded, messy_labels)) == rows(plain)
    assert {r.score for r in t.toxicity(messy, empty_labels).collect()} == {0.0}
    assert t.toxicity(empty_docs, messy_labels).count() == 0


def test_query_against_brute_force(spark):
    """Learned by textbook FTRL from the labelled documents in the order of their id hashes; every score recomputed."""
    docs = corpus(240)
    table = spark.createDataFrame(docs, "doc_id bigint, text string, toxic int")
    found = {r.doc_id: r for r in t.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic")).collect()}
    order = [r.doc_id for r in table.selectExpr("doc_id", "pmod(xxhash64(doc_id), 1L << 40) AS h").orderBy("h", "doc_id").collect()]
    known, by_id = WordHashes(), {d[0]: d for d in docs}
    features = {i: sorted(set(ngram_buckets(word_hashes(text, known)).tolist())) for i, text, _ in docs}
    z, n = {}, {}

    def weight(i):
        l1 = 0 if i == t.BIAS else t.L1
        return 0.0 if abs(z.get(i, 0.0)) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((t.BETA + n[i] ** 0.5) / t.ALPHA + t.L2)

    for _ in range(t.EPOCHS):
        for d in order:
            if zlib.crc32(str(d).encode()) % 3 == 1:
                continue
            each = [*features[d], t.BIAS]
            w = {i: weight(i) for i in each}
            g = t.sigmoid(sum(w.values())) - by_id[d][2]
            for i in each:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / t.ALPHA * w[i]
                n[i] = old + g * g
    for d, _, _ in docs:
        assert found[d].score == pytest.approx(t.sigmoid(sum(weight(i) for i in features[d]) + weight(t.BIAS)), abs=1e-9)
