import collections
import random

import numpy as np
import pytest

from cdclake.llm import ngram_jaccard as n
from cdclake.llm.components import connected_components
from cdclake.llm.hashed_text import WordHashes, word_hashes
from tests.llm.conftest import rows

_LAST = 2**63 - 1


def brute(texts):
    """text_id, class_id and n_links of every id, from all pairs of texts (ids are unique here)."""
    words = {i: tuple(__import__("re").findall(r"\w+", (t or "").lower())) for i, t in texts}
    first = {}
    for i in sorted(words):
        first.setdefault(words[i], i)
    sets = {i: {w[j : j + 5] for j in range(max(1, len(w) - 4))} if w else set() for w, i in first.items()}
    links, root = collections.Counter(), {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (first[words[i]], find(first[words[i]]), links[first[words[i]]]) for i in words}


def edited(text, rng, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_texts(prose):
    rng = random.Random(11)
    texts = [*prose, *prose[:3], *(t.upper() for t in prose[3:5]), "", None, "one", "One!", "one two three four"]
    texts += [edited(rng.choice(prose), rng, rng.randint(1, 5)) for _ in range(150)]
    texts += [edited(edited(prose[0], random.Random(1), 2), rng, 1) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_bands_reach_the_recall():
    bands, rows_ = n.choose_bands()
    assert bands * rows_ <= n.MAX_HASHES
    assert 1 - (1 - 0.8**rows_) ** bands >= n.RECALL
    with pytest.raises(ValueError):
        n.choose_bands(0.1, 0.999999, 3)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    minhash = n.MinHash(200, 1)
    pool = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    a, b = minhash.band_hashes(np.unique(pool[:1200])), minhash.band_hashes(np.unique(pool[300:]))
    assert abs((a == b).mean() - 0.6) < 0.12


def test_shingles():
    known = WordHashes()
    s = lambda t: set(n.shingles(word_hashes(t, known)).tolist())
    assert len(s("a b c d e f")) == 2 and len(s("a b")) == 1 and not s("") and s("A, b") == s("a B")
    assert s("a b c d e f") & s("x a b c d e") == s("a b c d e")


@pytest.mark.parametrize("block", [(512, 400_000), (16, 400_000), (512, 900)])
def test_classes_and_links_against_all_pairs(spark, near_texts, monkeypatch, block):
    """Also with blocks so small that every large class is cut into several."""
    monkeypatch.setattr(n, "BLOCK_TEXTS", block[0])
    monkeypatch.setattr(n, "BLOCK_SHINGLES", block[1])
    found = n.classes(spark.createDataFrame(near_texts, "doc_id bigint, text string")).collect()
    expected = brute(near_texts)
    assert {r.doc_id: (r.text_id, r.class_id, r.n_links) for r in found} == expected
    assert len(found) == len(near_texts)
    assert max(e[2] for e in expected.values()) > 20


def test_one_document_of_every_class_stays(spark, near_texts):
    table = spark.createDataFrame(near_texts, "doc_id bigint, text string")
    kept = n.keep_first(table)
    assert {r.doc_id for r in kept.collect()} == {c for _, c, _ in brute(near_texts).values()}
    assert kept.columns == table.columns


def test_exact_copies_in_a_third_of_the_rows(spark, prose):
    texts = [(i, prose[0] if i % 3 == 0 else f"{prose[i % 11 + 1]} {i} {i + 1} {i + 2} {i + 3} {i + 4} {i * 7}") for i in range(120)]
    found = n.classes(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.text_id, r.class_id, r.n_links) for r in found} == brute(texts)


def test_edge_cases(messy, crowded, empty_docs):
    plain = n.classes(messy)
    found = plain.collect()
    assert len(found) == messy.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[6].class_id == by_id[6].text_id == 1
    assert by_id[2].class_id == by_id[3].class_id == by_id[7].class_id == 2 and by_id[2].n_links == 0
    assert rows(n.classes(crowded)) == rows(plain)
    assert n.classes(empty_docs).count() == 0
    kept = n.keep_first(messy)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 4, 5, 8, 9]
    assert n.keep_first(crowded).columns == crowded.columns
    assert n.keep_first(empty_docs).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(120)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    expected = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert {r.id: r.root for r in found.collect()} == expected
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
