import hashlib
import os
import random

import pytest

from cdclake.llm import bpe
from cdclake.llm.queries import VOCABULARY
from tests.llm.conftest import rows

tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    with open(VOCABULARY, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def naive(own, word):
    """Merge the pair of the lowest rank, leftmost first, until none is left."""
    chars = [bpe.byte_characters()[b] for b in word.encode()]
    ids_of = {t: i for i, t in own.tokens.items()}
    parts = [ids_of[c] for c in chars[:-1]] + [ids_of[chars[-1] + "</w>"]]
    whole = {pair: t for t, (*pair_, _) in own.parts.items() for pair in [tuple(pair_)]}
    while True:
        ranked = [(own.rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in own.rank]
        if not ranked:
            return parts
        _, i = min(ranked)
        parts[i : i + 2] = [whole[parts[i], parts[i + 1]]]


def test_dynamic_program_equals_greedy_merges(own):
    rng = random.Random(2)
    for _ in range(400):
        word = "".join(rng.choice("aehinorstt") for _ in range(rng.randint(1, 14)))
        assert own._word(word) == naive(own, word)


def test_same_as_the_library(own, library):
    rng = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyz'aaeett 0129ÉéÀßΣσİ  \t\n\x1c\x85.,!?<|>中文é🙂́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|startoftext|><|endoftext|>", "a" * 3000, "the" * 1000, "", "  ", "don't we'll 'S I'VE"]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = own.encode(text)
        assert ids == found.ids
        assert own.decode(ids) == library.decode(found.ids, skip_special_tokens=False)


def test_documents(spark, messy, messy_rows, library):
    found = bpe.digests(bpe.encode(messy, VOCABULARY, decoded=True))
    expected = []
    for key, text, *_ in messy_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((key, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert rows(found) == sorted(map(repr, expected))


def test_decode_reads_ids_back(spark, messy):
    encoded = bpe.encode(messy, VOCABULARY, decoded=True)
    again = bpe.decode(encoded, VOCABULARY)
    assert rows(again) == rows(encoded, "doc_id", "decoded")


def test_empty_and_extra_columns(messy, crowded, empty_docs):
    assert bpe.encode(empty_docs, VOCABULARY).count() == 0
    assert rows(bpe.encode(crowded, VOCABULARY)) == rows(bpe.encode(messy, VOCABULARY))
