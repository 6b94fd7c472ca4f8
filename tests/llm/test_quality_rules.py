import collections
import math
import random
import re

import pytest

from cdclake.llm import quality_rules as q
from tests.llm.conftest import rows


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(triples)
    covered = {j for i, t in enumerate(triples) if times[t] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_against_brute_force():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \n\t\x1c\x85\xa0é*!") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for text in [*texts, None, "a b a b a b a b", "x\ny\nx\n\n\nx", "word " * 5000]:
        assert q.count_text(text)[:5] == brute_counts(text)


def test_binomial_tail():
    for n, k, p in ((10, 0, 0.1), (10, 3, 0.3), (50, 50, 0.5), (400, 7, 0.02)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert q.binomial_cdf(k, n, p) == pytest.approx(exact, rel=1e-9)


def test_binomial_tail_of_very_many_labels():
    """No array of all labels: a billion of them in a moment, and the two tails add up to one."""
    import time

    began = time.time()
    n, p = 10**9, 0.01
    sd = (n * p * (1 - p)) ** 0.5
    for z, wanted in ((-3, 0.001349898), (-1, 0.158655254), (0, 0.5), (1, 0.841344746), (2, 0.977249868)):
        assert q.binomial_cdf(round(n * p + z * sd - 0.5), n, p) == pytest.approx(wanted, rel=2e-3)
    assert q.binomial_cdf(0, n, p) == 0.0 and q.binomial_cdf(n, n, p) == 1.0
    assert time.time() - began < 5
    for k in (0, 3, 40, 50, 60, 99):
        assert q.binomial_cdf(k, 100, 0.5) + q.binomial_cdf(99 - k, 100, 0.5) == pytest.approx(1.0, abs=1e-12)


def test_certified_stops_at_the_first_failure():
    # 0.9**42 < 0.0125 <= 0.9**41: 42 good documents without a loss certify a rate of 0.1
    assert q.certified([0, 0, 0], 42, 0.1, 0.0125) == 3
    assert q.certified([0, 0, 0], 41, 0.1, 0.0125) == 0
    assert q.certified([0, 20, 0], 42, 0.1, 0.0125) == 1
    assert q.certified([], 0, 0.1, 0.05) == 0


def _corpus(spark, n=700):
    rng = random.Random(8)
    stems = ["".join(rng.choice("aeioulmnrst") for _ in range(5)) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(stems) for _ in range(80)]
        junk = i % 4 == 0
        docs.append((i, " ".join(w + "***" if junk else w for w in words), "en" if i % 7 else "xx", "s", 1))
        labels.append((i, 0 if junk else 1, 0))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_verdicts_match_a_plain_computation(spark):
    docs, labels = _corpus(spark)
    found = {r.doc_id: r for r in q.quality_verdicts(docs, labels).collect()}
    label = {r.doc_id: r.quality for r in labels.collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    tables = collections.defaultdict(dict)
    for r in found.values():
        if r.base_failed:
            continue
        key = ((r.doc_id % 1_000_003 * 7919 + 13) % 104_729 % 2 == 1, label[r.doc_id] > 0)
        row = tables[lang[r.doc_id]].setdefault(key, collections.Counter())
        row["n"] += 1
        for rule, (top, bottom, cutoffs) in q.RULES.items():
            value = r[top] / r[bottom] if r[bottom] else 0.0
            for i, cut in enumerate(cutoffs):
                row[f"{rule}_{i}"] += value > cut
    cuts = {s: q.choose(t, q.ALPHA, q.DELTA / len(tables)) for s, t in tables.items()}
    assert cuts["en"]["symbols"] is not None
    for r in found.values():
        over = any(
            c is not None and r[q.RULES[rule][1]] and r[q.RULES[rule][0]] / r[q.RULES[rule][1]] > c
            for rule, c in cuts.get(lang[r.doc_id], {}).items()
        )
        assert r.kept == (not r.base_failed and not over)
        if label[r.doc_id]:
            assert r.kept
    assert not any(r.kept for i, r in found.items() if not label[i] and lang[i] == "en")


def test_edge_cases(messy, crowded, messy_labels, empty_docs, empty_labels):
    plain = q.quality_verdicts(messy, messy_labels)
    assert plain.count() == messy.count()
    assert [r.base_failed for r in plain.where("doc_id IN (2, 3, 7)").collect()] == [True] * 3
    assert rows(q.quality_verdicts(crowded, messy_labels)) == rows(plain)
    assert q.quality_verdicts(empty_docs, messy_labels).count() == 0
    # without labels nothing is rejected beyond the base rule
    assert q.quality_verdicts(messy, empty_labels).where("kept = base_failed").count() == 0


def test_keep_good_returns_the_rows_unchanged(messy, crowded, messy_labels, empty_docs):
    kept = q.keep_good(messy, messy_labels)
    assert kept.schema == messy.schema
    verdicts = q.quality_verdicts(messy, messy_labels).where("kept")
    assert rows(kept, "doc_id") == rows(verdicts, "doc_id")
    assert rows(q.keep_good(crowded, messy_labels)) == rows(crowded.where("doc_id IN (1, 4, 6, 9) OR doc_id IS NULL AND text IS NOT NULL"))
    assert q.keep_good(empty_docs, messy_labels).count() == 0
