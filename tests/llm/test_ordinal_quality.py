import numpy as np

from cdclake.llm import ordinal_quality as o
from tests.llm.conftest import rows
from tests.llm.test_toxicity import corpus


def test_probabilities_are_ordered_cumulative_links():
    cuts = [-1.0, 0.5]
    for s in (-3.0, 0.0, 4.0):
        p = o.probabilities(s, cuts)
        below = [1 / (1 + np.exp(-(c - s))) for c in cuts]
        assert np.allclose(np.cumsum(p), [*below, 1.0])


def test_gradient_moves_the_loss_down():
    rng = np.random.default_rng(1)
    examples = []
    for _ in range(300):
        y = int(rng.integers(0, 3))
        i = np.unique(np.concatenate([rng.integers(0, 50, 4), [100 + y]]))
        examples.append((i, np.full(len(i), 0.5), y))
    loss = lambda w, cuts: -sum(np.log(o.probabilities(float(w[i] @ x), cuts)[y]) for i, x, y in examples)
    one, many = o.train(examples, 1), o.train(examples, 8)
    assert loss(*many) < loss(*one) < 300 * np.log(3)
    assert many[1][0] < many[1][1]
    grades = [np.argmax(o.probabilities(float(many[0][i] @ x), many[1])) for i, x, _ in examples]
    assert np.mean([g == y for g, (_, _, y) in zip(grades, examples, strict=True)]) > 0.95


def test_shapes():
    assert o.shape("Word***") == "Aa*" and o.shape("ÉTÉ!!") == "A!" and o.shape("a1b22") == "a0a0"


def test_held_out_grades(spark):
    docs = []
    for i, text, toxic in corpus(900):
        low = i % 5 == 0
        docs.append((i, " ".join(w + "###" for w in text.split()) if low else text, 0 if low else 1, toxic))
    table = spark.createDataFrame(docs, "doc_id bigint, text string, quality int, toxic int")
    found = {r.doc_id: r for r in o.quality_grades(table.select("doc_id", "text"), table.select("doc_id", "quality", "toxic")).collect()}
    held = [(d, found[d[0]]) for d in docs if found[d[0]].held_out]
    assert all(r.kept == bool(d[2]) for d, r in held)
    mean = lambda grade: np.mean([r.expected_grade for d, r in held if (0 if not d[2] else 2 - d[3]) == grade])
    assert mean(0) < mean(1) < mean(2)


def test_edge_cases(messy, crowded, messy_labels, empty_docs, empty_labels):
    plain = o.quality_grades(messy, messy_labels)
    found = plain.collect()
    assert len(found) == messy.count()
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in found)
    assert rows(o.quality_grades(crowded, messy_labels)) == rows(plain)
    assert {(r.expected_grade, r.kept) for r in o.quality_grades(messy, empty_labels).collect()} == {(1.0, True)}
    assert o.quality_grades(empty_docs, messy_labels).count() == 0


MASK = (1 << 64) - 1


def plain_features(text):
    """Pairs of bucket and value, word by word."""
    import math

    import xxhash

    from cdclake.llm.hashed_text import _A, BITS

    bucket = lambda h: (h * int(_A) & MASK) >> (64 - BITS)
    tokens = (text or "").split()
    words = [xxhash.xxh64_intdigest("w" + t.lower()) for t in tokens]
    forms = [xxhash.xxh64_intdigest("s" + o.shape(t)) for t in tokens]
    out = []
    for hashes in (sorted(set(words)), forms + [(a * 31 + b) & MASK for a, b in zip(forms, forms[1:], strict=False)]):
        times = {}
        for h in hashes:
            times[bucket(h)] = times.get(bucket(h), 0) + 1
        length = math.sqrt(sum(math.log1p(n) ** 2 for n in times.values())) or 1.0
        out += [(i, math.log1p(times[i]) / length) for i in sorted(times)]
    pairs = {(a, b) for a, b in zip(words, words[1:], strict=False)}
    repeat = 1 - len(pairs) / max(1, len(words) - 1) if tokens else 0.0
    marks = [f"len{int(math.log2(len(tokens) + 1))}", f"rep{int(repeat * 10)}"]
    return out + [(bucket(xxhash.xxh64_intdigest("m" + m)), 1.0) for m in marks]


def plain_training(examples):
    """The learner with dictionaries, one coordinate after the other."""
    import math

    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    w, seen, start, gap, seen_cuts = {}, {}, -1.0, 1.0, [0.1, 0.1]
    for _ in range(o.EPOCHS):
        for features, y in examples:
            cuts = [start, start + gap]
            s = sum(w.get(i, 0.0) * x for i, x in features)
            a = sigmoid(cuts[y] - s) if y < 2 else 1.0
            b = sigmoid(cuts[y - 1] - s) if y > 0 else 0.0
            steps = [(i, (1 - a - b) * x + o.DECAY * w.get(i, 0.0)) for i, x in features]
            for i, g in steps:
                seen[i] = seen.get(i, 1e-3) + g * g
            for i, g in steps:
                w[i] = w.get(i, 0.0) - o.RATE * g / math.sqrt(seen[i])
            slope = [0.0, 0.0]
            if y < 2:
                slope[y] -= a * (1 - a) / max(a - b, 1e-9)
            if y > 0:
                slope[y - 1] += b * (1 - b) / max(a - b, 1e-9)
            tail = [slope[0] + slope[1], slope[1]]
            seen_cuts = [n + t * t for n, t in zip(seen_cuts, tail, strict=True)]
            step = [0.1 * t / math.sqrt(n) for t, n in zip(tail, seen_cuts, strict=True)]
            start, gap = start - step[0], max(0.05, gap - step[1])
    return {i: v for i, v in w.items() if abs(v) > o.LEAST}, [start, start + gap]


def test_query_against_brute_force(spark):
    """Learned and scored plainly, from the same labelled documents in the order of their id hashes."""
    import zlib

    docs = []
    for i, text, toxic in corpus(150):
        low = i % 5 == 0
        docs.append((i, text.replace(" ", "## ") if low else text + " Great day!" * (i % 3), 0 if low else 1, toxic))
    table = spark.createDataFrame(docs, "doc_id bigint, text string, quality int, toxic int")
    found = {r.doc_id: r for r in o.quality_grades(table.select("doc_id", "text"), table.select("doc_id", "quality", "toxic")).collect()}
    order = [r.doc_id for r in table.selectExpr("doc_id", "pmod(xxhash64(doc_id), 1L << 40) AS h").orderBy("h", "doc_id").collect()]
    by_id = {d[0]: d for d in docs}
    learned = [by_id[i] for i in order if zlib.crc32(str(i).encode()) % 3 != 1]
    w, cuts = plain_training([(plain_features(t), 0 if not q else 1 if x else 2) for _, t, q, x in learned])
    for i, text, _, _ in docs:
        s = sum(w.get(b, 0.0) * x for b, x in plain_features(text))
        below = [1 / (1 + np.exp(-(c - s))) for c in cuts]
        r = found[i]
        assert abs(r.tail_probability - (1 - below[0])) < 1e-6 and abs(r.expected_grade - (2 - sum(below))) < 1e-6
        assert r.kept == (r.tail_probability >= o.TAIL) and r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_a_row_without_an_id_is_in_no_fold(spark, messy, messy_labels):
    assert {r.held_out for r in o.quality_grades(messy, messy_labels).collect() if r.doc_id is None} == {None}
