import random
import zlib

import numpy as np
import pytest

from cdclake.llm import language_id as g
from tests.llm.conftest import DOCUMENT, rows

STEMS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["ção", "é", "que", "nh"]}


def text(rng, language, words=30):
    return " ".join("".join(rng.choice(STEMS[language]) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize()


def corpus(n=360):
    rng = random.Random(8)
    names = list(STEMS)
    return [(i, text(rng, names[i % 3], rng.randint(4, 60)), names[i % 3], "s", 1) for i in range(n)]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_gradients_are_those_of_the_loss():
    """Backpropagation through time against differences, in double precision."""
    rng = np.random.default_rng(0)
    net = g.new_network(["a", "b", "c"], hidden=4, seed=1)
    net.w, net.u = [x.astype(float) for x in net.w], [x.astype(float) for x in net.u]
    net.out, net.bias = net.out.astype(float), rng.standard_normal(3)
    codes, y = rng.integers(0, 256, (9, 5)).astype(np.uint8), np.array([0, 2, 1, 1, 0])
    _, gradients = g.loss_and_gradients(net, codes, y)
    for p, d in zip(net.parameters, gradients, strict=True):
        used = np.argwhere(np.abs(d) > 1e-6)
        for at in map(tuple, used[rng.permutation(len(used))[:12]]):
            old, step = p[at], 1e-5
            p[at] = old + step
            up, _ = g.loss_and_gradients(net, codes, y)
            p[at] = old - step
            down, _ = g.loss_and_gradients(net, codes, y)
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(d[at], rel=1e-4, abs=1e-8)


def plain_probabilities(net, data):
    """One byte after the other, both ways, in double precision."""

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def states(order, w, u):
        hidden = len(u)
        h, out = np.zeros(hidden), {}
        for t in order:
            a, s = w[data[t]].astype(float), h @ u.astype(float)
            z, r = sigmoid(a[:hidden] + s[:hidden]), sigmoid(a[hidden : 2 * hidden] + s[hidden : 2 * hidden])
            c = np.tanh(a[2 * hidden :] + r * s[2 * hidden :])
            h = (1 - z) * c + z * h
            out[t] = h
        return out

    forth, back = states(range(len(data)), net.w[0], net.u[0]), states(range(len(data) - 1, -1, -1), net.w[1], net.u[1])
    return np.array([g.softmax(np.concatenate([forth[t], back[t]]) @ net.out + net.bias) for t in range(len(data))])


def test_labels_equal_the_plain_network():
    """Texts of many lengths together, against one byte at a time; each shorter than a window."""
    net = g.new_network(["a", "b", "c", "d"], hidden=6)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (1, 7, 300, g.WINDOW, 2, 0, 90)]
    found, marks = g.Labeller(net).documents(texts, positions=True)
    for data, p, m in zip(texts, found, marks, strict=True):
        if data:
            wanted = plain_probabilities(net, data)
            assert p == pytest.approx(wanted.mean(axis=0), abs=1e-5)
            assert len(m) == len(data) and (np.frombuffer(m, np.uint8) == wanted.argmax(axis=1)).mean() > 0.98
        else:
            assert not p.any() and m == b""


def test_windows_cover_every_byte_once():
    net = g.new_network(["a", "b"], hidden=4)
    net.out *= 0
    data = b"x" * (3 * g.WINDOW + 17)
    found, marks = g.Labeller(net).documents([data, b"yz"], positions=True)
    assert found == pytest.approx(np.full((2, 2), 0.5)) and [len(m) for m in marks] == [len(data), 2]


def test_held_out_accuracy_and_inputs(spark):
    docs = corpus()
    table = spark.createDataFrame(docs, DOCUMENT)
    found = g.languages(table).collect()
    truth = {d[0]: d[2] for d in docs}
    assert sorted(r.doc_id for r in found) == sorted(truth)
    for r in found:
        assert r.held_out == held_out(r.doc_id) and r.lang_pred in STEMS and 0 <= r.score <= 1
    kept = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in kept) >= 0.97 * len(kept)
    # languages of held-out documents, and sources, change nothing
    other = [(i, t, "aa" if held_out(i) else name, "other", 2) for i, t, name, _, _ in docs]
    assert rows(g.languages(spark.createDataFrame(other, DOCUMENT))) == rows(g.languages(table))


def test_edge_cases(spark, messy, crowded, empty_docs):
    plain = g.languages(messy)
    found = plain.collect()
    assert len(found) == messy.count()
    for r in found:
        if r.doc_id in (2, 3, 7):  # null, empty, white space
            assert (r.lang_pred, r.score) == ("und", 0.0)
        assert r.held_out == (r.doc_id is not None and held_out(r.doc_id))
    assert {r.lang_pred for r in found} <= {"en", "de", "und"}
    assert rows(g.languages(crowded)) == rows(plain)
    assert g.languages(empty_docs).count() == 0
    no_language = spark.createDataFrame([(1, "some text", None, "a", 1), (2, "2² + 3 = 7", "en", "a", 1)], DOCUMENT)
    assert {(r.lang_pred, r.score) for r in g.languages(no_language).collect()} == {("und", 0.0)}
