"""Language of a text: a bidirectional gated recurrent network over its bytes.

The network reads the UTF-8 bytes of the lower-cased text in both directions
(one GRU each), gives every byte a probability for each language, and a
document's probabilities are the mean over all its bytes. The language with
the largest mean is the prediction and that mean its score.

It is trained in NumPy by backpropagation through time, in one task, on a
bounded sample: at most ``SAMPLE_PER_LANGUAGE`` documents of each of the
``LANGUAGES`` most frequent languages (those with the smallest id hashes) and
``PIECES`` pieces of ``PIECE`` bytes of each. The weights (a few kilobytes)
go with the tasks that label the texts.

Whole texts are read: they are cut into windows of ``WINDOW`` bytes, each
with ``CONTEXT`` more bytes on either side for the states to settle, so that
long and short texts are worked through together. Every byte is labelled once.

Only documents with ``crc32(doc_id) % 4 != 2`` and a language are learned
from. Language, source and id are never inputs of a prediction.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned. Of equal probabilities the
alphabetically first language wins. A row without an id is not learned from
and not held out. Repeated rows get a row each; extra columns are ignored; an
empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, StringType, StructField, StructType

from cdclake.llm.common import crc_fold, map_texts, stage
from cdclake.llm.hashed_text import fit

HIDDEN = 8
LANGUAGES, SAMPLE_PER_LANGUAGE = 64, 600
PIECES, PIECE = 2, 160
EPOCHS, BATCH, RATE = 5, 48, 8e-3
WINDOW, CONTEXT = 448, 32
#: Windows worked through together.
GROUP = 768
HASHES = 1 << 30
UNDETERMINED = "und"


@dataclass
class Network:
    """``w[i]``: what byte adds to the gates of direction i; ``u[i]``: what the state adds; ``out``, ``bias``: to the languages.

    The columns of ``w`` and ``u`` are update, reset and candidate gate.
    """

    languages: list[str]
    w: list[np.ndarray]
    u: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, self.out, self.bias]


def new_network(languages: list[str], hidden: int = HIDDEN, seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        languages,
        [normal(256, 3 * hidden, scale=0.5) for _ in range(2)],
        [normal(hidden, 3 * hidden, scale=hidden**-0.5) for _ in range(2)],
        normal(2 * hidden, len(languages), scale=hidden**-0.5),
        np.zeros(len(languages), np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


# ---------------------------------------------------------------- training
def _states(codes: np.ndarray, w: np.ndarray, u: np.ndarray, order) -> tuple[np.ndarray, list]:
    """States of one direction for pieces of equal length (time, piece), and what backpropagation needs."""
    steps, n = codes.shape
    hidden = u.shape[0]
    h = np.zeros((n, hidden), w.dtype)
    out, kept = np.empty((steps, n, hidden), w.dtype), []
    for t in order:
        a, g = w[codes[t]], h @ u
        gates = _sigmoid(a[:, : 2 * hidden] + g[:, : 2 * hidden])
        z, r, m = gates[:, :hidden], gates[:, hidden:], g[:, 2 * hidden :]
        c = np.tanh(a[:, 2 * hidden :] + r * m)
        kept.append((t, h, z, r, m, c))
        h = c + z * (h - c)
        out[t] = h
    return out, kept


def _back(codes: np.ndarray, w: np.ndarray, u: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``w`` and ``u`` by backpropagation through time."""
    dw, du = np.zeros_like(w), np.zeros_like(u)
    carried = np.zeros_like(dout[0])
    for t, h, z, r, m, c in reversed(kept):
        d = dout[t] + carried
        dc = d * (1 - z) * (1 - c * c)
        dz = d * (h - c) * z * (1 - z)
        dr = dc * m * r * (1 - r)
        np.add.at(dw, codes[t], np.concatenate([dz, dr, dc], axis=1))
        dg = np.concatenate([dz, dr, dc * r], axis=1)
        du += h.T @ dg
        carried = d * z + dg @ u.T
    return dw, du


def loss_and_gradients(net: Network, codes: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy over all positions of the pieces, and its gradients. ``codes`` is (time, piece)."""
    steps, n = codes.shape
    forth, kept_forth = _states(codes, net.w[0], net.u[0], range(steps))
    back, kept_back = _states(codes, net.w[1], net.u[1], range(steps - 1, -1, -1))
    both = np.concatenate([forth, back], axis=2)
    p = softmax(both @ net.out + net.bias)
    loss = -float(np.log(p[:, np.arange(n), y] + 1e-30).mean())
    p[:, np.arange(n), y] -= 1
    d = p / p.dtype.type(steps * n)
    hidden = net.u[0].shape[0]
    dboth = d @ net.out.T
    dw0, du0 = _back(codes, net.w[0], net.u[0], kept_forth, dboth[:, :, :hidden])
    dw1, du1 = _back(codes, net.w[1], net.u[1], kept_back, dboth[:, :, hidden:])
    flat = both.reshape(steps * n, -1)
    return loss, [dw0, dw1, du0, du1, flat.T @ d.reshape(steps * n, -1), d.sum(axis=(0, 1))]


def train(pieces: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> Network:
    """Adam steps over shuffled batches; every language weighs the same in an epoch. ``pieces`` is (piece, time)."""
    net = new_network(languages)
    rng = np.random.default_rng(5)
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    most = max(map(len, by_language))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters]
    batches = -(-most * len(languages) // BATCH)
    step, total = 0, epochs * batches
    for _ in range(epochs):
        # rarer languages are repeated up to the most frequent one
        order = np.concatenate([np.resize(rng.permutation(at), most) for at in by_language if len(at)])
        rng.shuffle(order)
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            _, gradients = loss_and_gradients(net, np.ascontiguousarray(pieces[chosen].T), y[chosen])
            norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            clip = np.float32(min(1.0, 1.0 / (norm + 1e-12)))
            step += 1
            rate = np.float32(RATE * (1 - 0.95 * step / total))
            for p, g, (m, v) in zip(net.parameters, gradients, moments, strict=True):
                g = g * clip
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                p -= rate * (m / np.float32(1 - 0.9**step)) / (np.sqrt(v / np.float32(1 - 0.99**step)) + np.float32(1e-8))
    return net


# ---------------------------------------------------------------- prediction
class Labeller:
    """Position and document probabilities of many texts at once."""

    def __init__(self, net: Network):
        self.net, self.hidden = net, net.u[0].shape[0]
        # one table a gate, so that all arrays are contiguous; a sigmoid is a tanh of half its argument
        scale = (np.float32(0.5), np.float32(0.5), np.float32(1))
        self.w, self.u = (
            [[np.ascontiguousarray(part) * s for part, s in zip(np.split(x, 3, axis=1), scale, strict=True)] for x in given]
            for given in (net.w, net.u)
        )
        self.ones = np.ones(len(net.languages), np.float32)
        #: No score is further from zero.
        self.largest = float(np.abs(net.out).sum(axis=0).max() + np.abs(net.bias).max())

    def _run(self, codes: np.ndarray, active: np.ndarray, direction: int) -> np.ndarray:
        """States (time, window, hidden). At time t the first ``active[t]`` windows have a byte."""
        steps, n = codes.shape
        (wz, wr, wc), (uz, ur, uc) = self.w[direction], self.u[direction]
        states = np.zeros((steps, n, self.hidden), np.float32)
        h, z, r, c, g = (np.zeros((n, self.hidden), np.float32) for _ in range(5))
        half = np.float32(0.5)
        for t in range(steps) if direction == 0 else range(steps - 1, -1, -1):
            k = active[t]
            at, now, zk, rk, ck, gk = codes[t, :k], h[:k], z[:k], r[:k], c[:k], g[:k]
            for table, u, gate in ((wz, uz, zk), (wr, ur, rk)):
                table.take(at, axis=0, out=gate, mode="clip")
                np.matmul(now, u, out=gk)
                gate += gk
                np.tanh(gate, out=gate)
                gate *= half
                gate += half
            wc.take(at, axis=0, out=ck, mode="clip")
            np.matmul(now, uc, out=gk)
            gk *= rk
            ck += gk
            np.tanh(ck, out=ck)
            now -= ck
            now *= zk
            now += ck
            states[t, :k] = now
        return states

    def windows(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities (time, window, language) of windows in falling order of length; of no meaning after their ends."""
        n, steps = codes.shape
        active = (lengths[None, :] > np.arange(steps)[:, None]).sum(axis=1)
        by_time = np.ascontiguousarray(codes.T)
        hidden, net = self.hidden, self.net
        scores = self._run(by_time, active, 0).reshape(-1, hidden) @ net.out[:hidden]
        scores += self._run(by_time, active, 1).reshape(-1, hidden) @ net.out[hidden:]
        scores += net.bias
        if self.largest > 60:  # the exponential could overflow
            scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= (scores @ self.ones)[:, None]
        return scores.reshape(steps, n, -1)

    def documents(self, texts: list[bytes], positions: bool = False) -> tuple[np.ndarray, list[bytes] | None]:
        """Mean probabilities (document, language); with ``positions`` also each byte's language number."""
        sums = np.zeros((len(texts), len(self.net.languages)))
        marks = [np.zeros(len(b), np.uint8) for b in texts] if positions else None
        # (document, start of the window's own bytes)
        cuts = [(i, s) for i, b in enumerate(texts) for s in range(0, len(b), WINDOW)]
        spans = [(max(0, s - CONTEXT), min(len(texts[i]), s + WINDOW + CONTEXT)) for i, s in cuts]
        size = np.array([b - a for a, b in spans], np.int64)
        for group in np.split(falling := np.argsort(-size, kind="stable"), range(GROUP, len(falling), GROUP)):
            if not len(group):
                continue
            lengths = size[group]
            codes = np.zeros((len(group), lengths[0]), np.uint8)
            own = np.zeros((len(group), 2), np.int64)
            for row, at in enumerate(group.tolist()):
                (i, s), (a, b) = cuts[at], spans[at]
                codes[row, : b - a] = np.frombuffer(texts[i], np.uint8, b - a, a)
                own[row] = s - a, min(len(texts[i]), s + WINDOW) - a
            p = self.windows(codes, lengths)
            time = np.arange(len(p))[:, None]
            inside = (time >= own[:, 0]) & (time < own[:, 1])
            documents = np.fromiter((cuts[at][0] for at in group.tolist()), np.int64, len(group))
            np.add.at(sums, documents, np.einsum("twl,tw->wl", p, inside.astype(np.float32)).astype(np.float64))
            if marks is not None:
                best = p.argmax(axis=2).astype(np.uint8)
                for row, at in enumerate(group.tolist()):
                    i, s = cuts[at]
                    marks[i][s : s + WINDOW] = best[own[row, 0] : own[row, 1], row]
        lengths = np.array([len(b) for b in texts], np.float64)[:, None]
        return sums / np.maximum(lengths, 1), [m.tobytes() for m in marks] if marks is not None else None


def to_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


# ---------------------------------------------------------------- Spark
def _pieces(text: bytes, seed: int, count: int = PIECES, length: int = PIECE) -> np.ndarray:
    """``count`` pieces at places drawn by the seed; texts shorter than a piece are repeated to its length."""
    whole = np.frombuffer(text, np.uint8)
    if len(whole) <= length:
        return np.resize(whole, (1, length))
    starts = np.random.default_rng(seed).integers(0, len(whole) - length + 1, count)
    return whole[starts[:, None] + np.arange(length)]


def training_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``h, doc_id, lang, text``: of each frequent language the documents with the smallest id hashes."""
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (crc_fold(F.col("doc_id"), 4) != 2)
    )
    ids = stage(usable.select("doc_id", "lang").distinct(), "language-ids")
    frequent = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    # a threshold from the language's count thins the ids where they lie: about 1.2 * per_language of each are ranked
    hashed = ids.join(F.broadcast(frequent), "lang").withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)))
    near = hashed.where(F.col("h") * F.col("count") < HASHES * (1.2 * per_language + 100)).drop("count")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = stage(near.withColumn("_rank", rank).where(F.col("_rank") <= per_language).drop("_rank"), "language-sample")
    # at most LANGUAGES * per_language ids; a document given twice counts once
    found = usable.join(F.broadcast(chosen), ["doc_id", "lang"])
    return found.groupBy("h", "doc_id", "lang").agg(F.min("text").alias("text"))


def learn(docs: DataFrame) -> Network | None:
    """The network of the labelled documents; None if there are none."""

    def make():
        return lambda h, ids, languages, texts: {
            "h": h, "doc_id": ids, "lang": languages,
            "pieces": [_pieces(to_bytes(t), k).tobytes() for t, k in zip(texts, h, strict=True)],
        }

    sample = training_sample(docs)
    schema = StructType([StructField("h", sample.schema["h"].dataType), sample.schema["doc_id"], StructField("lang", StringType()), StructField("pieces", BinaryType())])
    pieces = stage(map_texts(sample, make, schema, "h", "doc_id", "lang", "text"), "language-pieces")
    languages = [r.lang for r in pieces.select("lang").distinct().orderBy("lang").collect()]  # at most LANGUAGES
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    shapes = [p.shape for p in new_network(languages).parameters]

    def run(examples):
        blocks = [np.frombuffer(b, np.uint8).reshape(-1, PIECE) for _, b in examples]
        y = np.repeat([number[name] for name, _ in examples], [len(b) for b in blocks])
        net = train(np.concatenate(blocks), y, languages)
        return [0], np.concatenate([p.reshape(-1) for p in net.parameters])

    _, flat = fit(pieces, run, "lang", "pieces")
    sizes = np.cumsum([int(np.prod(s)) for s in shapes])
    w0, w1, u0, u1, out, bias = (
        part.reshape(s).astype(np.float32) for part, s in zip(np.split(flat, sizes[:-1]), shapes, strict=True)
    )
    return Network(languages, [w0, w1], [u0, u1], out, bias)


def predict(docs: DataFrame, net: Network | None, positions: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document.

    ``positions`` adds ``position_langs``: for each byte of the lower-cased
    text the number of its language (alphabetic order, one byte each).
    """

    def make():
        labeller = Labeller(net) if net else None

        def work(ids, texts):
            known = [t is not None and labeller is not None and any(map(str.isalpha, t)) for t in texts]
            p, marks = (
                labeller.documents([to_bytes(t) if k else b"" for t, k in zip(texts, known, strict=True)], positions)
                if labeller else (None, None)
            )
            best = p.argmax(axis=1) if p is not None else [0] * len(texts)
            out = {
                "doc_id": ids,
                "lang_pred": [net.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)],
                "score": [min(1.0, float(p[i, b])) if k else 0.0 for i, (b, k) in enumerate(zip(best, known, strict=True))],
            }
            if positions:
                out["position_langs"] = pa.array(marks if marks is not None else [b""] * len(texts), pa.binary())
            return out

        return work

    fields = [docs.schema["doc_id"], StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False)]
    if positions:
        fields.append(StructField("position_langs", BinaryType()))
    return map_texts(docs, make, StructType(fields), "doc_id", "text")


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, by a network of the others' languages."""
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False)).cast(BooleanType())
    found = predict(docs, learn(docs))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
