"""BPE encoding by per-prefix dynamic programming, and decoding.

For a fixed merge list every prefix of a word has exactly one BPE encoding,
and the encoding of a prefix is the encoding of a shorter prefix plus one
last token. So it is enough to store, for every prefix, its last token:

* an automaton over the vocabulary lists the tokens that end at a position;
* such a token is the last one if it encodes to itself and is *compatible*
  with the last token of the prefix before it: encoding the two tokens'
  concatenation gives exactly these two tokens;
* exactly one candidate passes, and back-pointers give the ids.

The time is linear in the word's length (times the number of vocabulary
entries that end at a position), also for words of many thousand characters.
Words are encoded once per Python worker and kept in a bounded cache.

Defined cases: a null or empty text has no tokens and decodes to ''. Special
tokens that appear in a text get their own id. Extra columns are untouched.
"""

from __future__ import annotations

import json

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from cdclake.llm.common import WORD_CACHE_ENTRIES, map_texts, nfc_lower

#: Added to a byte character's code point when it carries the end-of-word mark.
_END = 0x400
_SUFFIX = "</w>"


def byte_characters() -> list[str]:
    """The printable stand-in of every byte, as byte-level vocabularies write them."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Bpe:
    """A word-level BPE vocabulary read from a ``tokenizers`` JSON text."""

    def __init__(self, spec_json: str):
        spec = json.loads(spec_json)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != _SUFFIX or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary with the end-of-word suffix </w> is needed")
        vocab: dict[str, int] = model["vocab"]
        self.tokens: dict[int, str] = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        # merge rank of a pair, and the token it makes; the parts and rank of every merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if (left, right) not in self.rank:
                self.rank[left, right] = r
                self.parts.setdefault(whole, (left, right, r))
        raw = {c: chr(b) for b, c in enumerate(byte_characters())}
        self.automaton = ahocorasick.Automaton()
        self.length: dict[int, int] = {}
        self.alone: dict[int, bool] = {}
        symbols = {i: self._symbols(t, raw) for t, i in vocab.items()}
        self.length = {i: len(x) for i, x in symbols.items()}
        for i, x in symbols.items():
            if self._encodes_to_itself(i):
                self.automaton.add_word(x, (i, len(x)))
        self.automaton.make_automaton()
        # fixed value: the split pattern of the vocabulary, with the White_Space property for its \s
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
        )
        self.white = regex.compile(r"\p{White_Space}+")
        self.odd_space = regex.compile("[\x1c-\x1f]")
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[str, list[int]] = {}

    @staticmethod
    def _symbols(token: str, raw: dict[str, str]) -> str:
        """One character per byte; the last one is shifted when it carries the end-of-word mark."""
        if token.endswith(_SUFFIX) and len(token) > len(_SUFFIX):
            body = "".join(raw[c] for c in token[: -len(_SUFFIX)])
            return body[:-1] + chr(ord(body[-1]) + _END)
        return "".join(raw[c] for c in token)

    def _born(self, token: int) -> int:
        """Rank of the merge that makes the token; -1 for a single symbol."""
        return self.parts[token][2] if token in self.parts else -1

    def _survives(self, left: int, right: int, until: int) -> bool:
        """True if the boundary of two self-encoding tokens survives all merges of a rank below ``until``.

        Step back in time: undo, of the two tokens at the boundary, the one
        made last. While both exist, no merge across the boundary may fire.
        """
        tie_fires = False
        while True:
            across = self.rank.get((left, right))
            if across is not None and (across < until or (tie_fires and across == until)):
                return False
            born_left, born_right = self._born(left), self._born(right)
            if born_left < 0 and born_right < 0:
                return True
            # merges of one rank fire from left to right: the right token's after one across the
            # boundary, the left token's before it
            if born_left > born_right:
                until, tie_fires = born_left, False
                left = self.parts[left][1]
            else:
                until, tie_fires = born_right, True
                right = self.parts[right][0]

    def _encodes_to_itself(self, token: int) -> bool:
        """True if the merges make this token from its own symbols."""
        known = self.alone.get(token)
        if known is None:
            if token not in self.parts:
                known = self.length[token] == 1
            else:
                left, right, made = self.parts[token]
                known = (
                    max(self._born(left), self._born(right)) < made
                    and self._encodes_to_itself(left)
                    and self._encodes_to_itself(right)
                    and self._survives(left, right, made)
                )
            self.alone[token] = known
        return known

    def _fits(self, left: int, right: int) -> bool:
        known = self.pairs[left << 20 | right] = self._survives(left, right, 1 << 60)
        return known

    def _dp(self, symbols: str) -> list[int]:
        last = [-1] * (len(symbols) + 1)
        known, fits, done = self.pairs.get, self._fits, -1
        for end, (token, size) in self.automaton.iter(symbols):
            if end == done:
                continue
            start = end + 1 - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                ok = known(before << 20 | token)
                if ok is None:
                    ok = fits(before, token)
                if not ok:
                    continue
            last[end + 1] = token
            done = end
        ids = []
        at = len(symbols)
        while at:
            token = last[at]
            if token < 0:
                raise ValueError("a symbol of the text is not in the vocabulary")
            ids.append(token)
            at -= self.length[token]
        ids.reverse()
        return ids

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            symbols = word.encode("utf-8").decode("latin-1")
            ids = self._dp(symbols[:-1] + chr(ord(symbols[-1]) + _END))
            if len(word) <= 64:
                if len(self.words) >= WORD_CACHE_ENTRIES:
                    self.words.clear()
                if len(self.pairs) >= 4 * WORD_CACHE_ENTRIES:
                    self.pairs.clear()
                self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> list[int]:
        if chunk.isalpha():
            return self._word(chunk)
        if chunk[-1] in ".,!?" and chunk[:-1].isalpha():
            return self._word(chunk[:-1]) + self._word(chunk[-1])
        ids = [i for word in self.pattern.findall(chunk) for i in self._word(word)]
        if len(chunk) <= 64:
            if len(self.chunks) >= WORD_CACHE_ENTRIES:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        text = nfc_lower(text)
        pieces = self.white.split(text) if self.odd_space.search(text) else text.split()
        words, chunks, chunk, ids = self.words.get, self.chunks.get, self._chunk, []
        extend = ids.extend
        for piece in pieces:
            if piece:
                extend(words(piece) or chunks(piece) or chunk(piece))
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.marks is None or not (found := list(self.marks.finditer(text))):
            return self._plain(text)
        ids, at = [], 0
        for mark in found:
            ids += self._plain(text[at : mark.start()])
            ids.append(self.special[mark.group()])
            at = mark.end()
        return ids + self._plain(text[at:])

    def decode(self, ids: list[int] | None) -> str:
        """The vocabulary names no decoder, so the tokens' texts are joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids or ()))


_LOADED: dict[int, Bpe] = {}


def _load(spec_json: str) -> Bpe:
    """One vocabulary per Python worker and file content."""
    key = hash(spec_json)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(spec_json)
    return _LOADED[key]


def read_vocabulary(spark: SparkSession, path: str):
    """The vocabulary file (a few MB, fixed) as a broadcast; executors never open the path."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col``, ``ids`` (array of int), on request ``decoded``: the ids read back as text, and the columns ``keep``."""
    vocabulary = read_vocabulary(docs.sparkSession, path)
    fields = [
        docs.schema[id_col],
        StructField("ids", ArrayType(IntegerType(), containsNull=False)),
        *([StructField("decoded", StringType())] if decoded else []),
        *(docs.schema[c] for c in keep),
    ]

    def make():
        bpe = _load(vocabulary.value)

        def work(keys, texts, *kept):
            ids = [bpe.encode(t) for t in texts]
            out = {id_col: keys, "ids": ids} | ({"decoded": [bpe.decode(x) for x in ids]} if decoded else {})
            return out | dict(zip(keep, kept, strict=True))

        return work

    return map_texts(docs, make, StructType(fields), id_col, text_col, *keep)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` for rows of token ids (null ids: '')."""
    vocabulary = read_vocabulary(encoded.sparkSession, path)
    fields = [encoded.schema[id_col], StructField("decoded", StringType())]

    def make():
        bpe = _load(vocabulary.value)
        return lambda keys, ids: {id_col: keys, "decoded": [bpe.decode(x) for x in ids]}

    return map_texts(encoded, make, StructType(fields), id_col, ids_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of the ids (decimal, one space between) and of the decoded text."""
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        id_col,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
