"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

Two texts are linked when the Jaccard similarity of their sets of five-word
shingles is at least 0.8. Words are runs of letters, digits and underscores in
lower case; a shorter text is one shingle of all its words.

1. Texts with the same words are one *text* (counted, never paired); its
   smallest document id stands for it.
2. Every text gets a MinHash signature in bands. Row and band counts come from
   the target recall: the most rows a band whose number of bands still fits
   the hash budget (6 x 28: a pair at 0.8 shares a band with probability
   0.9998, one at 0.3 with 0.02).
3. Band hashes are grouped (a counting aggregation, combined before the
   shuffle); each member of a shared band is tied to the band's smallest text.
   The connected components of these ties hold all candidates.
4. Components are cut into blocks of bounded size by text count and shingle
   count; each pair of blocks is one unit of work that compares the full
   shingle sets as a matrix product. It returns every text's number of links
   and a spanning forest of the links, never the pairs themselves, so a group
   of many near copies yields as many rows as it has texts.
5. Components of the forests are the near-duplicate classes.

Defined cases: null and empty texts have no words: they are one text, without
links; rows that share an id but not the words get their own rows (with the
same id), and rows without an id rank last, by their text; repeated rows are returned as often as
they come; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import given_id, known_id, map_texts, maybe_among, stage
from cdclake.llm.components import connected_components
from cdclake.llm.hashed_text import WordHashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9998
#: Most MinHash values a text.
MAX_HASHES = 180
#: Texts and shingles of a block, about.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 400_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows a band): the most selective bands that reach the recall at the threshold within the hash budget."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the hash budget is too small for the recall")
    return best


def shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of all n-word windows; of the whole text, if it is shorter."""
    if not len(h):
        return np.empty(0, np.uint64)
    n = min(n, len(h))
    s = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        s = s * _MIX + h[j : len(h) - n + 1 + j]
    return np.unique(s ^ (s >> np.uint64(29)))


class MinHash:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(20260)
        self.bands, self.rows = bands, rows
        self.seed = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32)
        self.factor = rng.integers(0, 1 << 32, (bands * rows, 1), dtype=np.uint32) | np.uint32(1)
        self.key = rng.integers(0, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)
        self.start = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def band_hashes(self, s: np.ndarray) -> np.ndarray:
        """One 64-bit number a band (none for an empty set)."""
        if not len(s):
            return np.empty(0, np.int64)
        low = (s >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.bands * self.rows, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 2048):
            np.minimum(least, ((low[at : at + 2048] ^ self.seed) * self.factor).min(axis=1), out=least)
        mixed = (least.reshape(self.bands, self.rows).astype(np.uint64) * self.key).sum(axis=1, dtype=np.uint64) + self.start
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def words_key(h: np.ndarray) -> int:
    """64-bit number of a word sequence."""
    key = xxhash.xxh3_64_intdigest(h.tobytes())
    return key - (1 << 64) if key >> 63 else key


def text_bands(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` (the number of the word sequence), ``n_shingles`` and ``bands`` of every row."""
    bands, rows = choose_bands()
    prepared = docs.select(known_id(id_col, text_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        known, minhash = WordHashes(), MinHash(bands, rows)

        def work(ids, texts):
            out = {"id": ids, "text": [], "n_shingles": [], "bands": []}
            for text in texts:
                h = word_hashes(text, known)
                s = shingles(h)
                out["text"].append(words_key(h))
                out["n_shingles"].append(len(s))
                out["bands"].append(minhash.band_hashes(s))
            return out

        return work

    return map_texts(prepared, make, "id bigint, text bigint, n_shingles int, bands array<bigint>", "id", "text")


def _full_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``members`` (one row a text) with the text's shingle set, as bytes."""
    whole = docs.select(known_id(id_col, text_col).alias("id"), F.col(text_col).alias("whole"))
    kept = [c for c in members.columns if c != "id"]

    def make():
        known = WordHashes()

        def work(*columns):
            *values, wholes = columns
            row = dict(zip(kept, values, strict=True))
            hashes = [word_hashes(w, known) for w in wholes]
            # another text may share the id: its set is not wanted
            return row | {
                "set": [shingles(h).tobytes() if words_key(h) == t else None for h, t in zip(hashes, row["text"], strict=True)]
            }

        return work

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name in kept) + ", set binary"
    # few texts have a candidate partner: the filter spares the others the shuffle
    wanted = maybe_among(whole, "id", members).where("maybe").join(members.hint("merge"), "id")
    found = map_texts(wanted, make, schema, *kept, "whole")
    return found.where("set IS NOT NULL")


def links_between(sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Symmetric boolean matrix: similarity at least ``threshold`` (never with itself)."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(m), size.astype(int))
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((m, m), np.float32)
    at = 0
    while at < len(column):  # a few thousand shared shingles at a time
        end = int(np.searchsorted(column, column[at] + 4096, "left"))
        distinct, index = np.unique(column[at:end], return_inverse=True)
        part = np.zeros((m, len(distinct)), np.float32)
        part[owner[at:end], index] = 1
        common += part @ part.T
        at = end
    both = common.astype(np.float64)
    linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _forest(linked: np.ndarray) -> np.ndarray:
    """For every row, the first row of its component."""
    m = len(linked)
    root = np.full(m, -1)
    for i in range(m):
        if root[i] < 0:
            root[i] = i
            frontier = [i]
            while frontier:
                fresh = np.flatnonzero(linked[frontier].any(axis=0) & (root < 0))
                root[fresh] = i
                frontier = fresh.tolist()
    return root


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links and forests of the components (or of the pair of blocks) of one unit of work."""
    out = [pd.DataFrame({"text": [], "links": [], "root": []}).astype("int64")]
    for (_, first, second), part in rows.groupby(["component", "first", "second"], sort=False):
        part = part.drop_duplicates("text").sort_values("text")
        ids, block = part["text"].to_numpy(), part["block"].to_numpy()
        linked = links_between([np.frombuffer(s, np.uint64) for s in part["set"]])
        if first != second:  # links inside a block are counted where the block meets itself
            linked &= block[:, None] != block[None, :]
        out.append(pd.DataFrame({"text": ids, "links": linked.sum(axis=1).astype("int64"), "root": ids[_forest(linked)]}))
    return pd.concat(out)


def _candidates(rows: DataFrame) -> DataFrame:
    """``text, component`` of every text that shares a band with another one."""
    banded = rows.select("text", F.explode("bands").alias("hash"))
    hubs = banded.groupBy("hash").agg(F.min("text").alias("hub"), F.max("text").alias("far")).where("far > hub")
    ties = banded.join(hubs.drop("far"), "hash").where("text > hub").select("text", "hub")
    return connected_components(ties).select(F.col("id").alias("text"), F.col("root").alias("component"))


def _links(docs: DataFrame, texts: DataFrame, candidates: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text, links, root`` for every unit of work a text takes part in."""
    about = texts.join(candidates, "text")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    sizes = about.groupBy("component").agg(blocks.cast("bigint").alias("blocks"))
    members = about.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("text"), "blocks"))
    sets = stage(_full_sets(docs, members.drop("n_shingles"), id_col, text_col), "sets")
    size, count = sets.agg(F.sum(F.octet_length("set")), F.count("*")).first()
    units = max(1, -(-(size or 0) // (8 * BLOCK_SHINGLES)), -(-count // BLOCK_TEXTS))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    work = sets.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        "text", "component", "block", "set", low.alias("first"), high.alias("second"),
        (F.col("blocks") > 1).alias("split"),
        # small components share units of work; of a large one, every pair of blocks is a unit
        F.when(F.col("blocks") > 1, F.xxhash64("component", low, high))
        .otherwise(F.pmod(F.xxhash64("component"), F.lit(units))).alias("unit"),
    )
    return work.groupBy("split", "unit").applyInPandas(_compare, "text bigint, links bigint, root bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` (never null), ``text_id``, ``class_id`` and ``n_links``, one row per row of ``docs``.

    ``text_id`` is the smallest id with the same words, ``class_id`` the
    smallest one of the near-duplicate class, ``n_links`` the number of other
    texts that are at least 0.8 similar.
    """
    rows = stage(text_bands(docs, id_col, text_col), "bands")
    texts = stage(rows.groupBy("text").agg(F.min("id").alias("id"), F.max("n_shingles").alias("n_shingles")), "texts")
    links = stage(_links(docs, texts, stage(_candidates(rows), "candidates"), id_col, text_col), "links")
    counted = links.groupBy("text").agg(F.sum("links").alias("n_links"))
    roots = connected_components(links.where("text != root").select("text", "root")).withColumnRenamed("id", "text")
    linked = counted.join(texts.select("text", F.col("id").alias("text_id")), "text").join(roots, "text")
    least = linked.groupBy("root").agg(F.min("text_id").alias("class_id"))  # named by the smallest document
    verdict = texts.select("text", F.col("id").alias("text_id")).join(
        linked.join(least, "root").select("text", "class_id", "n_links"), "text", "left"
    )
    # written first: both sides of the last join are then plain shuffles, which the skew join can split by a hot text
    verdict = stage(verdict, "verdict")
    return rows.select("id", "text").join(verdict, "text").select(
        "id", "text_id", F.coalesce("class_id", "text_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_id, class_id, n_links``, one row per row of ``docs``."""
    found = near_duplicates(docs, id_col, text_col)
    return found.select(
        given_id("id").alias("doc_id"), given_id("text_id").alias("text_id"), given_id("class_id").alias("class_id"), "n_links"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of every near-duplicate class: the one with the smallest id.

    Rows that share an id count as one document: they stay or go together,
    but exact repeats of a row are returned once.
    """
    found = stage(near_duplicates(docs, id_col, text_col), "classes")
    each = stage(found.groupBy("id").agg(F.max(F.col("id") == F.col("class_id")).alias("stays"), F.count("*").alias("n")), "verdicts")
    gone = each.where("NOT stays").select("id")
    packed = docs.select(F.struct("*").alias("doc"), known_id(id_col, text_col).alias("id"))
    checked = maybe_among(packed, "id", gone)
    # most rows are certainly not among those that go: they are not shuffled
    rest = checked.where("maybe").join(gone.hint("merge"), "id", "left_anti")
    kept = checked.where("NOT maybe").select("doc").union(rest.select("doc")).select("doc.*")
    repeated = each.where("stays AND n > 1").limit(1).count()
    return kept.distinct() if repeated else kept


def oracle() -> str:
    """The classes and link counts in DuckDB SQL: all pairs of texts that share a shingle."""
    return rf"""WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+') AS words FROM documents),
texts AS (SELECT words, min(doc_id) AS id FROM docs GROUP BY words),
shingle AS (
  SELECT DISTINCT id, array_to_string(words[i:i + least({SHINGLE}, len(words)) - 1], ' ') AS s
  FROM (SELECT id, words, unnest(range(1, greatest(len(words) - {SHINGLE} + 2, 2))) AS i FROM texts WHERE len(words) > 0)),
size AS (SELECT id, count(*) AS n FROM shingle GROUP BY id),
pair AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.id <> b.id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.id = a JOIN size y ON y.id = b
  WHERE common >= {THRESHOLD} * (x.n + y.n - common) - 1e-9),
reach AS (SELECT id, id AS root FROM texts UNION SELECT b, root FROM reach JOIN link ON a = id WHERE root < b),
class AS (SELECT id, min(root) AS class_id FROM reach GROUP BY id),
links AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, id AS text_id, class_id, coalesce(n, 0) AS n_links
FROM docs JOIN texts USING (words) JOIN class USING (id) LEFT JOIN links USING (id)"""
