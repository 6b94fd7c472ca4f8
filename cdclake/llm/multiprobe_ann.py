"""Approximate nearest neighbours by multiprobe p-stable hashing (Euclidean distance).

Every table hashes a vector by ``M`` Gaussian projections, cut into steps of
width ``w``. A query visits its own bucket and buckets whose steps differ by
one, in the order of their estimated success: a step counts as likely as the
query lies near its border, and the order over all sets of steps comes from
one template of expected border distances that each query maps to its own
sorted borders. The candidates of all tables are merged and ranked by their
exact distance in double precision.

``M``, ``w`` and the number of probes are fitted on a bounded sample
(``SAMPLE_ROWS`` vectors): the width follows the sample's 10th-neighbour
distance, and the most selective ``M`` is taken whose probes, at most
``MOST_PROBES`` a table, find ``TARGET`` of the sample's true neighbours. In
all the vectors neighbours lie nearer than in a sample, so the recall holds.

The index holds every vector in every table. It is cut into blocks by the hash
of the id, so that a vector travels once, and a query's vector once a block:
keys of buckets are worked out where they are looked up and never travel, as
they take 40 times the room of the vector. In a block, a bucket and all queries
that probe it are compared by one matrix product, which only rules pairs out
(with a bound for its rounding); the others get their exact distance. A block
returns each query's nearest only. Of equal vectors only the ``k + 1`` smallest
ids can be in a result, so only these are indexed, and equal queries are
searched once. Queries that found fewer than ``k`` are searched exactly, in the
same blocks. The driver holds the sample and counts only: no side of these
comparisons is broadcast.

Defined cases: vectors that are null, empty, all zero, or hold null or
non-finite components take no part, nor rows without an id, nor vectors of
another than the most common length; repeated rows count once; of several
vectors under one id the nearest counts; fewer than
``k`` candidates give fewer rows; an empty table gives none; extra columns
are ignored. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cdclake.llm.common import hash_sample, small_batches, stage

K = 10
TABLES = 4
TARGET = 0.97
MOST_PROBES = 1024
SAMPLE_ROWS, SAMPLE_QUERIES, SAMPLE_NUMBERS = 8192, 128, 4_000_000
#: Step width in 10th-neighbour distances.
WIDTH = 2.7
#: Rows of a block, at least (unless there are fewer); numbers of a block's vectors, and of a chunk of queries, at most.
CELL_ROWS = 40_960
BLOCK_NUMBERS = 6_000_000
#: Per worker: queries whose probes are worked out together, visits (a query in a bucket) and numbers held at once.
PROBE_QUERIES, VISITS, TILE_NUMBERS = 256, 3_000_000, 1_000_000
#: Visits of fewer pairs (of query and vector) are gathered and compared together.
FEW_PAIRS = 256


def probe_template(m: int, probes: int) -> np.ndarray:
    """0/1 matrix: which of the 2m borders (nearest first) each probe crosses, likeliest probes first."""
    j = np.arange(1, 2 * m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)  # expected squared distance of the j-th nearest border
    found: list[tuple[int, ...]] = [()]
    heap = [(float(cost[0]), (0,))]
    while heap and len(found) < probes:
        total, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - c not in chosen for c in chosen):  # not both borders of one projection
            found.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    out = np.zeros((len(found), 2 * m), np.int8)
    for i, chosen in enumerate(found):
        out[i, list(chosen)] = 1
    return out


class Hashing:
    """Projections of all tables; small (tables x m x dimension numbers)."""

    def __init__(self, dim: int, m: int, width: float, probes: int, tables: int = TABLES):
        rng = np.random.default_rng(7)
        self.m, self.tables = m, tables
        self.project = rng.standard_normal((dim, tables * m)) / width
        self.shift = rng.random(tables * m)
        self.mix = rng.integers(1, 1 << 63, tables * m, dtype=np.uint64) | np.uint64(1)
        self.template = probe_template(m, probes).astype(np.int64)
        #: The first, second, ... border that each probe crosses; 2m where it crosses no more.
        each = [np.flatnonzero(t) for t in self.template]
        self.crossed = np.array([[e[i] if i < len(e) else 2 * m for e in each] for i in range(max(map(len, each)))], np.int64)

    def _steps(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.project + self.shift

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of every vector in every table: (n, tables)."""
        steps = np.floor(self._steps(vectors)).astype(np.int64).view(np.uint64)
        return self._key(steps)

    def _key(self, steps: np.ndarray) -> np.ndarray:
        shape = (len(steps), self.tables, self.m)
        return self._scramble((steps.reshape(shape) * self.mix.reshape(self.tables, self.m)).sum(axis=2, dtype=np.uint64))

    def _scramble(self, key: np.ndarray) -> np.ndarray:
        salted = key + np.arange(1, self.tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        salted = (salted ^ (salted >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (salted ^ (salted >> np.uint64(32))).view(np.int64)

    def probes(self, vector: np.ndarray) -> np.ndarray:
        """Buckets to visit in every table: (probes, tables), likeliest first."""
        return self.all_probes(vector[None])[:, 0]

    def all_probes(self, vectors: np.ndarray) -> np.ndarray:
        """:meth:`probes` of every vector: (probes, n, tables)."""
        shape = (len(vectors), self.tables, self.m)
        steps = self._steps(vectors)
        base = np.floor(steps)
        inside = (steps - base).reshape(shape)
        mix = self.mix.reshape(self.tables, self.m)
        key = (base.astype(np.int64).view(np.uint64).reshape(shape) * mix).sum(axis=2, dtype=np.uint64)
        border = np.concatenate([inside, 1 - inside], axis=2)
        order = np.argsort(border, axis=2, kind="stable")
        move = np.where(order < self.m, -1, 1).astype(np.int64).view(np.uint64) * mix[np.arange(self.tables)[:, None], order % self.m]
        move = np.concatenate([np.moveaxis(move, 2, 0), np.zeros((1, *shape[:2]), np.uint64)])  # the last: no move
        out = np.repeat(key[None], len(self.template), axis=0)
        for crossed in self.crossed:
            out += move[crossed]
        return self._scramble(out)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(axis=1))


def fit(sample: np.ndarray, n: int) -> Hashing:
    """Parameters from the sample, for an index of ``n`` vectors."""
    size, dim = sample.shape
    queries = np.arange(0, size, max(1, size // SAMPLE_QUERIES))[:SAMPLE_QUERIES]
    near, tenth = [], []
    for q in queries:
        d = distances(sample, sample[q])
        d[q] = np.inf
        first = np.argsort(d, kind="stable")[: min(K, size - 1)]
        near.append(first)
        if len(first):
            tenth.append(d[first[-1]])
    width = WIDTH * float(np.median(tenth)) if tenth and np.median(tenth) > 0 else 1.0
    best = None
    for m in range(min(20, max(4, int(np.log2(max(n, 2))) - 1)), 3, -2):
        hashing = Hashing(dim, m, width, MOST_PROBES)
        keys = hashing.keys(sample)
        hits = np.zeros(len(hashing.template))
        for q, first in zip(queries, near, strict=True):
            probes = hashing.probes(sample[q])
            for v in first:  # the first probe, over all tables, that meets the neighbour
                met = (probes == keys[v]).any(axis=1)
                if met.any():
                    hits[met.argmax()] += 1
        recall = np.cumsum(hits) / max(1, sum(map(len, near)))
        if recall[-1] >= TARGET or m <= 5 or not len(queries):
            probes = int(np.searchsorted(recall, min(TARGET, recall[-1]))) + 1
            best = Hashing(dim, m, width, max(8, probes))
            break
    return best


def _usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where("vec_id IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0))


def _matrix(packed, dim: int) -> np.ndarray:
    """Rows of :func:`_pack`, as doubles."""
    flat = b"".join(packed)
    return np.frombuffer(flat, f"f{len(flat) // (len(packed) * dim)}").reshape(len(packed), dim).astype(np.float64)


def _map_vectors(df: DataFrame, work, schema: str) -> DataFrame:
    """``work(batch as dict of columns) -> dict of output columns``."""
    small_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict(work(b))

    return df.mapInArrow(run, schema)


def _pack(df: DataFrame, number: str) -> DataFrame:
    """Vectors as bytes of numbers of type ``number``, in which they must be exact."""

    def work(b):
        flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(b.num_rows, -1).astype(number)
        return {"vec_id": b.column("vec_id"), "h": b.column("h"), "v": [r.tobytes() for r in rows]}

    return _map_vectors(df.select("vec_id", "h", "v"), work, "vec_id bigint, h bigint, v binary")


class _Best:
    """The ``K + 1`` nearest distinct ids of every query among the vectors it is offered, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray):
        self.ids, self.vectors, self.queries = ids, vectors, queries
        # half the squared distance is size - product, from one product of the lengthened vectors
        with np.errstate(over="ignore"):
            norm, self.size = (vectors**2).sum(axis=1), (queries**2).sum(axis=1) / 2
            self.right = np.column_stack([vectors, -norm / 2])
        self.left = np.column_stack([queries, np.ones(len(queries))])
        self.slack = 16 * (vectors.shape[1] + 4) * np.finfo(float).eps * (norm.max() + 2 * self.size) + 1e-290
        self.plain = not (norm.max() < 1e290 and self.size.max() < 1e290)  # products may overflow
        #: Pairs whose product is smaller can't be among the nearest.
        self.low = np.full(len(queries), -np.inf)
        #: So many vectors hold K + 1 ids.
        self.enough = (K + 1) * int(np.unique(ids, return_counts=True)[1].max())
        self.q, self.row, self.d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.new: list[np.ndarray] = []
        self.n_new = 0

    def offer(self, q: np.ndarray, rows: np.ndarray) -> None:
        """All of ``rows`` to all of the queries ``q``; both are distinct."""
        for part in np.split(q, range(TILE_NUMBERS // 64, len(q), TILE_NUMBERS // 64)):
            step = max(1, TILE_NUMBERS // len(part))
            for at in range(0, len(rows), step):
                self._tile(part, rows[at : at + step])

    def _tile(self, q: np.ndarray, rows: np.ndarray) -> None:
        if self.plain:
            self._take(np.repeat(q, len(rows)), np.tile(rows, len(q)))
            return
        product = self.left[q] @ self.right[rows].T
        first = np.flatnonzero(np.isneginf(self.low[q])) if len(rows) > self.enough else []
        if len(first):
            some = product[first]
            some.partition(len(rows) - self.enough, axis=1)
            self.low[q[first]] = some[:, len(rows) - self.enough] - 2 * self.slack[q[first]]
        i, j = np.divmod(np.flatnonzero(product >= self.low[q][:, None]), len(rows))
        self._take(q[i], rows[j])

    def offer_pairs(self, q: np.ndarray, rows: np.ndarray) -> None:
        step = max(1, TILE_NUMBERS // self.left.shape[1])
        for at in range(0, len(q), step):
            i, j = q[at : at + step], rows[at : at + step]
            if not self.plain:
                near = np.einsum("ij,ij->i", self.left[i], self.right[j]) >= self.low[i]
                i, j = i[near], j[near]
            self._take(i, j)

    def _take(self, q: np.ndarray, rows: np.ndarray) -> None:
        if len(q):
            self.new.append(q * len(self.ids) + rows)
            self.n_new += len(q)
            if self.n_new > max(TILE_NUMBERS // 4, 4 * len(self.q)):
                self._merge()

    def _merge(self) -> None:
        pairs = np.unique(np.concatenate(self.new or [np.empty(0, np.int64)]))
        self.new, self.n_new = [], 0
        q, row = np.divmod(pairs, len(self.ids))
        d, step = np.empty(len(pairs)), max(1, TILE_NUMBERS // self.vectors.shape[1])
        for at in range(0, len(pairs), step):
            own = slice(at, at + step)
            d[own] = distances(self.vectors[row[own]], self.queries[q[own]])
        q, row, d = np.concatenate([self.q, q]), np.concatenate([self.row, row]), np.concatenate([self.d, d])
        ids = self.ids[row]
        order = np.lexsort((d, ids, q))  # of an id the nearest
        q, row, d, ids = q[order], row[order], d[order], ids[order]
        other = np.ones(len(q), bool)
        other[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, row, d, ids = q[other], row[other], d[other], ids[other]
        order = np.lexsort((ids, d, q))
        q, row, d = q[order], row[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == K
        with np.errstate(over="ignore", invalid="ignore"):
            low = self.size[q[last]] - d[last] ** 2 / 2 - self.slack[q[last]]
        self.low[q[last]] = np.maximum(self.low[q[last]], low)
        self.q, self.row, self.d = q[place <= K], row[place <= K], d[place <= K]

    def results(self, query_ids: np.ndarray) -> pd.DataFrame:
        self._merge()
        return pd.DataFrame({"query_id": query_ids[self.q], "vec_id": self.ids[self.row], "score": self.d})


class _Buckets:
    """The buckets of a block's vectors, over all tables."""

    def __init__(self, hashing: Hashing, vectors: np.ndarray):
        self.hashing = hashing
        flat = hashing.keys(vectors).view(np.uint64).reshape(-1)
        order = np.argsort(flat)
        self.rows = order // hashing.tables
        self.keys, start = np.unique(flat[order], return_index=True)
        self.start = np.append(start, len(flat))
        # buckets by the first bits of their keys
        self.bits = np.uint64(64 - max(1, min(20, int(len(self.keys)).bit_length() + 4)))
        first = self.keys >> self.bits
        self.by_bits = np.searchsorted(first, np.arange((1 << (64 - int(self.bits))) + 1, dtype=np.uint64))
        self.chain = int(np.diff(self.by_bits).max())

    def visits(self, queries: np.ndarray, at: int) -> np.ndarray:
        """Bucket * 2^32 + query, for all buckets that the queries (counted from ``at``) probe."""
        probes = self.hashing.all_probes(queries).view(np.uint64)
        query = np.broadcast_to(np.arange(at, at + len(queries))[:, None], probes.shape[1:])
        query = np.broadcast_to(query, probes.shape).reshape(-1)
        probes = probes.reshape(-1)
        bits = (probes >> self.bits).astype(np.int64)
        bucket, end = self.by_bits[bits], self.by_bits[bits + 1]
        out = []
        for _ in range(self.chain):
            left = np.flatnonzero(bucket < end)
            probes, query, bucket, end = probes[left], query[left], bucket[left], end[left]
            hit = self.keys[bucket] == probes
            out.append((bucket[hit] << 32) + query[hit])
            bucket = bucket + 1
        return np.concatenate(out)

    def compare(self, visits: np.ndarray, best: _Best) -> None:
        """Offers every query the vectors in the buckets it visits; sorts ``visits``."""
        visits.sort()
        bucket, query = (visits >> 32).astype(np.int32), visits.astype(np.int32)  # the lower half
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        end = np.append(begin[1:], len(bucket))
        which = bucket[begin]
        rows = self.start[which + 1] - self.start[which]
        pairs = rows * (end - begin)
        for i in np.argsort(-pairs, kind="stable")[: int((pairs >= FEW_PAIRS).sum())]:
            best.offer(query[begin[i] : end[i]].astype(np.int64), self.rows[self.start[which[i]] : self.start[which[i] + 1]])
        few = np.repeat(pairs < FEW_PAIRS, end - begin)
        bucket, query = bucket[few], query[few]
        for at in range(0, len(bucket), VISITS // FEW_PAIRS):
            b, q = bucket[at : at + VISITS // FEW_PAIRS], query[at : at + VISITS // FEW_PAIRS].astype(np.int64)
            n = self.start[b + 1] - self.start[b]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            best.offer_pairs(np.repeat(q, n), self.rows[np.repeat(self.start[b], n) + inside])


def _nothing() -> pd.DataFrame:
    return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


_RESULT = "query_id bigint, vec_id bigint, score double"


def _compared(base: DataFrame, searches: DataFrame, n: int, count: int, dim: int, compare) -> DataFrame:
    """Each search's nearest by ``compare(best)``: blocks of the ``n`` vectors against chunks of the ``count`` searches."""
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n * dim // BLOCK_NUMBERS), min(-(-n // CELL_ROWS), parts))
    chunks = max(1, -(-count * dim // BLOCK_NUMBERS))

    def work(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return _nothing()
        best = _Best(rows["vec_id"].to_numpy(), _matrix(rows["v"], dim), _matrix(queries["q"], dim))
        compare(best)
        return best.results(queries["query_id"].to_numpy())

    left = base.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "vec_id", "v",
    )
    right = searches.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(chunks)).cast("int").alias("chunk"),
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"),
    )
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(work, _RESULT)


def _search(base: DataFrame, searches: DataFrame, hashing: Hashing, n: int, count: int, dim: int) -> DataFrame:
    """The nearest that the probes of every search meet, by block."""

    def probe(best: _Best) -> None:
        buckets, visits, held = _Buckets(hashing, best.vectors), [], 0
        for at in range(0, len(best.queries), PROBE_QUERIES):
            visits.append(buckets.visits(best.queries[at : at + PROBE_QUERIES], at))
            held += len(visits[-1])
            if held > VISITS or at + PROBE_QUERIES >= len(best.queries):
                together, visits, held = np.concatenate(visits), [], 0
                buckets.compare(together, best)

    return _compared(base, searches, n, count, dim, probe)


def _exact(base: DataFrame, searches: DataFrame, n: int, count: int, dim: int) -> DataFrame:
    """The nearest of every search among all vectors."""
    return _compared(base, searches, n, count, dim, lambda best: best.offer(np.arange(len(best.queries)), np.arange(len(best.ids))))


def nearest(table: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``K`` nearest found of every row for which ``is_query(id column)`` holds."""
    usable = _usable(table, id_col, vector_col)
    # the common length; the counts are one row a length
    lengths = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    spark = table.sparkSession
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = lengths[0].d
    same = usable.where(F.size("v") == dim).withColumn("h", F.xxhash64(F.transform("v", lambda x: x + F.lit(0.0))))
    # floats stay floats while they travel; all else is packed as doubles
    number = "f4" if isinstance(getattr(table.select(vector_col).schema[0].dataType, "elementType", None), FloatType) else "f8"

    def distinct(some: DataFrame) -> DataFrame:
        return _pack(some, number).dropDuplicates(["vec_id", "h"])

    copies = Window.partitionBy("h").orderBy("vec_id")
    base = stage(distinct(same).withColumn("r", F.row_number().over(copies)).where(f"r <= {K + 1}").drop("r"), "distinct-vectors")
    asked = stage(distinct(same.where(is_query(F.col("vec_id")))), "asked")
    searches = stage(asked.withColumn("r", F.row_number().over(copies)).where("r = 1").drop("r"), "searches")

    n = base.count()
    most = min(SAMPLE_ROWS, max(256, SAMPLE_NUMBERS // dim))
    sample = hash_sample(base, "vec_id", most).select("v").collect()
    hashing = fit(_matrix([r.v for r in sample], dim), n)
    met = stage(_search(base, searches, hashing, n, searches.count(), dim), "met")
    enough = met.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(f"n >= {min(n, K + 1)}")
    short = searches.join(enough.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    missing = short.count()
    if missing:
        met = met.union(stage(_exact(base, short, n, missing, dim), "exact"))
    merged = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    # back from distinct query vectors to all queries that have them
    queries = asked.select(F.col("vec_id").alias("asked"), "h").join(
        searches.select(F.col("vec_id").alias("query_id"), "h"), "h"
    )
    near = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = merged.withColumn("r", F.row_number().over(near)).where(f"r <= {K + 1}").drop("r")
    pairs = queries.join(top, "query_id").where("asked != vec_id")
    rank = F.row_number().over(Window.partitionBy("asked").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(f"rank <= {K}").select(
        F.col("asked").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
