"""Vectors compressed to short codes: one codebook per part, assigned with Drake-Hamerly adaptive bounds.

A vector becomes integers ``floor(SCALE * x)`` and is cut into ``PARTS``
consecutive parts. Every part position has a codebook that starts with the
parts of the ``ENTRIES`` smallest ids and is improved by ``ROUNDS`` rounds:
every part goes to its nearest entry (squared Euclidean distance in integers,
ties to the lower index), then each entry becomes the floor of its parts' mean.

After the first assignment a part does not look at all entries again. Its row
persists the ``b`` entries closest to it besides its own, with lower bounds
of their distances in rising order, and one outer bound for all other entries.
When entries move, each lower bound falls by its entry's move and the outer
bound by the largest move. A part whose own distance is below the first lower
bound stays; otherwise entries are verified, with integer distances, as far as
the list's bounds reach below the best distance, and only a part whose best
distance reaches the outer bound looks at all of them. How far down the lists
were needed decides the ``b`` of the next round (between an eighth and a
quarter of the entries).

Assignments run where the rows lie; the state of the rows is written between
rounds. An update gathers one sum for each entry and component (partial sums
in every task first), so only the codebooks, of fixed size, are on the driver.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
components take no part, nor vectors of another than the most common length
(of equally common ones the shorter). Parts differ by one component when the
length is no multiple of their number. Repeated rows are all coded; of several
vectors under one id the smallest one starts an entry. Rows without an id are
coded, but start none. With fewer ids than entries there are fewer entries. An
empty table gives no rows. Other columns than id, vector and label are
ignored. Integers so large that a distance could leave 64 bits are an error.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import small_batches, stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

_STATE = "x binary, own binary, near binary, lower binary, outer binary"


def part_edges(dim: int, parts: int) -> list[tuple[int, int]]:
    """Start and end of every part."""
    cuts = [p * dim // parts for p in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def list_sizes(entries: int) -> tuple[int, int]:
    """Least and greatest number of listed entries."""
    return max(1, entries // 8) if entries > 1 else 0, max(1, entries // 4) if entries > 1 else 0


def _below(distance: np.ndarray) -> np.ndarray:
    """Float32 bounds that are not above the given distances."""
    as_float = distance.astype(np.float32)
    return np.where(as_float > distance, np.nextafter(as_float, np.float32(-np.inf)), as_float)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


#: Rounding of a root or a difference of roots is far below this part of it.
_SAFE = 1e-12


class Bounds:
    """Own entry, closest other entries with lower bounds, and outer bound, of ``n`` parts at one position."""

    def __init__(self, own: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.own, self.near, self.lower, self.outer = own, near, lower, outer

    @classmethod
    def of_all(cls, x: np.ndarray, book: np.ndarray, b: int) -> "Bounds":
        """By all distances."""
        d = ((x[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(d, axis=1, kind="stable")  # ties to the lower index
        near = order[:, 1 : b + 1]
        lower = _below(_roots(np.take_along_axis(d, near, axis=1)) * (1 - _SAFE))
        rest = order[:, b + 1 : b + 2]
        outer = _below(_roots(np.take_along_axis(d, rest, axis=1)[:, 0]) * (1 - _SAFE)) if rest.shape[1] else np.full(len(x), np.inf, np.float32)
        return cls(order[:, 0].astype(np.uint8), near.astype(np.uint8), lower, outer)

    def moved(self, moves: np.ndarray, b: int) -> "Bounds":
        """After the entries moved by at most ``moves``; lists in order again, cut to ``b``."""
        lower = self.lower.astype(np.float64) - moves[self.near] * (1 + _SAFE) - _SAFE
        outer = self.outer.astype(np.float64) - moves.max(initial=0.0) * (1 + _SAFE) - _SAFE
        order = np.argsort(lower, axis=1, kind="stable")
        lower, near = np.take_along_axis(lower, order, axis=1), np.take_along_axis(self.near, order, axis=1)
        if near.shape[1] > b:  # what leaves the list counts as outer
            outer = np.minimum(outer, lower[:, b])
            lower, near = lower[:, :b], near[:, :b]
        return Bounds(self.own, near, _below(lower), _below(outer))

    def assign(self, x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries, set in place; squared distances to them, and how many listed entries each part verified (all: one more than listed)."""
        rows = np.arange(len(x))
        best = ((x - book[self.own]) ** 2).sum(axis=1)
        first, first_square = self.own.copy(), best.copy()
        used = np.zeros(len(x), np.int64)
        open_ = rows
        b = self.near.shape[1]
        verified = []
        for j in range(b):
            # not below the bound: nearer, or as near with a lower index, may lie there
            open_ = open_[_roots(best[open_]) * (1 + _SAFE) >= self.lower[open_, j]]
            if not len(open_):
                break
            entry = self.near[open_, j]
            square = ((x[open_] - book[entry]) ** 2).sum(axis=1)
            verified.append((open_, j, square))
            better = (square < best[open_]) | ((square == best[open_]) & (entry < self.own[open_]))
            won = open_[better]
            best[won], self.own[won] = square[better], entry[better]
            used[open_] = j + 1
        # the outer bound may have fallen below bounds of the list, so every part is held against it
        full = np.flatnonzero(_roots(best) * (1 + _SAFE) >= self.outer)
        for at, j, square in verified:
            self.lower[at, j] = _below(_roots(square) * (1 - _SAFE))
        # a part that left its entry lists it in place of the new one
        changed = np.flatnonzero(self.own != first)
        if len(changed):
            place = (self.near[changed] == self.own[changed, None]).argmax(axis=1)
            self.near[changed, place] = first[changed]
            self.lower[changed, place] = _below(_roots(first_square[changed]) * (1 - _SAFE))
        if len(full):
            again = Bounds.of_all(x[full], book, b)
            self.own[full], self.near[full], self.lower[full], self.outer[full] = again.own, again.near, again.lower, again.outer
            best[full] = ((x[full] - book[again.own]) ** 2).sum(axis=1)
            used[full] = b + 1
        return best, used


@dataclass
class Codebooks:
    """``books[p]``: entries of part ``p``, as an integer array (entry, component)."""

    dim: int
    books: list[np.ndarray]
    #: Of each round after the first: part-rows decided by bounds alone, verified on the list, against all entries.
    work: list[tuple[int, int, int]] = field(default_factory=list)
    #: The last place of a list that the last round verified.
    reached: int = 0

    @property
    def edges(self) -> list[tuple[int, int]]:
        return part_edges(self.dim, len(self.books))

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.reshape(-1).tolist()).encode()).hexdigest()


def _map(df: DataFrame, work, schema: str) -> DataFrame:
    small_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from work(b)

    return df.mapInArrow(run, schema)


def _integers(b: pa.RecordBatch, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(b.column("x").to_pylist()), np.int64).reshape(b.num_rows, dim)


def prepare(table: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int, scale: int) -> tuple[DataFrame, int, int]:
    """``vec_id, label, x`` (integers as bytes) of the rows that take part, their number, and their length."""
    rows = table.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.where(F.size("v") > 0).where(finite)
    # one row a length
    lengths = usable.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")
    ).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return table.sparkSession.createDataFrame([], table.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label")).schema).withColumn("x", F.lit(b"")), 0, 0
    dim, n, largest = lengths[0]
    width = max(b - a for a, b in part_edges(dim, parts))
    if 2 * (scale * largest + 1) >= ((1 << 62) / width) ** 0.5:
        raise ValueError(f"components up to {largest} are too large for exact distances of {width} components in 64 bits")

    def pack(b):
        flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
        x = np.floor(flat * scale).astype(np.int64).reshape(b.num_rows, dim)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "label", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in usable.schema.fields}
    same = usable.where(F.size("v") == dim)
    return stage(_map(same, pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, x binary"), "codes-rows"), n, dim


def first_books(rows: DataFrame, dim: int, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the smallest ids; ``entries`` rows at most come to the driver."""

    def unpack(b):
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(list(_integers(b, dim)), pa.list_(pa.int64()))], ["vec_id", "v"])

    smallest = rows.where("vec_id IS NOT NULL").select("vec_id", "x")
    # several vectors of one id: only ids that may be among the smallest are looked at
    last = smallest.select("vec_id").distinct().orderBy("vec_id").limit(entries)
    candidates = smallest.join(F.broadcast(last), "vec_id")
    chosen = _map(candidates, unpack, f"vec_id {dict(rows.dtypes)['vec_id']}, v array<bigint>").groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    whole = np.array([r.v for r in chosen], np.int64).reshape(len(chosen), dim)
    return [whole[:, a:b].copy() for a, b in part_edges(dim, parts)]


def _pass(rows: DataFrame, books: Codebooks, moves: list[np.ndarray] | None, b: int, before: int) -> DataFrame:
    """One assignment of all rows: the new state, with ``error`` and the places used in the lists.

    ``moves`` is None for the first pass; else how far each entry of each
    part has moved since the state was made, whose lists have ``before`` places.
    """
    parts, edges, dim = len(books.books), books.edges, books.dim

    def work(batch):
        x = _integers(batch, dim)
        n = len(x)
        if moves is not None:
            own = np.frombuffer(b"".join(batch.column("own").to_pylist()), np.uint8).reshape(n, parts)
            near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(n, parts, before)
            lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), np.float32).reshape(n, parts, before)
            outer = np.frombuffer(b"".join(batch.column("outer").to_pylist()), np.float32).reshape(n, parts)
        found, error, places = [], np.zeros(n, np.int64), np.zeros((n, parts), np.int64)
        for p, (start, end) in enumerate(edges):
            part, book = x[:, start:end], books.books[p]
            if moves is None:
                bounds = Bounds.of_all(part, book, b)
                error += ((part - book[bounds.own]) ** 2).sum(axis=1)
            else:
                bounds = Bounds(own[:, p].copy(), near[:, p], lower[:, p], outer[:, p]).moved(moves[p], b)
                best, places[:, p] = bounds.assign(part, book)
                error += best
            found.append(bounds)
        columns = {
            "vec_id": batch.column("vec_id"), "label": batch.column("label"), "x": batch.column("x"),
            "own": _rows_of(np.stack([f.own for f in found], axis=1)), "near": _rows_of(np.stack([f.near for f in found], axis=1)),
            "lower": _rows_of(np.stack([f.lower for f in found], axis=1)), "outer": _rows_of(np.stack([f.outer for f in found], axis=1)),
            "places": _rows_of(places.astype(np.uint8)), "error": pa.array(error),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = dict(rows.dtypes)
    return _map(rows, work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, {_STATE}, places binary, error bigint")


def _rows_of(values: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(v).tobytes() for v in values], pa.binary())


def _sums(state: DataFrame, books: Codebooks, b: int) -> np.ndarray:
    """Sums of the assigned parts (entry, component), then counts (entry, part), then uses of list places (0 to b + 1), flat."""
    parts, edges, dim = len(books.books), books.edges, books.dim
    entries = len(books.books[0])
    slots = entries * dim + entries * parts + b + 2

    def partial(batches):
        total = np.zeros(slots, np.int64)
        sums, counts = total[: entries * dim].reshape(entries, dim), total[entries * dim : entries * (dim + parts)].reshape(entries, parts)
        used = total[entries * (dim + parts) :]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _integers(batch, dim), batch.num_rows
            own = np.frombuffer(b"".join(batch.column("own").to_pylist()), np.uint8).reshape(n, parts)
            for p, (start, end) in enumerate(edges):
                np.add.at(sums[:, start:end], own[:, p], x[:, start:end])
                counts[:, p] += np.bincount(own[:, p], minlength=entries)
            used += np.bincount(np.frombuffer(b"".join(batch.column("places").to_pylist()), np.uint8), minlength=b + 2)
        kept = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": kept.astype(np.int32), "total": total[kept]})

    small_batches(state.sparkSession)
    gathered = state.select("x", "own", "places").mapInArrow(partial, "slot int, total bigint").groupBy("slot").agg(F.sum("total").alias("total"))
    out = np.zeros(slots, np.int64)
    for slot, value in gathered.collect():  # at most ``slots`` rows
        out[slot] = value
    return out


def compress(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of every row that takes part (``code``: one byte a part), and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code byte holds at most 256 entries")
    rows, n, dim = prepare(table, id_col, vector_col, label_col, parts, scale)
    first = first_books(rows, dim, parts, entries) if n else []
    if not n or not len(first[0]):  # no row, or none with an id: nothing to start from
        nothing = rows.where("false").select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return nothing, Codebooks(dim, [np.zeros((0, b - a), np.int64) for a, b in part_edges(dim, parts)])
    books = Codebooks(dim, first)
    size = len(first[0])
    least, b = list_sizes(size)
    state = stage(_pass(rows, books, None, b, 0), "codes-state")
    gathered = _sums(state, books, b)
    for _ in range(rounds):
        sums = gathered[: size * dim].reshape(size, dim)
        counts = gathered[size * dim : size * (dim + parts)].reshape(size, parts)
        new = []
        for p, (start, end) in enumerate(books.edges):
            count = counts[:, p, None]
            # floor division of integers goes down
            new.append(np.where(count > 0, sums[:, start:end] // np.maximum(count, 1), books.books[p]))
        moves = [_roots(((m - o) ** 2).sum(axis=1)) for m, o in zip(new, books.books, strict=True)]
        # lists that were never read to their end get shorter
        following = max(least, books.reached) if books.work else b
        books = Codebooks(dim, new, books.work, books.reached)
        state = stage(_pass(state, books, moves, following, b), "codes-state")
        b = following
        gathered = _sums(state, books, b)
        places = gathered[size * (dim + parts) :]
        books.work.append((int(places[0]), int(places[1 : b + 1].sum()), int(places[b + 1])))
        books.reached = int(np.flatnonzero(places[: b + 1])[-1]) if places[: b + 1].any() else 0
    return state.select("vec_id", "label", F.col("own").alias("code"), "error"), books


def decompress(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: the entries that the codes name, in the measure of the original components."""
    spread = [np.asarray(book, np.float64) / scale for book in books.books]

    def work(b):
        code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, len(spread))
        vectors = np.concatenate([book[code[:, p]] for p, book in enumerate(spread)], axis=1)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(list(vectors), pa.list_(pa.float64()))], ["vec_id", "vector"])

    return _map(codes.select("vec_id", "code"), work, f"vec_id {dict(codes.dtypes)['vec_id']}, vector array<double>")


def digests(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``code`` in hex, ``error``, ``label_error`` (sum over the label's rows) and ``codebooks_sha256``."""
    # written first, so that neither side of the join takes over a partitioning and a common label can be split
    totals = stage(codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    joined = codes.join(totals, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def oracle() -> str:
    """DuckDB SQL for ``digests(*compress(embeddings))`` (for the one length that all vectors of the table have)."""

    def assigned(name: str, books: str) -> str:
        # distance and index in one number: the smallest is the nearest entry, ties to the lower index
        return f"""{name} AS MATERIALIZED (
  SELECT rid, p, w, any_value(v) AS v, min(d * {ENTRIES} + e) AS best
  FROM (SELECT x.rid, x.p, x.w, x.v, b.e, CAST(list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, x.w + 1)]) AS BIGINT) AS d
        FROM parts x JOIN {books} b ON b.p = x.p)
  GROUP BY rid, p, w)"""

    def updated(name: str, old: str, taken: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT o.p, o.e, coalesce(n.v, o.v) AS v FROM {old} o LEFT JOIN (
    SELECT p, e, list(floor_mean ORDER BY i) AS v FROM (
      SELECT p, best % {ENTRIES} AS e, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS floor_mean
      FROM (SELECT *, unnest(range(1, w + 1)) AS i FROM {taken}) GROUP BY ALL)
    GROUP BY p, e) n ON n.p = o.p AND n.e = o.e)"""

    steps, books = [], "books0"
    for r in range(ROUNDS):
        steps += [assigned(f"taken{r}", books), updated(f"books{r + 1}", books, f"taken{r}")]
        books = f"books{r + 1}"
    steps.append(assigned("final", books))
    return f"""WITH kept AS (
  SELECT vec_id, label, [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x,
         row_number() OVER () AS rid
  FROM embeddings
  WHERE len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
parts AS (
  SELECT rid, p, (p + 1) * len(x) // {PARTS} - p * len(x) // {PARTS} AS w, x[p * len(x) // {PARTS} + 1 : (p + 1) * len(x) // {PARTS}] AS v
  FROM kept, range({PARTS}) t(p)),
seeds AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (
    SELECT vec_id, arg_min(rid, x) AS rid FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {ENTRIES})),
books0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN seeds USING (rid)),
{(',' + chr(10)).join(steps)},
codes AS (
  SELECT rid, string_agg(lower(printf('%02x', best % {ENTRIES})), '' ORDER BY p) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
  FROM final GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM {books}) AS codebooks_sha256
FROM codes JOIN kept USING (rid)"""
