"""Whitening of vectors: the leading principal components by block Jacobi-Davidson, without a covariance matrix.

A component ``c`` becomes the integer ``x = floor(SCALE * c) + OFFSET``. The
covariance ``V`` of the ``x`` (over all rows, divisor ``n``, centred first) is
only ever met as a product with a few vectors: every task centres its rows,
multiplies them with the vectors and back, and one sum for each number of the
product is gathered (``dimension * block`` numbers, whatever the rows).

Jacobi-Davidson finds the eigenvectors: Rayleigh-Ritz in a search space gives
approximate pairs; for those that have not converged the projected correction
equation ``(I - QQ')(V - theta I)(I - QQ') t = -r`` is solved by some steps of
MINRES, all corrections side by side so that a step is one product; the
corrections widen the space. Pairs whose residual has reached double
precision are locked, in falling order, and the space is kept orthogonal to
them. Restarts keep the space below ``SPACE`` times the wanted components.

Sums of ``x`` and the deviations are exact integers. Centring takes off the
integer part of the mean first, so nothing is lost to the large offset.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries take no part, nor vectors of another than the most common length (of
equally common ones the shorter). Repeated rows and ids count as often as
given; rows without an id are kept. Fewer dimensions than wanted components
give fewer components; so do vectors that do not vary in that many
directions (an eigenvalue below ``RANK`` of the largest), down to no rows at
all. A deviation beyond 64 bits is null. An empty table gives no rows. Other
columns than id and vector are ignored. Entries beyond ``LARGEST`` in size
are an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import small_batches, stage

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
LARGEST = float(1 << 40)
#: Residual, against the largest eigenvalue, at which a pair has reached double precision.
PRECISION = 64 * np.finfo(float).eps
RANK = 1e-12
GUARD, SPACE, INNER, OUTER = 4, 3, 10, 60

Product = Callable[[np.ndarray], np.ndarray]


# ---------------------------------------------------------------- eigenvectors
def minres(product: Product, shifts: np.ndarray, basis: np.ndarray, rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of the projected equations, one a column, side by side."""

    def project(x: np.ndarray) -> np.ndarray:
        x = x - basis @ (basis.T @ x)
        return x - basis @ (basis.T @ x)

    def norms(x: np.ndarray) -> np.ndarray:
        return np.sqrt((x * x).sum(axis=0))

    tiny = np.finfo(float).tiny
    before, now = np.zeros_like(rhs), project(rhs)
    beta = start = norms(now)
    live = beta > 0
    x, w, w_before = (np.zeros_like(rhs) for _ in range(3))
    last_beta = np.ones_like(beta)
    d_bar, epsilon, phi_bar = np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    cs, sn = -np.ones_like(beta), np.zeros_like(beta)
    for step in range(steps):
        live = live & (phi_bar > tolerance * start) & (beta > 1e-14 * start)
        if not live.any():
            break
        v = np.where(live, now / np.maximum(beta, tiny), 0.0)
        y = project(product(v) - v * shifts)
        if step:
            y = y - before * (beta / last_beta)
        alpha = (v * y).sum(axis=0)
        y = y - now * (alpha / np.maximum(beta, tiny))
        before, now, last_beta, beta = now, y, np.maximum(beta, tiny), norms(y)
        old_epsilon, delta, g_bar = epsilon, cs * d_bar + sn * alpha, sn * d_bar - cs * alpha
        epsilon, d_bar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(g_bar, beta), tiny)
        cs, sn = g_bar / gamma, beta / gamma
        phi, phi_bar = cs * phi_bar, sn * phi_bar
        direction = (v - w_before * old_epsilon - w * delta) / gamma
        w_before, w = w, direction
        x = x + np.where(live, direction * phi, 0.0)
    return project(x)


def _orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the (orthonormal) bases."""
    for _ in range(3):
        for basis in bases:
            new = new - basis @ (basis.T @ new)
        sizes = np.sqrt((new * new).sum(axis=0))
        new = new[:, sizes > 0] / sizes[sizes > 0]
        if not new.shape[1]:
            return new
        q, s, _ = np.linalg.svd(new, full_matrices=False)
        new = q[:, s > 1e-8 * s[0]]
    return new


@dataclass
class Pairs:
    """Eigenvalues in falling order with unit eigenvectors (columns), residuals, and products asked for."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int = 0


def jacobi_davidson(product: Product, dim: int, wanted: int, precision: float = PRECISION, seed: int = 3) -> Pairs:
    """The ``wanted`` largest eigenpairs of a symmetric positive operator that is only known by its products."""
    wanted = min(wanted, dim)
    count = 0

    def asked(x: np.ndarray) -> np.ndarray:
        nonlocal count
        count += 1
        return product(x)

    rng = np.random.default_rng(seed)
    block = min(dim, wanted + GUARD)
    locked, locked_values = np.zeros((dim, 0)), np.zeros(0)
    space = _orthonormal(rng.standard_normal((dim, block)))
    images = asked(space)
    best, stuck = np.inf, 0
    for outer in range(OUTER):
        # Rayleigh-Ritz
        h = space.T @ images
        values, z = np.linalg.eigh((h + h.T) / 2)
        values, z = values[::-1], z[:, ::-1]
        space, images = space @ z, images @ z
        residual = images - space * values
        if locked.shape[1]:
            residual -= locked @ (locked.T @ residual)
        sizes = np.sqrt((residual * residual).sum(axis=0))
        top = max(abs(values[0]) if len(values) else 0.0, locked_values.max(initial=0.0))
        missing = wanted - locked.shape[1]
        done = sizes[:missing] <= precision * top
        worst = sizes[:missing].max(initial=0.0)
        best, stuck = (worst, 0) if worst < best / 2 else (best, stuck + 1)
        whole = locked.shape[1] + space.shape[1] == dim
        if whole or (stuck >= 4 and worst <= 1e3 * precision * top):  # nothing left to add; or the products' rounding is reached
            done[:] = True
        lead = len(done) if done.all() else int(done.argmin())
        if lead:
            locked = np.concatenate([locked, space[:, :lead]], axis=1)
            locked_values = np.concatenate([locked_values, values[:lead]])
            space, images, values, residual, sizes = space[:, lead:], images[:, lead:], values[lead:], residual[:, lead:], sizes[lead:]
            best, stuck = np.inf, 0
        missing = wanted - locked.shape[1]
        if not missing:
            break
        if space.shape[1] + missing > min(dim, SPACE * block):  # restart with the leading vectors
            kept = min(space.shape[1], max(missing + GUARD, min(dim, SPACE * block) - missing))
            space, images = space[:, :kept], images[:, :kept]
        open_ = np.flatnonzero(sizes[:missing] > precision * top)
        targets = np.concatenate([locked, space[:, :missing]], axis=1)
        correction = minres(asked, values[open_], targets, -residual[:, open_], INNER, 0.5 ** (outer + 2))
        new = _orthonormal(correction, locked, space)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((dim, 1)), locked, space)
        new = new[:, : dim - locked.shape[1] - space.shape[1]]
        space, images = np.concatenate([space, new], axis=1), np.concatenate([images, asked(new)], axis=1)
    if locked.shape[1] < wanted:
        raise RuntimeError(f"{locked.shape[1]} of {wanted} eigenpairs converged in {OUTER} rounds")
    # all locked pairs together once more: their order and residuals from one product
    locked = _orthonormal_columns(locked)
    images = asked(locked)
    h = locked.T @ images
    values, z = np.linalg.eigh((h + h.T) / 2)
    values, z = values[::-1], z[:, ::-1]
    vectors = locked @ z
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    residual = images @ z - vectors * values
    return Pairs(values, vectors, np.sqrt((residual * residual).sum(axis=0)), count)


def _orthonormal_columns(x: np.ndarray) -> np.ndarray:
    """The same columns, made orthonormal as far as rounding left them otherwise."""
    q, r = np.linalg.qr(x)
    return q * np.sign(np.diag(r))


# ---------------------------------------------------------------- Spark
def _map(df: DataFrame, work, schema: str) -> DataFrame:
    small_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield work(b)

    return df.mapInArrow(run, schema)


def _integers(b: pa.RecordBatch, dim: int) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64).reshape(-1, dim) for x in b.column("x").to_pylist()]


def prepare(table: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    """Blocks ``ids, x`` (integers of all the block's rows as bytes) of the rows that take part, and their length."""
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = rows.where(F.size("v") > 0).where(finite)
    kind = dict(rows.dtypes)["vec_id"]
    lengths = usable.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")
    ).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return table.sparkSession.createDataFrame([], f"ids array<{kind}>, x binary"), 0
    dim, _, largest = lengths[0]
    if largest > LARGEST:
        raise ValueError(f"an entry of {largest} is beyond {LARGEST}")

    def pack(b):
        flat = b.column("v").flatten().to_numpy(zero_copy_only=False)
        x = np.floor(flat * scale).astype(np.int64) + offset
        ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("vec_id"))
        return pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return stage(_map(usable.where(F.size("v") == dim), pack, f"ids array<{kind}>, x binary"), "whitening-blocks"), dim


def _summed(blocks: DataFrame, shape: tuple[int, ...], partial, kind: str = "double") -> np.ndarray:
    """The sum over all blocks of ``partial(block)``: partial sums in every task, then one sum for each number."""
    size = int(np.prod(shape))
    small_batches(blocks.sparkSession)

    def run(batches):
        total = None
        for b in batches:
            for x in b.column("x").to_pylist():
                part = partial(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(size, dtype=np.int32), "value": total.reshape(-1)})

    out = np.zeros(size, np.float64 if kind == "double" else np.int64)
    # at most ``size`` rows come back
    for at, value in blocks.select("x").mapInArrow(run, f"at int, value {kind}").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    return out.reshape(shape)


@dataclass
class Fit:
    """What whitening needs of the corpus; all of fixed size."""

    n: int
    dim: int
    sums: list[int]
    trace: float
    pairs: Pairs
    #: Largest distance of an integer from the integer part of its dimension's mean.
    widest: int

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rests(self) -> np.ndarray:
        """The mean less its integer part."""
        return np.array([s % self.n for s in self.sums], np.float64) / self.n


def _centred(x: bytes, dim: int, floors: np.ndarray, rests: np.ndarray) -> np.ndarray:
    return (np.frombuffer(x, np.int64).reshape(-1, dim) - floors).astype(np.float64) - rests


def fit(blocks: DataFrame, dim: int, components: int = COMPONENTS) -> Fit | None:
    """None without rows."""

    def sums(x: bytes) -> np.ndarray:
        rows = np.frombuffer(x, np.int64).reshape(-1, dim)
        return np.append(rows.sum(axis=0), len(rows))

    totals = _summed(blocks, (dim + 1,), sums, "bigint") if dim else np.zeros(1, np.int64)
    n = int(totals[-1])
    if not n:
        return None
    found = Fit(n, dim, [int(s) for s in totals[:-1]], 0.0, Pairs(np.zeros(0), np.zeros((dim, 0)), np.zeros(0)), 0)
    floors, rests = found.floors, found.rests

    def far(batches):
        for b in batches:
            rows = [np.abs(np.frombuffer(x, np.int64).reshape(-1, dim) - floors).max() for x in b.column("x").to_pylist()]
            yield pa.RecordBatch.from_pydict({"far": np.array(rows, np.int64)})

    found.widest = blocks.select("x").mapInArrow(far, "far bigint").agg(F.max("far")).first()[0]
    found.trace = float(_summed(blocks, (1,), lambda x: np.array([(_centred(x, dim, floors, rests) ** 2).sum()]))[0]) / n
    if not found.trace:
        return found

    def product(q: np.ndarray) -> np.ndarray:
        def partial(x: bytes) -> np.ndarray:
            y = _centred(x, dim, floors, rests)
            return y.T @ (y @ q)

        return _summed(blocks, q.shape, partial) / n

    pairs = jacobi_davidson(product, dim, components)
    some = pairs.values > RANK * pairs.values[0]
    found.pairs = Pairs(pairs.values[some], pairs.vectors[:, some], pairs.residuals[some], pairs.products)
    return found


def identity_error(blocks: DataFrame, found: Fit) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity."""
    k, dim, floors, rests = len(found.pairs.values), found.dim, found.floors, found.rests
    turn = found.pairs.vectors / np.sqrt(found.pairs.values)
    mean = _summed(blocks, (k,), lambda x: (_centred(x, dim, floors, rests) @ turn).sum(axis=0)) / found.n

    def products(x: bytes) -> np.ndarray:
        w = _centred(x, dim, floors, rests) @ turn - mean
        return w.T @ w

    return float(np.abs(_summed(blocks, (k, k), products) / found.n - np.eye(k)).max())


def _deviations(x: np.ndarray, found: Fit) -> list[int | None]:
    """Sums of ``(n * x - S)**2`` as exact integers; None beyond 64 bits."""
    most = found.n * (found.widest + 1)
    rest = [s % found.n for s in found.sums]
    if found.dim * most * most < 1 << 63:
        d = found.n * (x - found.floors) - np.array(rest, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = found.n * (x - found.floors).astype(object) - np.array(rest, object)
    return [s if s < 1 << 63 else None for s in (d * d).sum(axis=1).tolist()]


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """``vec_id, whitened (array), deviation, n, explained (array), identity_error`` of every row that takes part."""
    blocks, dim = prepare(table, id_col, vector_col, scale, offset)
    found = fit(blocks, dim, components)
    kind = dict(table.select(F.col(id_col).alias("vec_id")).dtypes)["vec_id"]
    schema = f"vec_id {kind}, whitened array<double>, deviation bigint"
    if found is None or not len(found.pairs.values):
        rows = table.sparkSession.createDataFrame([], schema)
        return rows.withColumns({"n": F.lit(0).cast("bigint"), "explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)})
    turn = found.pairs.vectors / np.sqrt(found.pairs.values)
    floors, rests, k = found.floors, found.rests, len(found.pairs.values)

    def work(b):
        ids, white, far = [], [], []
        for at, x in enumerate(b.column("x").to_pylist()):
            ids.append(b.column("ids")[at].values)
            white.append(_centred(x, dim, floors, rests) @ turn)
            far += _deviations(np.frombuffer(x, np.int64).reshape(-1, dim), found)
        flat = np.concatenate(white)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * k, pa.int32()), pa.array(flat.reshape(-1)))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), lists, pa.array(far, pa.int64())], ["vec_id", "whitened", "deviation"])

    shares = [float(e) / found.trace for e in found.pairs.values]
    return _map(blocks, work, schema).withColumns(
        {
            "n": F.lit(found.n).cast("bigint"),
            "explained": F.lit(shares),
            "identity_error": F.lit(identity_error(blocks, found)),
        }
    )


def components(white: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    each = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error",
    )
