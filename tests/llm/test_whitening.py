import numpy as np
import pytest
from pyspark.sql import functions as F

from cdclake.llm import whitening as w
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows

VECTOR = "vec_id bigint, embedding array<double>"


def spectrum(kind, dim, rng):
    if kind == "flat":
        return rng.standard_normal((2000, dim))
    if kind == "falling":
        return rng.standard_normal((2000, dim)) * 0.9 ** np.arange(dim)
    if kind == "clusters":  # three groups of almost equal eigenvalues
        return rng.standard_normal((2000, dim)) * np.repeat([5.0, 1.0, 0.1], [4, 6, dim - 10])
    return rng.standard_normal((2000, 5)) @ rng.standard_normal((5, dim))  # rank 5


@pytest.mark.parametrize(("kind", "dim", "wanted"), [("flat", 64, 32), ("flat", 150, 20), ("falling", 200, 32), ("clusters", 120, 12), ("rank", 60, 5), ("flat", 6, 32)])
def test_jacobi_davidson_against_a_dense_solver(kind, dim, wanted):
    x = spectrum(kind, dim, np.random.default_rng(dim))
    y = x - x.mean(axis=0)
    covariance = y.T @ y / len(y)
    found = w.jacobi_davidson(lambda q: y.T @ (y @ q) / len(y), dim, wanted)
    values = np.linalg.eigvalsh(covariance)[::-1][: len(found.values)]
    assert len(found.values) == min(dim, wanted) and (np.diff(found.values) <= 0).all()
    assert np.abs(found.values - values).max() <= 1e-13 * values[0]
    assert np.abs(covariance @ found.vectors - found.vectors * found.values).max() <= 1e-13 * values[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(values))).max() <= 1e-13


def test_minres_solves_projected_indefinite_equations():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    basis = np.linalg.qr(rng.standard_normal((30, 4)))[0]
    rhs = rng.standard_normal((30, 3))
    rhs -= basis @ (basis.T @ rhs)
    shifts = np.array([0.3, -2.0, 5.0])
    x = w.minres(lambda q: a @ q, shifts, basis, rhs, 60, 1e-12)
    left = a @ x - x * shifts
    assert np.abs(left - basis @ (basis.T @ left) - rhs).max() < 1e-8 and np.abs(basis.T @ x).max() < 1e-12


def plain(data, components=32, scale=64, offset=1_000_000):
    """Dense whitening: ids, exact deviations, whitened, explained."""
    x = [[int(np.floor(scale * c)) + offset for c in vector] for _, vector in data]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    y = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return deviations, y @ u / np.sqrt(e), e / (y * y).sum() * n


@pytest.mark.parametrize(("n", "dim"), [(400, 40), (300, 7)])
def test_equals_dense_whitening(spark, n, dim):
    rng = np.random.default_rng(n)
    data = [(int(i), (rng.standard_normal(dim) * 0.8 ** np.arange(dim) + 3).tolist()) for i in rng.permutation(n)]
    found = w.components(w.whiten(spark.createDataFrame(data, VECTOR).repartition(3))).collect()
    deviations, white, explained = plain(data)
    k = min(32, dim)
    assert len(found) == n * k
    at = {i: row for row, (i, _) in enumerate(data)}
    got = np.zeros((n, k))
    for r in found:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviations[at[r.vec_id]] and 0 <= r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-8


def test_whole_query_has_unit_covariance(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    found = w.whiten(table)
    got = np.array([r.whitened for r in found.orderBy("vec_id").collect()])
    assert got.shape == (table.count(), 32)
    assert np.abs(np.cov(got.T, bias=True) - np.eye(32)).max() < 1e-9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    kept = [(5, [0.5, -0.25, 1.0]), (5, [0.25, 0.0, 1.0]), (None, [9.0, 9.0, 9.5]), (5, [0.5, -0.25, 1.0]), (-3, [-0.001, 0.0, 3.0])]
    dropped = [(1, None), (2, []), (3, [1.0, None, 0.0]), (4, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, [1.0, 2.0])]
    table = spark.createDataFrame(kept + dropped, VECTOR)
    found = w.whiten(table)
    got = sorted((r.vec_id or 0, r.deviation) for r in found.collect())
    assert got == sorted((i or 0, d) for (i, _), d in zip(kept, plain(kept)[0], strict=True))
    each = w.components(found)
    assert {r.component for r in each.collect()} == {1, 2, 3} and each.first().identity_error < 1e-9
    crowded = table.withColumns({c: F.lit("extra") for c in ("x", "ids", "v", "d", "n", "at", "value", "component", "whitened", "deviation")})
    assert rows(w.components(w.whiten(crowded)).select("vec_id", "component", "deviation")) == rows(each.select("vec_id", "component", "deviation"))
    for none in (table.where("false"), table.where("vec_id = 1"), table.where("vec_id = -3")):  # the last: one vector does not vary
        empty = w.components(w.whiten(none))
        assert empty.columns == each.columns and empty.count() == 0
    # vectors on a line vary in one direction only
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(20)], VECTOR)
    assert {r.component for r in w.components(w.whiten(line)).collect()} == {1}
    with pytest.raises(ValueError, match="beyond"):
        w.whiten(spark.createDataFrame([(1, [1e300, 0.0])], VECTOR))


def test_deviations_beyond_64_bits():
    far = w.Fit(10**9, 2, [10**15 + 1, 10**15], 1.0, w.Pairs(np.zeros(1), np.zeros((2, 1)), np.zeros(1)), 1 << 20)
    assert w._deviations(np.array([[10**6 + 1, 10**6], [10**6 + 5000, 10**6 - 70]]), far) == [(10**9 - 1) ** 2, None]
