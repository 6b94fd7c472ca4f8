import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdclake.llm import multiprobe_ann as a
from tests.llm.conftest import rows

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(given, k=10):
    ok = {}
    for key, v, *_ in given:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[key] = np.array(v, np.float32).astype(float)
    out = {}
    for q, x in ok.items():
        if q % 20 == 0:
            near = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in ok.items() if i != q)
            out[q] = [(i, d) for d, i in near[:k]]
    return out


def search(table):
    found = {}
    for r in a.nearest(table, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def recall(found, expected):
    return np.mean([len({i for i, _ in e} & {i for _, i, _ in found[q]}) / len(e) for q, e in expected.items()])


def vectors(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim))
    return [(i, (centres[i % 8] + 0.3 * rng.standard_normal(dim)).tolist(), 0) for i in range(n)]


def test_template_is_in_order_and_valid():
    m = 6
    template = a.probe_template(m, 200)
    assert not template[0].any() and len({tuple(t) for t in template}) == 200
    j = np.arange(1, 2 * m + 1)
    cost = np.where(j <= m, j * (j + 1) / (4 * (m + 1) * (m + 2)), 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)))
    totals = template @ cost
    assert (np.diff(totals) >= -1e-12).all()
    assert not (template & template[:, ::-1]).any()  # never both borders of one projection


def test_probes_are_neighbouring_buckets():
    hashing = a.Hashing(8, 4, 1.0, 60)
    rng = np.random.default_rng(3)
    v = rng.standard_normal(8)
    probes = hashing.probes(v)
    assert (probes[0] == hashing.keys(v[None])[0]).all()
    near = [hashing.keys((v + 0.15 * rng.standard_normal(8))[None])[0] for _ in range(200)]
    first = np.mean([(k == probes[0]).any() for k in near])
    every = np.mean([[(k[t] == probes[:, t]).any() for t in range(4)] for k in near])
    assert every > first and every > 0.9


def test_recall_and_exact_scores(spark):
    given = vectors(3000)
    found, expected = search(spark.createDataFrame(given, SCHEMA)), brute(given)
    assert found.keys() == expected.keys()
    assert recall(found, expected) >= 0.9
    table = {i: np.array(v, np.float32).astype(float) for i, v, _ in given}
    for q, near in found.items():
        assert [r for r, _, _ in near] == list(range(1, 11))
        assert [(s, i) for _, i, s in near] == sorted((s, i) for _, i, s in near)
        for _, i, s in near:
            assert s == pytest.approx(float(np.sqrt(((table[i] - table[q]) ** 2).sum())), abs=1e-12)


def test_equal_vectors_in_a_third_of_the_rows(spark):
    given = [(i, [1.0, 2.0, 3.0, -1.0] if i % 3 == 0 else v[:4], 0) for i, v, _ in vectors(900, 4)]
    found, expected = search(spark.createDataFrame(given, SCHEMA)), brute(given)
    for q in expected:
        if q % 3 == 0:
            assert [i for _, i, _ in found[q]] == [i for i, _ in expected[q]]
    assert recall(found, expected) >= 0.9


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(a, "CELL_ROWS", 50)
    given = vectors(1200, 8)
    found, expected = search(spark.createDataFrame(given, SCHEMA)), brute(given)
    assert recall(found, expected) >= 0.9


def test_queries_without_enough_candidates_are_searched_exactly(spark, monkeypatch):
    monkeypatch.setattr(a, "MOST_PROBES", 1)
    monkeypatch.setattr(a, "WIDTH", 0.05)
    given = vectors(400)
    found, expected = search(spark.createDataFrame(given, SCHEMA)), brute(given)
    assert {q: [i for _, i, _ in n] for q, n in found.items()} == {q: [i for i, _ in n] for q, n in expected.items()}


def test_edge_cases(spark):
    odd = [
        (0, [1.0, 0.0], 1), (20, None, 1), (40, [0.0, 0.0], 1), (60, [float("nan"), 1.0], 1), (80, [None, 1.0], 1), (100, [float("inf"), 1.0], 1),
        (120, [], 1), (140, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (5, [1.0, 0.0], None), (6, [0.0, 1.0], 1), (6, [0.0, 1.0], 1), (7, [0.0, 1.0], 1),
    ]
    table = spark.createDataFrame(odd, SCHEMA)
    assert search(table) == {0: [(1, 5, 0.0), (2, 6, 2**0.5), (3, 7, 2**0.5)]}
    clash = table.withColumns({c: F.lit(1) for c in ("v", "h", "r", "query_id", "rank", "score", "key", "cell", "block")})
    assert search(clash) == search(table)
    assert a.nearest(table.limit(0), lambda i: i % 20 == 0).count() == 0
    assert search(spark.createDataFrame([(20, [1.0, 2.0], 1)], SCHEMA)) == {}
    assert rows(a.nearest(table.where("vec_id = 5"), lambda i: i % 20 == 0)) == []


def test_probes_of_many_vectors_follow_the_template():
    hashing = a.Hashing(8, 5, 1.0, 80)
    many = np.random.default_rng(4).standard_normal((30, 8))
    steps = (many @ hashing.project + hashing.shift).reshape(30, 4, 5)
    found = hashing.all_probes(many)
    for i in range(30):
        assert (found[:, i] == hashing.probes(many[i])).all()
        inside = steps[i] - np.floor(steps[i])
        for t in range(4):
            borders = sorted([(x, j, -1) for j, x in enumerate(inside[t])] + [(1 - x, j, 1) for j, x in enumerate(inside[t])])
            for p, crossed in enumerate(hashing.template):
                moved = np.floor(steps[i]).astype(np.int64)
                for at in np.flatnonzero(crossed):
                    moved[t, borders[at][1]] += borders[at][2]
                assert found[p, i, t] == hashing._key(moved.reshape(1, -1).view(np.uint64))[0, t]


def plain_nearest(ids, rows, query, k):
    best = {}
    for i, d in zip(ids, a.distances(rows, query), strict=True):
        best[i] = min(d, best.get(i, math.inf))
    return [(i, d) for d, i in sorted((d, i) for i, d in best.items())[:k]]


@pytest.mark.parametrize("scale, offset", [(1, 0), (1e-3, 1e6), (1e200, 0), (1e-170, 0)])
def test_products_rule_out_no_neighbour(monkeypatch, scale, offset):
    monkeypatch.setattr(a, "TILE_NUMBERS", 500)
    monkeypatch.setattr(a, "VISITS", 600)
    rng = np.random.default_rng(6)
    given = offset + scale * rng.standard_normal((400, 6))
    given[100:140] = given[0]  # ties, by the id
    ids = rng.permutation(400)
    ids[200:210] = ids[5]  # several vectors under one id
    queries = np.concatenate([given[:20], offset + scale * rng.standard_normal((20, 6))])
    with np.errstate(over="ignore"):
        every = a._Best(ids, given, queries)
        every.offer(np.arange(40), np.arange(400))
        found = every.results(np.arange(40) * 7)
        for q in range(40):
            mine = found[found.query_id == q * 7]
            assert [*zip(mine.vec_id, mine.score, strict=True)] == plain_nearest(ids, given, queries[q], 11)
        if offset or scale != 1:
            return
        hashing = a.Hashing(6, 4, 1.5, 12)
        buckets, best = a._Buckets(hashing, given), a._Best(ids, given, queries)
        buckets.compare(np.concatenate([buckets.visits(queries[i : i + 16], i) for i in range(0, 40, 16)]), best)
        found, keys = best.results(np.arange(40)), hashing.keys(given)
        for q in range(40):
            met = (hashing.probes(queries[q])[:, None] == keys[None]).any(axis=(0, 2))
            mine = found[found.query_id == q]
            assert [*zip(mine.vec_id, mine.score, strict=True)] == plain_nearest(ids[met], given[met], queries[q], 11)


def test_queries_are_not_broadcast(spark, monkeypatch):
    """Spark takes packed vectors and keys for small, whatever they hold; a broadcast of them fills the driver."""
    plans, real = {}, a.stage

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return real(df, name)

    monkeypatch.setattr(a, "stage", stage)
    given = vectors(3000)
    assert search(spark.createDataFrame(given, SCHEMA)).keys() == brute(given).keys()
    assert "Broadcast" not in plans["met"]


def test_doubles_keep_all_their_digits(spark):
    close = [(i, [1.0, 1.0 + i * 1e-12], 0) for i in range(40)]
    table = spark.createDataFrame(close, "vec_id bigint, embedding array<double>, label int")
    assert [i for _, i, _ in search(table)[20]] == sorted((i for i in range(40) if i != 20), key=lambda i: (abs(close[i][1][1] - close[20][1][1]), i))[:10]
